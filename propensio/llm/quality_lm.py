"""Quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over characters, order 4: a character's probability follows from the three characters before it, every code point
counted as itself, in contexts too; the digits 0 to 9 alone are one character there, times the digit's share among them, as the numbers of other
texts are other numbers. All n-grams of the trusted texts are held, however many they are.
Below order 1 stands a model for what the trusted texts don't hold: the probability of the character's class after the three
classes before it (the same kind of model over 48 classes: letters without case,
common accented letters, one class for capitals, digits, kinds of punctuation; their tables have a proven
bound of 48^4 cells), times that of the character within its class (Witten-Bell: the mass of unseen ones is that of the distinct ones
seen; 1,114,112 cells, each code point's own). So capitals, symbol runs and glued words raise the perplexity also in scripts that are not trusted.
Counts come from all trusted texts: each partition counts its n-grams and the counts are summed by n-gram.
The Kneser-Ney probabilities are joins of those sharded tables: each n-gram with its context's total and its
counts of continuations, and with the next lower order, which counts distinct left neighbours. Discounts per order are
the modified ones, from the numbers of n-grams seen once to four times.

A text is scored against the n-grams of characters in one of two ways, with the same result: up to ``LOOKUP_GRAMS`` n-grams (and 65,534 code points)
lie in every task as hash tables, more are joined with the n-grams of the distinct texts.

Every document's perplexity per character is held against the quantiles ``low`` and ``high`` of the trusted documents of
its language; outside them it is not kept. Languages without trusted documents (and null) take the quantiles over all trusted documents.
Null and empty texts have a null perplexity and are not kept. Without trusted text every document's perplexity is null.
Repeated rows are scored alike and count each time, as trusted text too; a perplexity equal to a quantile is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize

ORDER, SYMBOLS = 4, 48
POINTS = 0x110000  # also the padding in front of a text
#: Most n-grams of characters, over all orders, that tasks hold as hash tables.
LOOKUP_GRAMS = 3_000_000
_BITS = 21  # of a code point in a context
LOW, HIGH = 0.002, 0.998
#: Classes of the accented letters (fixed values); other letters are of class 38, capitals of 39.
ACCENTED = "éèêçàùâîôûïëüöäßñíóáú"
_CHUNK = 1 << 20


def _alphabet() -> np.ndarray:
    table = np.full(0x110000, 45, dtype=np.uint8)  # other symbols
    for o in range(0x110000):
        if o < 0x250 or 0x370 <= o < 0x530:
            c = chr(o)
            if c.isalpha():
                table[o] = 39 if c.isupper() else 38
    for o in range(97, 123):
        table[o] = o - 96
    for i, c in enumerate(ACCENTED):
        table[ord(c)] = 27 + i % 11
    table[0x530:0xD800] = 38
    for chars, code in (("0123456789", 40), (" \t", 41), ("\n\r", 42), (".", 43), (",;:", 44), ("!?", 46), ("|<>{}[]=#*_/\\", 47)):
        for c in chars:
            table[ord(c)] = code
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of the n-grams of a text's code points (three padding symbols in front)."""
    codes = table[points].astype(np.int32)
    codes = np.concatenate([np.zeros(ORDER - 1, dtype=np.int32), codes])
    n = len(codes) - ORDER + 1
    out = codes[:n].copy()
    for k in range(1, ORDER):
        out *= SYMBOLS
        out += codes[k : n + k]
    return out


def _digits(points: np.ndarray) -> np.ndarray:
    return (points >= ord("0")) & (points <= ord("9"))


def _padded(held: list[np.ndarray]) -> np.ndarray:
    """The code points of texts, one after the other, three padding symbols in front of each; every digit is a 0."""
    pad = np.full(ORDER - 1, POINTS, dtype=np.uint32)
    run = np.concatenate([part for points in held for part in (pad, points)])
    run[_digits(run)] = ord("0")
    return run


def _character_grams(run: np.ndarray) -> Iterator[pd.DataFrame]:
    """Counts of the n-grams of characters in padded texts: ``before`` holds the three characters before ``gram``."""
    mark = np.zeros(POINTS + 1, dtype=bool)
    mark[run] = True
    own = np.flatnonzero(mark)
    if len(own) > 1 << 16:  # too many symbols for one number; fewer characters have fewer
        for lo in range(0, len(run) - ORDER + 1, 60_000):
            yield from _character_grams(run[lo : lo + 60_000 + ORDER - 1])
        return
    codes, width = (np.cumsum(mark) - 1).astype(np.uint64)[run], np.uint64(len(own))
    key = codes[: len(run) - ORDER + 1].copy()
    for k in range(1, ORDER):
        key *= width
        key += codes[k : len(key) + k]
    key, n = np.unique(key[run[ORDER - 1 :] != POINTS], return_counts=True)
    symbols = []
    for _ in range(ORDER):
        symbols.append(own[(key % width).astype(np.int64)])
        key = key // width
    before = sum(c << (_BITS * k) for k, c in enumerate(symbols[1:]))
    yield pd.DataFrame({"before": before, "gram": symbols[0], "n": n})


def _chunks(texts: Iterator[str]) -> Iterator[list[np.ndarray]]:
    """Code points of the texts that hold any, some ``_CHUNK`` characters at a time."""
    held, size = [], 0
    for text in texts:
        if text:
            held.append(_points(text))
            size += len(held[-1])
        if size > _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of n-grams of classes (before -1), of code points (as grams -1 - point) and of n-grams of characters."""
    table, total, chars = _alphabet(), np.zeros(SYMBOLS**ORDER, dtype=np.int64), np.zeros(POINTS, dtype=np.int64)
    parts: list[pd.DataFrame] = []
    for held in _chunks(text for pdf in batches for text in pdf["text"]):
        total += np.bincount(np.concatenate([_grams(points, table) for points in held]), minlength=len(total))
        chars += np.bincount(np.concatenate(held), minlength=POINTS)
        parts += _character_grams(_padded(held))
        if sum(map(len, parts)) > 2 * _CHUNK:
            parts = [pd.concat(parts).groupby(["before", "gram"], as_index=False, sort=False)["n"].sum()]
            if len(parts[0]) > _CHUNK:
                yield parts.pop()
    if parts:
        yield pd.concat(parts).groupby(["before", "gram"], as_index=False, sort=False)["n"].sum()
    seen, points = np.flatnonzero(total), np.flatnonzero(chars)
    yield pd.DataFrame({"before": -1, "gram": np.concatenate([seen, -1 - points]).astype(np.int64), "n": np.concatenate([total[seen], chars[points]])})


def counted(trusted: DataFrame, text_col: str = "text") -> DataFrame:
    """(``before, gram, n``) of all trusted texts, as a written table. A code point is the gram -1 - point; n-grams of classes and code points have
    ``before`` -1, n-grams of characters their context there and the last character's code point as gram."""
    thin = trusted.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    return materialize(thin.mapInPandas(_count, "before long, gram long, n long").groupBy("before", "gram").agg(F.sum("n").alias("n")), "grams-4")


def character_logs(counts: DataFrame) -> np.ndarray:
    """Natural log probability of every code point within its class: 1,114,112 floats (4 MB), a bound by construction."""
    table, n = _alphabet(), np.zeros(POINTS)
    seen = counts.where("gram < 0").toPandas()
    n[-1 - seen["gram"].to_numpy(dtype=np.int64)] = seen["n"].to_numpy()
    total, kinds, size = np.bincount(table, n, SYMBOLS), np.bincount(table, n > 0, SYMBOLS), np.bincount(table, minlength=SYMBOLS)
    unseen = size - kinds
    mass = np.where(unseen > 0, total + kinds, total)  # a class seen whole keeps nothing for unseen ones
    p_unseen = np.where(total > 0, kinds / np.maximum(mass * unseen, 1), 1 / np.maximum(size, 1))
    return np.log(np.where(n > 0, n / np.maximum(mass, 1)[table], p_unseen[table])).astype(np.float32)


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    seen = {r["n"]: r["k"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (max(1, seen.get(i, 0)) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3))]


def train(trusted: DataFrame, text_col: str = "text") -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1 .. 4: (``gram, p``) of seen n-grams and (``context, gamma``) of seen contexts, as written tables."""
    return _kneser_ney(counted(trusted, text_col))


def _kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    levels = [counts.where("before < 0 and gram >= 0").drop("before")]
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        lower = levels[0].groupBy((F.col("gram") % SYMBOLS**order).alias("gram")).agg(F.count("*").alias("n"))
        levels.insert(0, materialize(lower, f"grams-{order}"))
    model: list[tuple[DataFrame, DataFrame]] = []
    for order, counts in enumerate(levels, start=1):
        d1, d2, d3 = _discounts(counts)
        counts = counts.withColumn("context", F.floor(F.col("gram") / SYMBOLS))
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum(d).alias("left"))
        contexts = contexts.select("context", "total", (F.col("left") / F.col("total")).alias("gamma"))
        joined = counts.join(contexts, "context").withColumn("own", (F.col("n") - d) / F.col("total"))
        if order == 1:
            joined = joined.withColumn("p", F.col("own") + F.col("gamma") / SYMBOLS)
        else:
            below = model[-1][0].select(F.col("gram").alias("low_gram"), F.col("p").alias("low_p"))
            joined = joined.withColumn("low_gram", F.col("gram") % SYMBOLS ** (order - 1)).join(below, "low_gram")
            joined = joined.withColumn("p", F.col("own") + F.col("gamma") * F.col("low_p"))
        model.append((materialize(joined.select("gram", "p"), f"p-{order}"), contexts.select("context", "gamma")))
    return model


def log_table(model: list[tuple[DataFrame, DataFrame]]) -> np.ndarray:
    """Natural log probability of every n-gram, seen or backed off: 48^4 floats (21 MB), a bound by construction."""
    dense = np.full(1, 1.0 / SYMBOLS)
    for order, (seen, contexts) in enumerate(model, start=1):
        ctx, p = contexts.toPandas(), seen.toPandas()
        gamma = np.ones(SYMBOLS ** (order - 1))
        gamma[ctx["context"].to_numpy(dtype=np.int64)] = ctx["gamma"].to_numpy()
        low = np.full(SYMBOLS, 1.0 / SYMBOLS) if order == 1 else dense  # indexed by the n-gram without its first symbol
        dense = (gamma.reshape(-1, SYMBOLS ** max(0, order - 2)).repeat(SYMBOLS, axis=1) * low[None, :]).ravel() if order > 1 else gamma[0] * low
        dense[p["gram"].to_numpy(dtype=np.int64)] = p["p"].to_numpy()
    return np.log(dense).astype(np.float32)


def _character_model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1 .. 4: (``before, gram, a, b``) of seen n-grams and (``before, gamma``) of seen contexts, as written tables.

    A seen n-gram's probability is ``a`` + ``b`` times the probability below order 1, an unseen one's that of the next
    lower order times its context's ``gamma`` (1 for an unseen context).
    """
    levels = [counts.where("before >= 0")]
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        lower = levels[0].groupBy((F.col("before") % 2 ** (_BITS * (order - 1))).alias("before"), "gram").agg(F.count("*").alias("n"))
        levels.insert(0, materialize(lower, f"characters-{order}"))
    model: list[tuple[DataFrame, DataFrame]] = []
    for order, level in enumerate(levels, start=1):
        d1, d2, d3 = _discounts(level)
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = level.groupBy("before").agg(F.sum("n").alias("total"), (F.sum(d) / F.sum("n")).alias("gamma"))
        joined = level.join(contexts, "before").withColumn("own", (F.col("n") - d) / F.col("total"))
        a, b = F.col("own"), F.col("gamma")
        if order > 1:
            below = model[-1][0].select(F.col("before").alias("low"), "gram", F.col("a").alias("low_a"), F.col("b").alias("low_b"))
            joined = joined.withColumn("low", F.col("before") % 2 ** (_BITS * (order - 2))).join(below, ["low", "gram"])
            a, b = a + F.col("gamma") * F.col("low_a"), F.col("gamma") * F.col("low_b")
        model.append((materialize(joined.select("before", "gram", a.alias("a"), b.alias("b")), f"character-p-{order}"),
                      materialize(contexts.select("before", "gamma"), f"character-contexts-{order}")))
    return model


class _Lookup:
    """Hash table of whole numbers with open addressing; ``values`` has a row of numbers for each key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, owner = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, -1, dtype=np.int64)
        todo, slot = np.arange(len(keys)), self._home(keys)
        while len(todo):
            free = owner[slot] < 0
            owner[slot[free]] = todo[free]  # of several keys for a place one stays
            lost = owner[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & self.mask
        self.used = owner >= 0
        self.keys[self.used] = keys[owner[self.used]]
        self.values = np.zeros((len(values), 1 << bits), dtype=np.float32)
        self.values[:, self.used] = values[:, owner[self.used]]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of every key, -1 without one."""
        slot = self._home(keys)
        open_ = np.flatnonzero((self.keys[slot] != keys) | ~self.used[slot])
        while len(open_):
            at = slot[open_]
            gone = ~self.used[at]
            slot[open_[gone]] = -1
            open_ = open_[~gone]
            slot[open_] = at = (at[~gone] + 1) & self.mask
            open_ = open_[(self.keys[at] != keys[open_]) | ~self.used[at]]
        return slot


class _CharacterTables:
    """The model of characters in arrays; symbols are numbered 2 .. in the order of code points, 0 is padding, 1 any other."""

    def __init__(self, model: list[tuple[DataFrame, DataFrame]]):
        first = model[0][0].toPandas().sort_values("gram")
        self.symbols = np.ones(POINTS + 1, dtype=np.uint64)
        self.symbols[POINTS] = 0
        self.symbols[first["gram"].to_numpy()] = np.arange(2, len(first) + 2)
        gamma = float(model[0][1].toPandas()["gamma"].iloc[0])
        self.first = np.array([[0, 0, *first["a"]], [gamma, gamma, *first["b"]]], dtype=np.float32)
        self.seen, self.contexts = [], []
        for order, (seen, contexts) in enumerate(model[1:], start=2):
            grams, heads = seen.toPandas(), contexts.toPandas()
            last = self.symbols[grams["gram"].to_numpy()]
            self.seen.append(_Lookup(self._packed(grams["before"].to_numpy(), order - 1) << np.uint64(16) | last, grams[["a", "b"]].to_numpy().T))
            self.contexts.append(_Lookup(self._packed(heads["before"].to_numpy(), order - 1), heads[["gamma"]].to_numpy().T))

    def _packed(self, before: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros(len(before), dtype=np.uint64)
        for k in range(length - 1, -1, -1):
            out = out << np.uint64(16) | self.symbols[(before >> (_BITS * k)) & ((1 << _BITS) - 1)]
        return out

    def parts(self, run: np.ndarray) -> np.ndarray:
        """(a, b) of every character of padded texts after the three before it, the padding left out."""
        codes, last = self.symbols[run], np.flatnonzero(run != POINTS)
        own = codes[last]
        pre = [own]  # the characters before, packed, by order
        head = np.zeros(len(last), dtype=np.uint64)
        for k in range(1, ORDER):
            head = codes[last - k] << np.uint64(16 * (k - 1)) | head
            pre.append(head)
        out = np.empty((2, len(last)))
        todo, share = np.arange(len(last)), np.ones(len(last))
        for order in range(ORDER, 1, -1):
            seen, contexts, heads = self.seen[order - 2], self.contexts[order - 2], pre[order - 1][todo]
            at = seen.find(heads << np.uint64(16) | own[todo])
            held = at >= 0
            out[:, todo[held]] = seen.values[:, at[held]] * share[held]
            todo, share = todo[~held], share[~held]
            at = contexts.find(heads[~held])
            share = share * np.where(at >= 0, contexts.values[0, np.maximum(at, 0)], 1.0)
        out[:, todo] = self.first[:, own[todo].astype(np.int64)] * share
        return out


def _below(points: np.ndarray, table: np.ndarray, logs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Probability below order 1 of a text's characters, and the logarithm of a digit's share among the digits (0 for others)."""
    own, digit = logs[1][points].astype(np.float64), _digits(points)
    return np.exp(logs[0][_grams(points, table)] + np.where(digit, 0.0, own)), np.where(digit, own, 0.0)


def _score(logs, tables):
    """Perplexities from the tables of ``_CharacterTables``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _alphabet()
        for pdf in batches:
            means = []
            for held in _chunks(pdf["text"]):
                a, b = tables.value.parts(_padded(held))
                sizes = np.array([len(points) for points in held])
                floor, share = np.concatenate([_below(points, table, logs.value) for points in held], axis=1)
                log = np.log(a + b * floor) + share
                means.append(np.add.reduceat(log, np.cumsum(sizes) - sizes) / sizes)
            size = pdf["text"].map(lambda t: len(t) if t else 0).to_numpy(dtype=np.int64)
            out = np.full(len(pdf), np.nan)
            out[size > 0] = np.exp(-np.concatenate([*means, []]))
            yield pd.DataFrame({"id": pdf["id"], "lang": pdf["lang"], "n_chars": size, "perplexity": pd.array(np.where(size > 0, out, None), dtype="Float64")})

    return run


def _text_grams(logs):
    """Per text: its distinct n-grams of characters, their probability below order 1, how often each stands there and their digits' shares."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _alphabet()
        for pdf in batches:
            for key, text in zip(pdf["key"], pdf["text"]):
                points = _points(text)
                c = _padded([points]).astype(np.int64)
                before = c[: len(points)] << 2 * _BITS | c[1 : len(points) + 1] << _BITS | c[2 : len(points) + 2]
                floor, share = _below(points, table, logs.value)
                grams = pd.DataFrame({"before": before, "gram": c[ORDER - 1 :], "floor": floor, "n": 1, "share": share})
                yield grams.groupby(["before", "gram"], as_index=False).agg({"floor": "first", "n": "sum", "share": "sum"}).assign(key=key)

    return run


def _joined_perplexities(thin: DataFrame, model: list[tuple[DataFrame, DataFrame]], logs) -> DataFrame:
    """``thin`` with ``perplexity``: the n-grams of the distinct texts joined with the model, order by order."""
    keyed = thin.withColumn("key", F.sha2("text", 256))
    texts = keyed.where("text != ''").groupBy("key").agg(F.first("text").alias("text"))
    grams = texts.mapInPandas(_text_grams(logs), "before long, gram long, floor double, n long, share double, key string")
    gamma = model[0][1].first()["gamma"]
    a, b = F.lit(0.0), F.lit(float(gamma))
    for order, (seen, contexts) in enumerate(model, start=1):
        grams = grams.withColumn("head", F.col("before").bitwiseAND(2 ** (_BITS * (order - 1)) - 1)).join(seen.select(F.col("before").alias("head"), "gram", F.col("a").alias(f"a{order}"), F.col("b").alias(f"b{order}")), ["head", "gram"], "left")
        if order > 1:
            grams = grams.join(contexts.select(F.col("before").alias("head"), F.col("gamma").alias(f"g{order}")), "head", "left")
            a, b = (F.coalesce(F.col(f"g{order}"), F.lit(1.0)) * x for x in (a, b))
        a, b = F.coalesce(F.col(f"a{order}"), a), F.coalesce(F.col(f"b{order}"), b)
        grams = grams.drop("head")
    mean = F.sum(F.col("n") * F.log(a + b * F.col("floor")) + F.col("share")) / F.sum("n")
    return keyed.join(grams.groupBy("key").agg(F.exp(-mean).alias("perplexity")), "key", "left").drop("key")


def judge(
    docs: DataFrame, trusted_ids: DataFrame, low: float = LOW, high: float = HIGH, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Per row: id, ``lang``, ``trusted``, ``n_chars``, ``perplexity``, ``low``, ``high``, ``kept``. ``trusted_ids`` holds ``id_col``."""
    kind = dict(docs.dtypes)[id_col]
    ids = trusted_ids.select(F.col(id_col).alias("id")).distinct()
    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # the trusted ids grow with the corpus, so the texts meet them in a shuffle at every size
    counts = counted(thin.join(ids.hint("merge"), "id", "left_semi"))
    with ThreadPoolExecutor(max_workers=2) as pool:  # both models come from the same counts
        classes, characters = pool.submit(_kneser_ney, counts), pool.submit(_character_model, counts)
        model, characters = classes.result(), characters.result()
    empty = not model[-1][0].limit(1).count()
    sc, length = docs.sparkSession.sparkContext, F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")
    if empty:
        scored = thin.select("id", "lang", length, F.lit(None).cast("double").alias("perplexity"))
    else:
        logs = sc.broadcast((log_table(model), character_logs(counts)))
        if characters[0][0].count() < 1 << 16 and sum(seen.count() for seen, _ in characters) <= LOOKUP_GRAMS:
            scored = thin.mapInPandas(_score(logs, sc.broadcast(_CharacterTables(characters))), f"id {kind}, lang string, n_chars long, perplexity double")
        else:
            scored = _joined_perplexities(thin, characters, logs).select("id", "lang", length, "perplexity")
    scored = scored.join(ids.withColumn("known", F.lit(True)), "id", "left").withColumn("trusted", F.coalesce("known", F.lit(False))).drop("known")
    scored = materialize(scored, "perplexities")
    good = scored.where("trusted and perplexity is not null")
    edge = [F.percentile_approx("perplexity", q, 100_000).alias(name) for q, name in ((low, "low"), (high, "high"))]
    by_lang = materialize(good.where("lang is not null").groupBy("lang").agg(*edge), "language-quantiles")  # its size is known to the join
    overall = good.agg(*edge).select(F.col("low").alias("low_all"), F.col("high").alias("high_all"))  # one row
    joined = scored.join(by_lang, "lang", "left").crossJoin(F.broadcast(overall))
    joined = joined.withColumn("low", F.coalesce("low", "low_all")).withColumn("high", F.coalesce("high", "high_all"))
    kept = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return joined.select(F.col("id").alias(id_col), "lang", "trusted", "n_chars", "perplexity", "low", "high", kept.alias("kept"))
