"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

A text is toxic when one of its words is, so labelled texts (sentences or whole
documents) are bags of words and the machine is a multi-instance one:

* Kernel: the gap-weighted subsequence kernel of order 4 between two words
  (with start and end marks), span at most 7, each skipped character costs a
  factor ``DECAY``, normalised to 1 for equal words. A gapped or
  padded insult ("i-d-iot", "idxiot") keeps most of its subsequences. Runs of three or
  more single characters ("i d i o t") also count as one word, as does a word less its inner punctuation.
* Training: near copies among the labelled texts are thinned first (one text per smallest
  5-word shingle hash, twice), so that words of a copied text don't pass for insults. Words tied to the toxic
  label by a G test are candidates; the surest ones and those that a greedy cover of the toxic texts
  needs are the positive words; words of clean texts are the negative ones, topped up by the clean words that earlier fits score
  highest. Stretched and padded spellings of the positive words are added as virtual examples. A squared-hinge SVM is fitted on the Nystroem features K(w, L) K(L, L)^-1/2 of the
  landmarks L.
* Scoring: the order-4 feature space has 40^4 cells, so the landmark expansion folds into
  one weight per cell exactly (2.56 M floats, whatever the data). A word's value is one gather and its norm;
  a text's value is its largest word's, cut to 0 .. 1, put through a logistic fit.

Sample bounds, the only ones: ``max_texts`` texts of each label (chosen by text hash),
``MAX_CANDIDATES`` candidate words, ``MAX_NEGATIVES`` clean words, ``LANDMARKS`` landmarks in all. Scoring covers every word of every text.

Null and empty texts score as a text without toxic words. With no row of either label the
score is 0.5 less a hair for every text (nothing was learned). Null labels are left out of training.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.llm.text import mix, shingles, word_hashes
from propensio.session import materialize

ORDER, SPAN, DECAY, SYMBOLS = 4, 7, 0.7, 40
CELLS = SYMBOLS**ORDER
MAX_CANDIDATES, MAX_NEGATIVES, LANDMARKS, MINING_ROUNDS = 2000, 6000, 768, 4
#: Words whose kernel rows are held at once in the fit, pieces whose subsequences are, and products that are summed at once.
FIT_BLOCK, PIECES_AT_ONCE, PRODUCTS = 100, 500, 500_000
#: Characters of a word looked at together; longer words are cut into overlapping pieces of this length.
PIECE, STEP = 24, 16
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_MEMO = 50_000
_SLICE = 256
MAX_TEXTS = 20_000


def _code(c: str) -> int:
    o = ord(c)
    if 97 <= o <= 122:
        return o - 96
    if c.isdigit():
        return 27
    return 29 + o % 10 if c.isalpha() else 28


def words_of(text: str | None) -> set[str]:
    """Distinct lower-cased words without outer punctuation, and joined runs of single characters."""
    tokens = (text or "").lower().split()
    words = set(tokens)
    words.update("".join(filter(str.isalnum, t)) for t in list(words) if not t.isalnum() and not clean_word(t).isalnum())
    single = [i for i, t in enumerate(tokens) if len(t) == 1]
    start = 0
    for k in range(1, len(single) + 1):
        if k == len(single) or single[k] != single[k - 1] + 1:
            if k - start >= 3:
                words.add("".join(tokens[i] for i in single[start:k]))
            start = k
    return words


def clean_word(token: str) -> str:
    return token if token.isalnum() else _EDGE.sub("", token)


def _disguised(word: str) -> list[str]:
    """Virtual positive examples: one letter stretched, one letter put in."""
    k = len(word) // 2
    return [word[:k] + word[k] + word[k:], f"{word[:k]}x{word[k:]}", f"{word[:k + 1]}k{word[k + 1:]}"] if len(word) >= 5 else []


def _pieces(word: str) -> list[str]:
    marked = f"\x02{word}\x03"
    if len(marked) <= PIECE:
        return [marked]
    return [marked[i : i + PIECE] for i in range(0, len(marked) - PIECE + STEP, STEP)]


def _subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index tuples within SPAN and their gap weights."""
    runs = [(i, *rest) for i in range(length) for rest in combinations(range(i + 1, min(length, i + SPAN)), ORDER - 1)]
    idx = np.array(runs, dtype=np.int64).reshape(-1, ORDER)
    return idx, DECAY ** (idx[:, -1] - idx[:, 0] - (ORDER - 1)).astype(np.float64)


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of equal length: (positions in ``words``, cells of the subsequences, their weights)."""
    by_length: dict[int, list[tuple[int, list[int]]]] = {}
    for at, word in enumerate(words):
        for piece in _pieces(word):
            by_length.setdefault(len(piece), []).append((at, [0 if c == "\x02" else SYMBOLS - 1 if c == "\x03" else _code(c) for c in piece]))
    for length, rows in by_length.items():
        idx, weight = _subsequences(length)
        if not len(idx):
            continue
        for a in range(0, len(rows), PIECES_AT_ONCE):
            part = rows[a : a + PIECES_AT_ONCE]
            codes = np.array([r[1] for r in part], dtype=np.int64)
            yield np.array([r[0] for r in part]), sum(codes[:, idx[:, k]] * SYMBOLS ** (ORDER - 1 - k) for k in range(ORDER)), weight


def _norms(cells: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """sqrt K(w, w): weights of equal cells of a row are summed before squaring."""
    order = np.argsort(cells, axis=1)
    c, w = np.take_along_axis(cells, order, 1), weight[order]
    sums = np.cumsum(w, axis=1)
    last = np.concatenate([c[:, 1:] != c[:, :-1], np.ones((len(c), 1), bool)], axis=1)
    ends = np.where(last, sums, 0.0)
    before = np.maximum.accumulate(np.concatenate([np.zeros((len(c), 1)), ends[:, :-1]], axis=1), axis=1)
    return np.sqrt((np.where(last, sums - before, 0.0) ** 2).sum(axis=1))


def word_values(words: list[str], table: np.ndarray, capped: bool = True) -> np.ndarray:
    """f(w) = <features of w, table> / |features of w|, cut to 0 .. 1 (the margin: beyond it nothing is surer)."""
    out = np.zeros(len(words))
    for at, cells, weight in features(words):
        raw = table[cells] @ weight
        up = np.flatnonzero(raw > 0)
        if len(up):
            np.maximum.at(out, at[up], raw[up] / _norms(cells[up], weight))
    return np.minimum(out, 1.0) if capped else out


def _entries(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised features as (position in ``words``, cell, weight), ordered by cell."""
    rows, cells, weights = [], [], []
    for at, found, weight in features(words):
        rows.append(np.repeat(at, found.shape[1]).astype(np.int32))
        cells.append(found.ravel().astype(np.int32))
        weights.append((weight[None, :] / _norms(found, weight)[:, None]).ravel())
    if not rows:
        return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0)
    row, cell, weight = (np.concatenate(x) for x in (rows, cells, weights))
    order = np.argsort(cell, kind="stable")
    return row[order], cell[order], weight[order]


def _kernel(words: list[str], land: tuple[np.ndarray, np.ndarray, np.ndarray], n_land: int) -> Iterator[np.ndarray]:
    """K(words, landmarks), ``FIT_BLOCK`` words at a time: only cells that both sides hold are multiplied, nothing is dense but the result."""
    place, cell, weight = land
    for lo in range(0, len(words), FIT_BLOCK):
        block = words[lo : lo + FIT_BLOCK]
        out = np.zeros(len(block) * n_land)
        for at, found, gaps in features(block):
            own = found.ravel()
            w = (gaps[None, :] / _norms(found, gaps)[:, None]).ravel()
            row = np.repeat(at * n_land, found.shape[1])
            first = np.searchsorted(cell, own)
            times = np.searchsorted(cell, own, "right") - first
            upto = np.concatenate(([0], np.cumsum(times)))
            cuts = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1], PRODUCTS)), len(own)))
            for a, b in zip(cuts, cuts[1:], strict=False):
                t = times[a:b]
                entry = np.repeat(first[a:b] - upto[a:b] + upto[a], t) + np.arange(upto[b] - upto[a])
                out += np.bincount(np.repeat(row[a:b], t) + place[entry], np.repeat(w[a:b], t) * weight[entry], len(out))
        yield out.reshape(len(block), n_land)


@dataclass
class ToxicityModel:
    """Weights of the 40^4 subsequence cells and the logistic map of a text's value."""

    table: np.ndarray
    slope: float
    offset: float

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * value + self.offset)))

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col`` and ``score`` (0 to 1) of every row."""
        kind = dict(docs.dtypes)[id_col]
        thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return thin.mapInPandas(_text_values(self), f"id {kind}, score double").withColumnRenamed("id", id_col)

    def filter_clean(self, docs: DataFrame, text_col: str = "text", limit: float = 0.5) -> DataFrame:
        """The rows of ``docs`` scored under ``limit``, all columns unchanged, without a shuffle."""
        score = _text_values(self)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                texts = pd.DataFrame({"id": np.arange(len(pdf)), "text": pdf[text_col]})
                yield pdf[(next(iter(score(iter([texts]))))["score"] < limit).to_numpy()]

        return docs.mapInPandas(run, docs.schema)


def _text_values(model: ToxicityModel):
    table = model.table.astype(np.float32)
    slope, offset = model.slope, model.offset

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, memo = table.astype(np.float64), {}
        for pdf in batches:
            best = []
            for at in range(0, len(pdf), _SLICE):
                bags = [words_of(t) for t in pdf["text"].iloc[at : at + _SLICE]]
                if len(memo) > _MEMO:
                    memo = {}
                new = list({w for bag in bags for w in bag if w not in memo})
                for k in range(0, len(new), 20_000):
                    part = new[k : k + 20_000]
                    memo.update(zip(part, word_values([clean_word(w) for w in part], weights).tolist(), strict=True))
                best += [max((memo[w] for w in bag), default=0.0) for bag in bags]
            yield pd.DataFrame({"id": pdf["id"], "score": 1 / (1 + np.exp(-(slope * np.array(best, dtype=np.float64) + offset)))})

    return run


def _with_low_hash(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            low = []
            for text in pdf["text"]:
                h = shingles(word_hashes(text), 5)
                low.append(int(mix(h ^ np.uint64(k + 1)).min().view(np.int64)) if len(h) else 0)
            yield pdf.assign(low=low)

    return run


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n = {0: Counter(), 1: Counter()}
        for text, label in zip(pdf["text"], pdf["label"], strict=True):
            n[int(label)].update({clean_word(w) for w in words_of(text)})
        words = [w for w in n[0].keys() | n[1].keys() if w]
        yield pd.DataFrame({"word": words, "n0": [n[0][w] for w in words], "n1": [n[1][w] for w in words]})


def _bags_of(candidates: list[str]):
    place = {w: i for i, w in enumerate(candidates)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"bag": [sorted({place[c] for w in words_of(t) if (c := clean_word(w)) in place}) for t in pdf["text"]]})

    return run


def _cover(bags: list[list[int]], n: int, least: float) -> list[int]:
    """Greedy cover: each choice halves the weight of the texts it explains; stops when a gain is under ``least``."""
    holds: list[list[int]] = [[] for _ in range(n)]
    for i, bag in enumerate(bags):
        for c in bag:
            holds[c].append(i)
    rows = [np.array(h, dtype=np.int64) for h in holds]
    weight, chosen = np.ones(len(bags)), []
    gain = np.array([len(h) for h in rows], dtype=np.float64)
    while n:
        best = int(gain.argmax())
        gain[best] = weight[rows[best]].sum()  # gains only fall, so a stale one is brought up to date first
        if gain[best] < gain.max():
            continue
        if gain[best] < least:
            break
        chosen.append(best)
        weight[rows[best]] /= 2
        gain[best] = 0
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Squared-hinge SVM without offset: Newton steps on the active rows, halved until the loss falls.

    ``x`` (float32) is the only array of its size; sums run over blocks of rows in doubles.
    """
    blocks = [slice(at, at + FIT_BLOCK) for at in range(0, len(x), FIT_BLOCK)]

    def margins(w: np.ndarray) -> np.ndarray:
        return y * np.concatenate([x[b].astype(np.float64) @ w for b in blocks])

    def loss(w: np.ndarray) -> float:
        return ridge * (w @ w) + (weight * np.maximum(0, 1 - margins(w)) ** 2).sum()

    w, now = np.zeros(x.shape[1]), float((weight).sum())
    for _ in range(rounds):
        pull = np.where(margins(w) < 1, weight, 0.0)
        gram, target = ridge * np.eye(len(w)), np.zeros(len(w))
        for b in blocks:
            part = x[b].astype(np.float64)
            gram += part.T @ (pull[b][:, None] * part)
            target += part.T @ (pull[b] * y[b])
        step = np.linalg.solve(gram, target) - w
        size, new = 1.0, loss(w + step)
        while new > now and size > 1e-6:
            size /= 2
            new = loss(w + size * step)
        if now - new < 1e-7 * now:
            break
        w, now = w + size * step, new
    return w


def _fit_words(positive: list[str], negative: list[str], hard: list[str]) -> np.ndarray:
    """Cell weights of the SVM on the Nystroem features of the words."""
    negative = [w for w in dict.fromkeys(hard + negative) if w not in set(positive)]
    known_words = set(positive + negative)
    base, positive = len(positive), positive + [v for w in positive for v in _disguised(w) if v not in known_words]
    words = positive + negative
    # landmarks are words of one piece: the surest positive ones first, the rest clean words
    marks = [w for w in positive if len(_pieces(w)) == 1][: LANDMARKS // 2]
    marks += [w for w in negative if len(_pieces(w)) == 1][: LANDMARKS - len(marks)]
    land = _entries(marks)
    values, vectors = np.linalg.eigh(np.concatenate(list(_kernel(marks, land, len(marks)))))
    root = vectors / np.sqrt(np.maximum(values, 0.03)) @ vectors.T
    x = np.empty((len(words), len(marks)), dtype=np.float32)
    for k, part in enumerate(_kernel(words, land, len(marks))):
        x[k * FIT_BLOCK : k * FIT_BLOCK + len(part)] = part @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    weight = np.where(y > 0, 10 * np.sqrt(len(negative) / base), 10.0)
    weight[base : len(positive)] *= 0.2
    beta = root @ _svm(x, y, weight)
    return np.bincount(land[1], land[2] * beta[land[0]], CELLS).astype(np.float32)


def _logistic(value: np.ndarray, label: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Platt's fit with softened targets of values that occur ``times`` times."""
    n1, n0 = (times * label).sum(), (times * (1 - label)).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([value, np.ones(len(value))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        grad, hess = x.T @ (times * (p - target)) + 1e-3 * w, (x.T * (times * p * (1 - p))) @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, max_texts: int = MAX_TEXTS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``text, toxic`` of about ``max_texts`` labelled documents of each label, chosen by id hash.

    Only the chosen ids are sent to the documents (at most about 2 * ``max_texts``, so a broadcast); no text is
    shuffled. A document with several label rows is toxic if one of them says so.
    """
    known = labels.where(f"{label_col} in (0, 1)").groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = F.when(F.col("_label") == 1, max_texts / counts.get(1, 1)).otherwise(max_texts / counts.get(0, 1))
    chosen = known.where(F.expr("pmod(xxhash64(_id), 1048576)") < share * 1048576)
    return docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"]).select(docs[text_col], F.col("_label").alias(label_col))


def fit_toxicity(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", max_texts: int = MAX_TEXTS) -> ToxicityModel:
    """Train on labelled texts (label 1 toxic, 0 clean), at most about ``max_texts`` of each label."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.where("label in (0, 1)").groupBy("label").count().collect()}
    if len(counts) < 2:
        return ToxicityModel(np.zeros(CELLS), 1.0, -1e-6)
    share = F.when(F.col("label") == 1, max_texts / counts[1]).otherwise(max_texts / counts[0])
    rows = rows.where("label in (0, 1) and text is not null").where(F.expr("pmod(xxhash64(text), 1048576)") < share * 1048576)
    for k in range(2):  # near copies share their smallest shingle hash: one text of each such group is enough
        rows = rows.mapInPandas(_with_low_hash(k), "text string, label int, low long").groupBy("label", "low").agg(F.min("text").alias("text")).select("text", "label")
    spark = rows.sparkSession
    rows = materialize(rows, "labelled-texts")
    counts = {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not (counts[0] and counts[1]):
        return ToxicityModel(np.zeros(CELLS), 1.0, -1e-6)
    n1, n0 = counts[1], counts[0]
    vocabulary = materialize(
        rows.mapInPandas(_count_words, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "words"
    )
    prior = n1 / (n0 + n1)
    g = F.expr(f"n1 * ln(n1 / ((n0 + n1) * {prior!r})) + if(n0 = 0, 0D, n0 * ln(n0 / ((n0 + n1) * {1 - prior!r})))")
    strong = vocabulary.where(f"n1 > 0 and n1 > 2 * {prior!r} * (n0 + n1)").withColumn("g", g).where("g >= 6")
    found = strong.orderBy(F.desc("g"), "word").limit(MAX_CANDIDATES).select("word", "g").collect()
    candidates, sure = [r["word"] for r in found], [r["word"] for r in found if r["g"] >= 14]
    bags = [r["bag"] for r in rows.where("label = 1").mapInPandas(_bags_of(candidates), "bag array<int>").collect()]
    covering = [candidates[i] for i in _cover(bags, len(candidates), 3.0)]
    positive = list(dict.fromkeys(covering + sure)) or candidates[:1]
    clean = vocabulary.where("n0 > 0").where("n1 <= 2 * n0")
    common = [r["word"] for r in clean.orderBy(F.desc("n0"), "word").limit(MAX_NEGATIVES // 3).collect()]
    spread = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(MAX_NEGATIVES // 3).collect()]
    if not positive:
        return ToxicityModel(np.zeros(CELLS), 1.0, -1e-6)
    hard: list[str] = []
    for _ in range(MINING_ROUNDS):
        table = spark.sparkContext.broadcast(_fit_words(positive, common + spread, hard))
        scored = clean.select("word").mapInPandas(_word_scores(table), "word string, value double")
        hard = list(dict.fromkeys([r["word"] for r in scored.orderBy(F.desc("value"), "word").limit(MAX_NEGATIVES // 9).collect()] + hard))
        table.destroy()
    table = _fit_words(positive, common + spread, hard)
    model = ToxicityModel(table, 1.0, 0.0)
    raw = rows.select(F.monotonically_increasing_id().alias("id"), "text", "label")
    # equal values of a label are one point: the fit gets the distinct values with their counts, at most max_texts of each label
    points = raw.mapInPandas(_label_values(model), "label int, value double").groupBy("label", "value").count().toPandas().sort_values(["label", "value"])
    slope, offset = _logistic(points["value"].to_numpy(), points["label"].to_numpy(), points["count"].to_numpy())
    return ToxicityModel(table, slope, offset)


def _word_scores(table):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = table.value.astype(np.float64)
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"], "value": word_values(pdf["word"].tolist(), weights, capped=False)})

    return run


def _label_values(model: ToxicityModel):
    score = _text_values(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = next(iter(score(iter([pdf]))))
            p = np.clip(out["score"].to_numpy(), 1e-12, 1 - 1e-12)
            yield pd.DataFrame({"label": pdf["label"], "value": np.log(p / (1 - p))})

    return run
