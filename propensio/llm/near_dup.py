"""MinHash near-duplicates with HyperMinHash registers.

1. Every text becomes its set of distinct word shingles (whole text) and one
   register per bucket: the leading-zero count of the bucket's smallest hash
   and its next ten bits, 16 bits in all. Each bucket has its own hash function,
   because dealing one hash over the buckets leaves most of them empty in a short
   text. Texts with equal sets (128-bit set fingerprint and size) become one class.
2. Five consecutive registers make a band key. Keys of one class only are dropped.
3. Every key elects the member found in the most crowded keys; all members are
   compared with it only (a star, never all pairs), first by the Jaccard estimate
   corrected for accidental register collisions, then on the full sets.
4. Members that are still apart from the elected one's component are compared with every
   member of the key that lies in another component, in blocks of registers (longer sketches here, made
   of the members only, so that the estimate is sharp). So
   no pair that shares a key and could join two components is left out, however
   large the key is, and pairs inside one component are never made.
5. Components of the confirmed links; the smallest id of each is kept.

With 32 bands of 5 registers a pair of similarity 0.85 shares no key with
probability (1 - 0.85^5)^32 = 7e-9 (0.8: 3e-6). Estimates within four standard
errors of the threshold go on to the exact test.

Empty or null texts have size 0 and are linked with nothing. Rows with a null id are
never linked: component null, kept true. Rows that share an id are one document
(``keep_one_per_group`` tells them apart by text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.llm.graph import connected_components
from propensio.llm.text import mix, shingle_set
from propensio.session import materialize

BANDS, ROWS, MANTISSA = 32, 5, 10
BUCKETS = BANDS * ROWS
#: Buckets of the longer sketch that settles which pairs of a crowded key are worth the exact test; the first BUCKETS make the bands.
LONG = BUCKETS + 256
_FACTORS = np.random.default_rng(7).integers(1, 2**63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COLUMNS_AT_ONCE = 1024
#: Members of one key that meet in one task.
BLOCK = 2048


def registers(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """One 16-bit register per bucket: exponent (53 - leading zeros) and mantissa of the smallest hash."""
    low = np.full(buckets, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), _COLUMNS_AT_ONCE):
        part = hashes[None, at : at + _COLUMNS_AT_ONCE] * _FACTORS[:buckets, None]
        np.minimum(low, part.min(axis=1), out=low)
    cells = ((low >> np.uint64(11)).astype(np.float64).view(np.int64) >> (52 - MANTISSA)) - (1023 << MANTISSA)
    return np.maximum(cells, 0).astype(np.uint16)


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard from the share of equal registers, less the accidental collisions.

    Smallest hashes of disjoint sets are exponential with rates n_a and n_b and fall
    into one register cell with probability n_a n_b / (n_a + n_b)^2 times the mean
    relative cell width, 2^-10 / (2 ln 2).
    """
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    chance = n_a * n_b / (n_a + n_b) ** 2 * (0.5 / np.log(2) / 2**MANTISSA)
    return (equal - chance) / (1 - chance)


def _cut(threshold: float, buckets: int = BUCKETS) -> float:
    """Four standard errors under the threshold."""
    return threshold - 4 * np.sqrt(threshold * (1 - threshold) / buckets)


def _sketches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, f1, f2, regs = [], [], [], []
            for text in pdf["text"]:
                s = shingle_set(text, width)
                n.append(len(s))
                f1.append(int(mix(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(mix(s * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).view(np.int64)))
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"id": pdf["id"], "n": n, "f1": f1, "f2": f2, "regs": regs})

    return run


def _sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t, width) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "grams": [s.tobytes() for s in sets], "regs": [registers(s, LONG).tobytes() for s in sets]})

    return run


def _estimated(threshold: float):
    cut = _cut(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(pdf[c]), dtype=np.uint16).reshape(-1, BUCKETS) for c in ("regs_a", "regs_b"))
                good = estimate((a == b).mean(axis=1), pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy()) >= cut
                yield pdf.loc[good, ["a", "b"]]

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = []
            for x, y in zip(pdf["grams_a"], pdf["grams_b"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[good, ["a", "b"]]

    return run


def _left_over(percent: int):
    cut = _cut(percent / 100, LONG)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Pairs of one block (``member`` rows) and one chunk of the key's members that lie apart."""
        band, one = int(pdf["band"].iloc[0]), pdf["member"].to_numpy()

        def side(rows: pd.DataFrame):
            regs = np.frombuffer(b"".join(rows["regs"]), dtype=np.uint16).reshape(-1, LONG)
            return regs, rows["id"].to_numpy(), rows["n"].to_numpy(), rows["comp"].to_numpy(), rows["apart"].to_numpy()

        regs, ids, n, comp, apart = side(pdf[one])
        bands = regs[:, :BUCKETS].reshape(-1, BANDS, ROWS)
        out_a, out_b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for reg, x, nx, cx, _ in zip(*side(pdf[~one]), strict=True):
            size_ok = 100 * np.minimum(n, nx) >= percent * np.maximum(n, nx)
            js = np.flatnonzero(size_ok & (comp != cx) & ~(apart & (ids <= x)))
            js = js[estimate((regs[js] == reg).mean(axis=1), n[js], np.full(len(js), nx)) >= cut] if len(js) else js
            if band:  # a pair that shares several keys is made under the first one only
                js = js[~(bands[js, :band] == reg[:BUCKETS].reshape(BANDS, ROWS)[:band]).all(axis=2).any(axis=1)]
            out_a.append(np.full(len(js), x))
            out_b.append(ids[js])
        return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    sides = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a")), "a"
    )
    return sides.mapInPandas(_confirmed(percent), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept`` (see the module's text).

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|``.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = materialize(base.mapInPandas(_sketches(width), "id long, n long, f1 long, f2 long, regs binary"), "sketches")
    classes = materialize(
        sketch.where("n > 0 and id is not null").groupBy("f1", "f2", "n").agg(F.min("id").alias("id"), F.first("regs").alias("regs")), "classes"
    )
    band = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(regs, b * {2 * ROWS} + 1, {2 * ROWS})))")
    keyed = classes.select("id", "n", F.posexplode(band).alias("band", "key"))
    crowd = keyed.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    members = materialize(keyed.join(crowd, "key"), "band-members")

    # the star of each key: its members against the one found in the most crowded keys
    fame = members.groupBy("id").agg(F.sum("crowd").alias("fame"))
    known = members.join(fame, "id")
    elected = known.groupBy("key").agg(F.max(F.struct("fame", (-F.col("id")).alias("neg"))).alias("top")).select("key", (-F.col("top.neg")).alias("centre"))
    starred = members.join(elected, "key")
    slim = classes.select("id", "n", "regs")
    pairs = (
        starred.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
        .join(slim.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b")), "b")
        .join(slim.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a")), "a")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .mapInPandas(_estimated(percent / 100), "a long, b long")
    )
    wanted = members.select("id").distinct()
    sets = materialize(base.join(wanted, "id", "left_semi").mapInPandas(_sets(width), "id long, grams binary, regs binary").dropDuplicates(["id", "grams"]), "shingle-sets")
    star_links = materialize(_confirm(pairs, sets, percent), "star-links")

    # what the stars left apart, in blocks
    comp = connected_components(star_links)
    placed = starred.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    main = placed.where("id = centre").select("key", F.col("comp").alias("main"))
    placed = materialize(placed.join(main, "key").withColumn("apart", F.expr("comp <> main")), "placed")
    lone = placed.where("apart").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    rest = placed.join(lone, "key").withColumn("blocks", F.ceil(F.col("crowd") / BLOCK).cast("int"))
    cell = ["key", "band", "id", "n", "comp", "apart"]
    members_to = rest.select(*cell, F.expr("pmod(xxhash64(id), blocks)").cast("int").alias("block"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), F.lit(True).alias("member"))
    apart_to = rest.where("apart").select(*cell, F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.expr("pmod(xxhash64(id), chunks)").cast("int").alias("chunk"), F.lit(False).alias("member"))
    blocks = members_to.unionByName(apart_to).join(sets.select("id", "regs"), "id")
    more = blocks.groupBy("key", "block", "chunk").applyInPandas(_left_over(percent), "a long, b long")
    links = star_links.unionByName(_confirm(materialize(more.distinct(), "left-over-pairs"), sets, percent))

    final = connected_components(links)
    by_class = classes.join(final.withColumnRenamed("node", "id"), "id", "left").select("f1", "f2", "n", F.coalesce("component", "id").alias("component"))
    return (
        sketch.join(by_class, ["f1", "f2", "n"], "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def keep_one_per_group(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns unchanged.

    Repeated rows of one id and equal text are one document: one row stays. Rows that share an id
    but not the text are documents of their own; all but one of them stand behind the other ids. Rows with a null id stay.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[id_col].cast("long").alias("ident"), docs[text_col].cast("string").alias("body"))
    rows = rows.withColumn("h", F.xxhash64("body"))
    texts = rows.where("ident is not null").groupBy(F.col("ident").alias("shared"))
    shared = materialize(texts.agg(F.min("h").alias("first"), F.max("h").alias("last")).where("first <> last").select("shared", "first"), "shared-ids")
    own = F.lit(1 << 62) + F.xxhash64("ident", "h").bitwiseAND((1 << 61) - 1)
    keyed = rows.join(shared, F.col("ident") == F.col("shared"), "left")
    keyed = keyed.withColumn("key", F.when(F.col("h") != F.col("first"), own).otherwise(F.col("ident"))).select("row", "body", "key")
    gone = near_duplicates(keyed, percent, width, "key", "body").where("not kept").select(F.col("key").alias("gone")).distinct()
    again = keyed.groupBy(F.col("key").alias("again")).count().where("count > 1 and again is not null").select("again")
    kept = keyed.select("row", "key").join(gone, F.col("key") == F.col("gone"), "left_anti")
    same = F.col("key") == F.col("again")
    kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["key"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])
