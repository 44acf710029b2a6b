"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, rerank.

* Equal vectors of one label are one class; classes are compared, counts carry over.
* ITQ: principal directions of a bounded sample (``SAMPLE`` vectors) are rotated in turns with
  the sign codes (orthogonal Procrustes) until the codes are balanced; several
  rotations from different starts give independent codes.
* Multi-index tables: each code is cut into substrings; vectors of one label that share a substring meet. The
  substring grows with the logarithm of the largest label, and the number of tables
  follows from it: a pair at the threshold angle differs in a bit with probability angle / pi, so tables are added until it
  shares a substring with probability 1 - ``MISS``. Every vector is in every table.
* Rerank: within a bucket, blocks of at most ``BLOCK`` vectors are compared by cosine in double precision.
  A pair that shares several buckets counts in the first only. A block gives each vector's number of links and
  the smallest vector of its component in the block, never pairs, so a crowded bucket costs rows, not squares of rows, in
  the shuffle, and its blocks spread over tasks.

Null vectors, zero vectors and vectors with null or non-finite components, and those with a null label or id, link with nothing; they are
returned with 0 links as their own component (null for a null id). Vectors of other lengths than the commonest are compared with equal
lengths only and exactly among themselves by the same tables over their first components. Repeated rows (equal id) link like copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.llm.graph import connected_components
from propensio.session import materialize

SAMPLE, ROUNDS, BLOCK, MISS, CROWD = 10_000, 30, 1024, 0.002, 24


def learn_rotations(sample: np.ndarray, n_codes: int, seed: int = 3) -> np.ndarray:
    """(n_codes, dim, dim) projections: principal directions times an ITQ rotation; sample rows have unit length."""
    dim = sample.shape[1]
    rng = np.random.default_rng(seed)
    if len(sample) > 1:  # from the dim x dim scatter: a full decomposition of the sample would be sample x sample large
        centred = sample - sample.mean(axis=0)
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
    else:
        axes = np.eye(dim)
    v = sample @ axes
    out = []
    for _ in range(n_codes):
        r, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return np.stack(out)


def plan_tables(n_largest: int, dim: int, threshold: float) -> tuple[int, int]:
    """Substring width and number of tables for ``MISS`` at the threshold angle."""
    flip = float(np.arccos(threshold) / np.pi)
    width = int(np.clip(np.round(np.log2(max(2, n_largest / CROWD))), 4, min(24, dim)))
    hit = (1 - flip) ** width
    return width, int(np.ceil(np.log(MISS) / np.log(1 - hit))) if hit < 1 else 1


def _keys(x: np.ndarray, rotations: np.ndarray, width: int, tables: int) -> np.ndarray:
    """(n, tables) substring values of unit vectors."""
    dim = x.shape[1]
    per_code = dim // width
    bits = np.concatenate([(x @ r >= 0)[:, : per_code * width] for r in rotations], axis=1)
    cells = bits.reshape(len(x), -1, width)[:, :tables].astype(np.int64)
    return cells @ (1 << np.arange(width, dtype=np.int64))


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # by a power of two, so squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _with_keys(rotations, width: int, tables: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                pdf = pdf.assign(keys=list(_keys(_unit(list(pdf["v"])), rotations.value, width, tables)))
                yield pdf

    return run


def _block_links(rotations, width: int, tables: int, threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links between the two sides of a block pair (one side when both are the same block)."""
        table = int(pdf["table"].iloc[0])
        same = bool(pdf["block"].iloc[0] == pdf["other"].iloc[0])
        left = pdf[pdf["home"] == pdf["block"]]
        right = left if same else pdf[pdf["home"] == pdf["other"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "links": [], "low": []}).astype("int64")
        x, y = _unit(list(left["v"])), _unit(list(right["v"]))
        linked = x @ y.T >= threshold
        if same:
            np.fill_diagonal(linked, False)
        i, j = np.nonzero(linked)
        if table and len(i):  # counted in the first table that the pair shares
            kx, ky = (_keys(z, rotations.value, width, table) for z in ((x, y) if not same else (x, x)))
            fresh = ~(kx[i] == ky[j]).any(axis=1)
            i, j = i[fresh], j[fresh]
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        na, nb = left["copies"].to_numpy(), right["copies"].to_numpy()
        ids = np.concatenate([a[i], b[j]] if not same else [a[i]])
        links = np.concatenate([nb[j], na[i]] if not same else [nb[j]])
        nodes, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
        low, u, w = np.arange(len(nodes)), at[: len(i)], at[len(i) :]
        while True:  # smallest node reached inside the block
            new = low.copy()
            np.minimum.at(new, u, low[w])
            np.minimum.at(new, w, low[u])
            new = np.minimum(new, new[new])
            if (new == low).all():
                break
            low = new
        got, pos = np.unique(ids, return_inverse=True)
        total = np.bincount(pos, links, len(got)).astype(np.int64)
        return pd.DataFrame({"id": got, "links": total, "low": nodes[low[np.searchsorted(nodes, got)]]})

    return run


def embedding_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.expr("v is not null and size(v) > 0 and id is not null and label is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
    base = base.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("h", F.when(F.col("sound"), F.xxhash64("v")))
    base = materialize(base, "vectors")
    classes = base.where("sound").groupBy("label", "h").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min_by("v", "id").alias("v"))
    classes = materialize(classes.withColumn("dim", F.size("v")), "vector-classes")
    found = [r for r in classes.groupBy("dim", "label").count().groupBy("dim").agg(F.max("count").alias("most"), F.sum("count").alias("all")).collect()]
    parts = []
    for r in found:  # one pass per vector length, in practice one
        own, dim = classes.where(F.col("dim") == r["dim"]), r["dim"]
        share = min(1.0, SAMPLE / r["all"])
        picked = own.where(F.expr("pmod(xxhash64(id, 17), 1048576)") < share * 1048576).select("v").toPandas()["v"]
        width, tables = plan_tables(r["most"], dim, threshold)
        codes = int(np.ceil(tables / (dim // width)))
        sample = _unit(list(picked)) if len(picked) else np.eye(dim)
        rotations = spark.sparkContext.broadcast(learn_rotations(sample, codes))
        keyed = own.select("id", "label", "copies", "v").mapInPandas(_with_keys(rotations, width, tables), "id long, label string, copies long, v array<double>, keys array<long>")
        rows = keyed.select("id", "label", "copies", "v", F.posexplode("keys").alias("table", "key"))
        crowd = rows.groupBy("label", "table", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
        rows = rows.join(crowd.drop("n"), ["label", "table", "key"]).withColumn("home", F.expr("pmod(xxhash64(id), blocks)").cast("int"))
        # a row meets every block of its bucket once: pairs (low block, high block)
        spread = rows.withColumn("mate", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("block", F.least("home", "mate")).withColumn("other", F.greatest("home", "mate"))
        out = spread.groupBy("label", "table", "key", "block", "other").applyInPandas(_block_links(rotations, width, tables, threshold), "id long, links long, low long")
        parts.append(out)
    if not parts:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = parts[0]
    for p in parts[1:]:
        links = links.unionByName(p)
    links = materialize(links, "vector-links")
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    comp = connected_components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    by_class = classes.join(counts, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    by_class = by_class.select("label", "h", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    joined = base.select("id", "label", "h").join(by_class, ["label", "h"], "left")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
