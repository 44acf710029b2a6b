"""Exact top-k search: tiled matrix products, a selection per tile, a tree that merges the lists.

* Components become whole numbers floor(scale * x); the score is their inner product, exact.
* Queries are dealt evenly into blocks of at most about ``BLOCK``, candidates into shards; each is packed into one binary row. Every
  (block, shard) pair is one group that reads one row of either side, so memory is bounded by the two sizes and no
  key is hot. Nothing is broadcast.
* A pair is worked off in tiles of ``TILE`` query rows: one matrix product in doubles, which is exact below 2^53, and a partial
  selection of the k best by (score, position), candidates being sorted by id. Larger components take Python integers.
* Lists of ``FAN`` shards are merged at a time until one list a query is left.

Vectors that are null or hold null or non-finite components take no part. Rows with the query's own id are never its results; a
repeated query row gets its list again, repeated candidates are rows of their own. Null ids are candidates (last
among ties) and never queries. Vectors of different length aren't compared. A score beyond a long is cut to the nearest long. Fewer
candidates than k give fewer rows, none give none; empty tables give an empty result. Further columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, K = 64, 20
BLOCK = SHARD = 16_384
TILE, FAN = 256, 16
_MOST = 2**63 - 1
_PACKED = "dim int, part int, wide boolean, ids binary, nulls binary, cells binary"
_LISTS = "dim int, block int, part int, queries binary, ids binary, nulls binary, scores binary, counts binary"


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in text.split(", "))])


def _pack(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each vector length of a partition: ids in order (nulls last) and components."""
        from pyspark import TaskContext

        held: dict[int, list[tuple]] = {}
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            known = ids.fill_null(0).to_numpy(zero_copy_only=False)
            lens = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lens)))
            for dim in np.unique(lens):
                rows = np.flatnonzero(lens == dim)
                cells = flat[at[rows][:, None] + np.arange(dim)] if dim else np.empty((len(rows), 0))
                held.setdefault(int(dim), []).append((known[rows], null[rows], cells))
        part = TaskContext.get().partitionId()
        for dim, parts in held.items():
            ids, null, cells = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((ids, null))
            whole = np.floor(scale * cells)
            wide = bool(np.abs(whole).max(initial=0) >= 2**31)  # kept as given: turned into Python integers when used
            blob = (cells[order].astype("<f8") if wide else whole[order].astype("<i4")).tobytes()
            row = {"dim": [dim], "part": [part], "wide": [wide], "ids": [ids[order].astype("<i8").tobytes()], "nulls": [null[order].tobytes()], "cells": [blob]}
            yield pa.RecordBatch.from_pydict(row, schema=_schema(_PACKED))

    return run


def _whole(value: float, scale: int) -> int:
    return math.floor(value * scale) if abs(value) < 2.0**900 else int(value) * scale


def _unpack(row: dict, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, null flags, rows x dim components (doubles, or Python integers)."""
    ids, null = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], bool)
    if not row["wide"]:
        return ids, null, np.frombuffer(row["cells"], "<i4").reshape(len(ids), row["dim"]).astype(np.float64)
    cells = np.frombuffer(row["cells"], "<f8").reshape(len(ids), row["dim"])
    whole = np.array([_whole(c, scale) for c in cells.ravel().tolist()], dtype=object).reshape(cells.shape)
    return ids, null, whole


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products as longs: by doubles where those are exact, else by Python integers, cut to a long."""
    top = [max((abs(int(m)) for m in (z.min(initial=0), z.max(initial=0))), default=0) for z in (x, y)]
    if x.dtype != object and y.dtype != object and top[0] * top[1] * max(1, x.shape[1]) < 2**53:
        return (x @ y.T).astype(np.int64)
    a, b = (np.frompyfunc(int, 1, 1)(z).astype(object) for z in (x, y))
    out = np.zeros((len(a), len(b)), dtype=object)
    for d in range(a.shape[1]):
        out += np.multiply.outer(a[:, d], b[:, d])
    return np.array([max(-_MOST, min(_MOST, s)) for s in out.ravel().tolist()], dtype=np.int64).reshape(out.shape)


def _best_of_tile(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of each row, best first, the left column first among equals; -1 where fewer are left.

    ``own`` has the first and last+1 column of each row that it may not have.
    """
    width = scores.shape[1]
    if int(np.abs(scores).max(initial=0)) < 2**62 // max(1, width):
        keys = scores * width + (width - 1 - np.arange(width))
        lowest = np.int64(-_MOST)
        for i in np.flatnonzero(own[1] > own[0]):
            keys[i, own[0][i] : own[1][i]] = lowest
        if width > k:
            at = np.argpartition(keys, width - k, axis=1)[:, width - k :]
        else:
            at = np.broadcast_to(np.arange(width), keys.shape)
        got = np.take_along_axis(keys, at, 1)
        order = np.argsort(-got, axis=1, kind="stable")
        return np.where(np.take_along_axis(got, order, 1) == lowest, -1, np.take_along_axis(at, order, 1))
    free = np.ones(scores.shape, dtype=bool)
    for i in np.flatnonzero(own[1] > own[0]):
        free[i, own[0][i] : own[1][i]] = False
    order = np.lexsort((np.broadcast_to(np.arange(width), scores.shape), -scores, ~free), axis=1)[:, :k]
    return np.where(np.take_along_axis(free, order, 1), order, -1)


def _lists_row(dim: int, block: int, part: int, queries: np.ndarray, ids: np.ndarray, null: np.ndarray, scores: np.ndarray, counts: np.ndarray) -> pa.Table:
    row = {"dim": [dim], "block": [block], "part": [part], "queries": [queries.astype("<i8").tobytes()], "ids": [ids.astype("<i8").tobytes()], "nulls": [null.astype(bool).tobytes()]}
    row |= {"scores": [scores.astype("<i8").tobytes()], "counts": [counts.astype("<i4").tobytes()]}
    return pa.Table.from_pydict(row, schema=_schema(_LISTS))


def _search_pair(k: int, scale: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k best of one shard (left) for each query of one block (right)."""
        if not left.num_rows or not right.num_rows:
            return _schema(_LISTS).empty_table()
        shard, block = left.to_pylist()[0], right.to_pylist()[0]
        ids, null, y = _unpack(shard, scale)
        queries, _, x = _unpack(block, scale)
        known = ids[~null]  # nulls stand last
        keep = min(k, len(ids))
        at = np.empty((len(queries), keep), dtype=np.int64)
        values = np.empty((len(queries), keep), dtype=np.int64)
        for lo in range(0, len(queries), TILE):
            q = queries[lo : lo + TILE]
            scores = _products(x[lo : lo + TILE], y)
            own = np.stack([np.searchsorted(known, q), np.searchsorted(known, q, "right")])
            best = _best_of_tile(scores, own, k)[:, :keep]
            at[lo : lo + TILE] = best
            values[lo : lo + TILE] = np.take_along_axis(scores, np.maximum(best, 0), 1)
        real = at >= 0
        return _lists_row(shard["dim"], block["block"], shard["shard"], queries, ids[at[real]], null[at[real]], values[real], real.sum(axis=1))

    return run


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        """One list a query out of the lists of several shards."""
        rows = table.to_pylist()
        queries = np.frombuffer(rows[0]["queries"], "<i8")
        if len(rows) == 1:
            return table.set_column(table.schema.get_field_index("part"), "part", pa.array([rows[0]["part"] // FAN], pa.int32())).cast(_schema(_LISTS))
        of = np.concatenate([np.repeat(np.arange(len(queries)), np.frombuffer(r["counts"], "<i4")) for r in rows])
        ids, scores = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows]) for c in ("ids", "scores"))
        null = np.concatenate([np.frombuffer(r["nulls"], bool) for r in rows])
        order = np.lexsort((ids, null, -scores, of))
        first = np.searchsorted(of[order], np.arange(len(queries)))
        order = order[np.arange(len(order)) - first[of[order]] < k]
        counts = np.bincount(of[order], minlength=len(queries))
        return _lists_row(rows[0]["dim"], rows[0]["block"], rows[0]["part"] // FAN, queries, ids[order], null[order], scores[order], counts)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], "<i4")
            of = np.repeat(np.arange(len(counts)), counts)
            rank = np.arange(len(of)) - (np.cumsum(counts) - counts)[of] + 1
            columns = [
                pa.array(np.frombuffer(row["queries"], "<i8")[of]),
                pa.array(rank.astype(np.int32)),
                pa.array(np.frombuffer(row["ids"], "<i8"), mask=np.frombuffer(row["nulls"], bool)),
                pa.array(np.frombuffer(row["scores"], "<i8")),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "rank", "id", "score"])


def exact_top_k(queries: DataFrame, candidates: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` best candidates of every query."""
    spark = candidates.sparkSession

    def thin(df: DataFrame) -> DataFrame:
        out = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        return out.where("v is not null and forall(v, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")

    n, m = candidates.count(), queries.where(F.col(id_col).isNotNull()).count()  # reads no vectors
    slots = 2 * spark.sparkContext.defaultParallelism
    shards = max(1, math.ceil(n / SHARD), min(slots, math.ceil(n / 1024)))
    blocks = max(1, math.ceil(m / BLOCK))
    right = thin(candidates).repartition(shards).mapInArrow(_pack(scale), _PACKED).withColumnRenamed("part", "shard")
    left = thin(queries).where("id is not null").repartition(blocks).mapInArrow(_pack(scale), _PACKED).withColumnRenamed("part", "block")
    # every block meets every shard of its length once: the stated query set against all rows, in packed blocks
    shard_side = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block_side = left.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["dim", "block", "shard"]
    lists = shard_side.groupBy(*keys).cogroup(block_side.groupBy(*keys)).applyInArrow(_search_pair(k, scale), _LISTS)
    while shards > 1:
        lists = lists.groupBy("dim", "block", F.expr(f"part div {FAN}").alias("run")).applyInArrow(_merge(k), _LISTS)
        shards = math.ceil(shards / FAN)
    return lists.mapInArrow(_rows, "query_id long, rank int, id long, score long").withColumnRenamed("id", id_col)
