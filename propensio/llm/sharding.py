"""Sharding by proportional stratified interleaving (law ``rows``).

Rows are shuffled by a seeded hash inside their source; the rank r of n rows gives the
fractional rank (2r - 1) / (2n). Rows in the order of their fractional ranks form a sequence in
which every stretch has the sources in the mixture's proportions, and cutting it into equal
stretches gives shards whose counts differ by one at most and whose rows of a source
do too, but for rounding.

The hash starts with 20 bits of the text's own hash, so equal texts have neighbouring fractional ranks in each source
and share a shard as far as equal counts allow.

Ranks come from a range-partitioned sort and the partitions' counts, never from one
task per source: a source with a third of all rows spreads over as many tasks as its rows
need, and so does one text repeated very often, because ids refine the hash. Null
sources form a stratum of their own, null texts have size 1 and no checksum, repeated rows get slots of their own; rows that
tie in every value change places without any effect. An empty table gives an empty result.

A group of equal texts stays in one shard unless the cut between two shards falls into it: of ``n`` shards, a source can
part at most ``n - 1`` of its groups at cuts, and a group whose texts lie in several sources is parted where their ranks lie apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensio.session import materialize


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _positions(df: DataFrame, order: list, within: list[str], name: str) -> DataFrame:
    """Add ``rank`` (from 1, within the leading order columns ``within``) by a range sort and partition counts."""
    kept = df.columns
    dealt = df.repartitionByRange(_partitions(df), *order).sortWithinPartitions(*order)
    laid = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND((1 << 33) - 1))
    # (partition, stratum) pairs: at most partitions + strata of them
    cells = laid.groupBy("_part", *within).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cells = cells.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_in_{c}") for c in within], "_first", "_before")
    same = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in within]]
    joined = laid.join(cells, same)
    return joined.select(*kept, (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("rank"))


def shard(
    docs: DataFrame, n_shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Per row: id, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``law``, ``shard``, ``slot`` (from 0, without gaps), ``grown_shard`` (null)."""
    text, ident = F.col(text_col).cast("string"), F.col(id_col)
    thin = docs.select(
        ident.alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.col(source_col).cast("string").alias("source"),
        F.concat(
            F.substring(F.md5(F.coalesce(F.concat(F.lit(f"{seed}|"), text), F.lit("null"))), 1, 5),
            F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("null")))),
        ).alias("mixed"),
    )
    thin = materialize(thin, "shard-rows")
    ranked = _positions(thin, ["source", "mixed", "id", "bytes", "crc"], ["source"], "shard-ranks")
    sizes = thin.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "_of")
    ranked = ranked.join(sizes, F.col("source").eqNullSafe(F.col("_of"))).select("id", "bytes", "crc", "source", "mixed", ((2 * F.col("rank") - 1) / F.col("n")).alias("part"))
    placed = _positions(ranked.withColumn("_all", F.lit(1)), ["_all", "part", "source", "mixed", "id", "bytes", "crc"], ["_all"], "shard-order")
    total = thin.agg(F.count("*").alias("rows"))  # one row
    small, extra = F.expr(f"rows div {n_shards}"), F.expr(f"rows % {n_shards}")
    at = F.col("rank") - 1
    wide = extra * (small + 1)
    cut = F.when(at < wide, F.expr(f"(rank - 1) div (rows div {n_shards} + 1)")).otherwise(
        F.expr(f"(rank - 1 - (rows % {n_shards}) * (rows div {n_shards} + 1)) div greatest(rows div {n_shards}, 1L) + rows % {n_shards}")
    )
    start = F.col("shard") * small + F.least("shard", extra)
    return (
        placed.crossJoin(F.broadcast(total)).withColumn("shard", cut.cast("long"))
        .select(F.col("id").alias(id_col), (F.col("bytes") + 1).alias("size"), F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                F.col("shard").cast("int").alias("shard"), (at - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
