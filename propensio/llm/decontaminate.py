"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Texts become word tokens (lower case, letters and digits) and 64-bit token hashes. A document and an item are aligned
at a shift (document position minus item position). They overlap when some stretch of an alignment has at least
``min_tokens`` tokens (or all of a shorter item's) and at least ``min_share`` of its tokens agree, wherever the other tokens lie.

Seeds of five fixed masks of 5 positions in a span of at most 9 are joined on their hash. For the default
limits the masks lose nothing: however the disagreeing tokens lie in such a stretch, one mask fits between them (any good
stretch holds one of less than twice the least length; ``test_decontamination_masks_cover_every_pattern`` tries all patterns).
So the overlaps are those of a full comparison. Other limits keep the exact test, but a smaller share may lose alignments without a seed.
Every alignment with a seed is compared token by token around its seeds in one pass, and the stretch with the most agreeing tokens beyond ``min_share``
of its length is reported, one per alignment. A bad stretch between two quotes therefore spoils neither.

The benchmark's seeds are broadcast only when they stand in at most ``BROADCAST_PLACES`` places;
beyond that the seeds are shuffled. A document's position meets at most the items that hold the
same seed. Items of one to eight tokens, too short for a mask, overlap where all of
their tokens stand in a row: runs of each such length are joined with the items by hash. Null and empty texts
match nothing; an empty table on either side gives no overlap; repeated rows and rows that share an id are checked each by itself, the result has each pair once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize

SPAN = 9
#: Kept offsets of the masks.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8), (0, 3, 4, 5, 6), (0, 1, 2, 6, 8), (0, 1, 3, 4, 5))
#: Places (item and position) of seeds that are broadcast at most.
BROADCAST_PLACES = 1_000_000
MIN_TOKENS, MIN_SHARE = 12, 0.75


def token_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(df: DataFrame, keep: str, tokens: Column) -> DataFrame:
    """``keep``, ``pos`` and ``seed``: the seeds of all masks that fit at each position; texts of fewer than ``SPAN`` tokens have none."""
    spread = df.select(keep, tokens.alias("w")).where(F.size("w") >= SPAN)
    # SPAN - 1 empty places at the end, so that the short masks reach the last tokens
    padded = F.concat("w", F.array_repeat(F.lit(None).cast("bigint"), SPAN - 1))
    spread = spread.select(keep, F.size("w").alias("n"), padded.alias("w"))
    places = F.arrays_zip(*[F.slice("w", F.lit(o + 1), F.col("n")).alias(f"t{o}") for o in range(SPAN)])
    spread = spread.select(keep, "n", F.posexplode(places).alias("pos", "t"))
    marks = [
        F.when(F.col("pos") + mask[-1] < F.col("n"), F.xxhash64(F.lit(m), *[F.col(f"t.t{o}") for o in mask]))
        for m, mask in enumerate(MASKS)
    ]
    return spread.select(keep, "pos", F.explode(F.array(*marks)).alias("seed")).where("seed is not null")


def _best_stretch(min_tokens: int, min_share: float) -> Column:
    """Struct (surplus, span, first, matched) of the best stretch between ``lo`` and ``hi``, one pass over the ends ``e`` of stretches.

    ``t`` counts the agreeing tokens before e, ``d`` those before the last start that leaves the least length ``m``, and ``low`` is the
    start with the smallest d - share * length up to there.
    """
    equal = "if(w[{0}] = b[{0} - shift], 1, 0)"
    head = f"aggregate(sequence(lo, lo + m - 1), 0, (n, i) -> n + {equal.format('i')})"
    start = f"named_struct('t', {head}, 'd', 0, 'low', named_struct('under', 0D, 'at', lo, 'd', 0), 'best', named_struct('surplus', -1D, 'span', 0, 'first', 0, 'matched', 0))"
    surplus = f"(s.t - {min_share}D * (e - lo)) - s.low.under"
    best = f"greatest(s.best, named_struct('surplus', round({surplus}, 6), 'span', e - s.low.at, 'first', s.low.at, 'matched', s.t - s.low.d))"
    gone = f"(s.d + {equal.format('(e - m)')})"
    low = f"least(s.low, named_struct('under', {gone} - {min_share}D * (e - m + 1 - lo), 'at', e - m + 1, 'd', {gone}))"
    step = f"named_struct('t', s.t + if(e < hi, {equal.format('e')}, 0), 'd', {gone}, 'low', {low}, 'best', {best})"
    return F.expr(f"aggregate(sequence(lo + m, hi), {start}, (s, e) -> {step}, s -> s.best)")


def _row_key(id_col: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("null")), text)


def _short_overlaps(base: DataFrame, items: DataFrame) -> DataFrame:
    """Whole items of fewer than ``SPAN`` tokens, found as runs of equal tokens. Columns as in ``find_overlaps``."""
    short = items.where(F.size("b").between(1, SPAN - 1)).select("item", F.size("b").alias("span"), F.xxhash64("b").alias("run"))
    lengths = sorted(r["span"] for r in short.select("span").distinct().collect())  # eight at most
    words = base.select("row_key", "id", token_hashes(F.col("text")).alias("w")).where(F.size("w") >= lengths[0])
    spread = words.select("row_key", "id", "w", F.posexplode("w").alias("first", "_head"))
    runs = F.array(*[F.when(F.col("first") + n <= F.size("w"), F.struct(F.lit(n).alias("span"), F.xxhash64(F.slice("w", F.col("first") + 1, n)).alias("run"))) for n in lengths])
    found = spread.select("row_key", "id", "first", F.explode(runs).alias("r")).where("r is not null").select("row_key", "id", "first", "r.span", "r.run")
    if short.count() <= BROADCAST_PLACES:
        short = F.broadcast(short)
    return found.join(short, ["run", "span"]).select("row_key", "id", "item", "first", F.lit(0).alias("item_first"), "span", F.col("span").alias("matched"))


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS, min_share: float = MIN_SHARE,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Verified overlaps, the best of each alignment: row key, id, item, first token positions, tokens compared (``span``) and equal (``matched``)."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    base = base.select(_row_key(F.col("id"), F.col("text")).alias("row_key"), "id", "text")
    items = benchmark.select(F.col(item_col).alias("item"), token_hashes(F.col(item_text_col).cast("string")).alias("b")).where("item is not null")
    items = materialize(items.dropDuplicates(), "benchmark-tokens")
    at_item = _seeds(items, "item", F.col("b")).select("seed", F.struct("item", F.col("pos").alias("at")).alias("place"))
    by_seed = materialize(at_item.groupBy("seed").agg(F.collect_set("place").alias("places")), "benchmark-seeds")
    if (by_seed.agg(F.sum(F.size("places"))).collect()[0][0] or 0) <= BROADCAST_PLACES:
        by_seed = F.broadcast(by_seed)
    at_doc = _seeds(base, "row_key", token_hashes(F.col("text")))
    hits = at_doc.join(by_seed, "seed").select("row_key", "pos", F.explode("places").alias("place"))
    lines = (
        hits.groupBy("row_key", F.col("place.item").alias("item"), (F.col("pos") - F.col("place.at")).alias("shift"))
        .agg(F.min("pos").alias("first"), (F.max("pos") + SPAN).alias("past"))
    )
    lines = materialize(lines, "seed-lines")
    held = base.join(lines.select("row_key").distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])
    held = materialize(held.select("row_key", "id", token_hashes(F.col("text")).alias("w")), "seeded-tokens")
    margin = 2 * min_tokens  # farther from all seeds no stretch is good
    found = held.join(lines, "row_key").join(items, "item").select(
        "*",
        F.least(F.lit(min_tokens), F.size("b")).alias("m"),
        F.greatest(F.lit(0), F.col("shift"), F.col("first") - margin).alias("lo"),
        F.least(F.size("w"), F.col("shift") + F.size("b"), F.col("past") + margin).alias("hi"),
    )
    found = found.where("hi - lo >= m").withColumn("best", _best_stretch(min_tokens, min_share)).where("best.surplus >= 0")
    found = found.select("row_key", "id", "item", "best.first", (F.col("best.first") - F.col("shift")).alias("item_first"), "best.span", "best.matched")
    if items.where(F.size("b").between(1, SPAN - 1)).isEmpty():
        return found
    return found.unionByName(_short_overlaps(base, items))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``id_col, item_id, matched, span, n_overlaps``: each contaminated document and item once, with its longest overlap."""
    found = find_overlaps(docs, benchmark, **options)
    longest = found.groupBy("id", "item").agg(F.max(F.struct("matched", "span")).alias("best"), F.countDistinct("first", "item_first").alias("n_overlaps"))
    return longest.select(
        F.col("id").alias(options.get("id_col", "doc_id")), F.col("item").alias(options.get("item_col", "item_id")), "best.matched", "best.span", "n_overlaps"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, all columns unchanged."""
    bad = find_overlaps(docs, benchmark, **options).select(F.col("row_key").alias("_bad")).distinct()
    key = _row_key(docs[options.get("id_col", "doc_id")], docs[options.get("text_col", "text")].cast("string"))
    return docs.join(bad, key == bad["_bad"], "left_anti")
