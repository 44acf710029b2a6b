"""Mixing sources to target weights by Pareto order sampling, DataFrame functions only.

Sizes are words. The sources' targets share the whole of all sizes by weight; a
target stops at ``max_repeat`` times its source's size and the excess goes to the
others by weight (water level found from running sums over the sources).

Within a source each document gets floor(target / size) whole copies for
certain. The rest R of the target is a sample with unequal probabilities: inclusion p = min(1, c * words),
c solved so that the expected words are R, which makes long documents certain and lets the cut fall on
a short one. Documents are ranked by (u / (1 - u)) / (p / (1 - p)), u a seeded hash of the id,
the ranks up to R words are taken, and one document more, the one nearest to what is then open. No document has more than ``max_repeat`` copies.

No task holds a source: sizes are summed by (source, words) and run up bin by bin, and the cut is found in a
histogram of the ranking value, then in a finer one of the bin at the cut, so that only the values in one of its ``FINER`` parts are put in order.
Equal rows (source, id and size) rank together and are counted, not listed; the cut falls into one such group of a source at most, and
the wanted number of its rows is picked by running counts over the partitions that hold them.
Null texts and texts without words have size 0 and are never taken. Null sources are one source, the last. Repeated rows are
documents of their own, each takes its own share. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensio.session import materialize

WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
#: Bins of the ranking value per unit of its logarithm; values beyond 2^63 / 2^-63 share the outer ones.
BINS = 256
FINER = 4096
#: Rows of a table of sources, or of groups at their cuts, that are broadcast at most.
FEW = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(ident: Column, seed: int) -> Column:
    """Seeded uniform in (0, 1) from the id's text: (k + 0.5) / 2^48."""
    hexes = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("null")))), 1, 12)
    return (F.conv(hexes, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = 3) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; one row per source."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    listed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((order - 1) % len(weights) + 1).cast("int")))
    # sources are capped in the order of size / weight; k capped ones leave the level (total - caps) / other weights
    up = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, weight = F.sum("source_size").over(every), F.sum("w").over(every)
    level = (total - max_repeat * F.coalesce(F.sum("source_size").over(up), F.lit(0))) / (weight - F.coalesce(F.sum("w").over(up), F.lit(0.0)))
    listed = listed.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("w") <= max_repeat * F.col("source_size"), F.col("level"))
    listed = listed.withColumn("final", F.max(fits).over(every))
    return listed.select("source", "source_size", F.coalesce(F.least(F.col("final") * F.col("w"), (max_repeat * F.col("source_size")).cast("double")), (max_repeat * F.col("source_size")).cast("double")).alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = 3, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target`` (its source's words), ``taken`` (words taken, repeats counted)."""
    thin = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col).cast("string")).alias("size"))
    taken = mix_sizes(materialize(thin, "mix-rows"), weights, max_repeat, seed)
    return taken.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def pick_rows(rows: DataFrame, keys: list[str], wanted: str) -> DataFrame:
    """Adds ``picked``: 1 for the first ``wanted`` rows of each group, else 0; no group is gathered.

    The rows are written with their place; a group's rows are counted per written partition, and a row is numbered inside its
    partition only.
    """
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()), "mix-picks").withColumn("_part", F.shiftright("_place", 33))
    counts = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_held"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).drop("_held")
    inside = Window.partitionBy(*keys, "_part").orderBy("_place")
    same = [placed[k].eqNullSafe(counts[k]) for k in (*keys, "_part")]
    numbered = placed.withColumn("_number", F.row_number().over(inside)).join(counts, same).drop(*[counts[k] for k in (*keys, "_part")])
    return numbered.withColumn("picked", (F.col("_before") + F.col("_number") <= F.col(wanted)).cast("int")).drop("_place", "_part", "_before", "_number")


def mix_sizes(thin: DataFrame, weights: tuple[int, ...], max_repeat: int, seed: int) -> DataFrame:
    """``mix`` on rows ``id, source, size`` (sources equal null-safely), with ``source`` in the result."""
    thin = thin.withColumn("s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))  # a null-free key
    by_size = materialize(thin.groupBy("source", "s", "size").agg(F.count("*").alias("docs")), "mix-sizes")
    sums = by_size.groupBy("source", "s").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = source_targets(sums.select("source", "source_size"), weights, max_repeat)
    targets = targets.withColumn("s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    targets = targets.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    targets = materialize(targets.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")

    # c: with the documents above t words certain, the others' chance is c * words, c = (rest - certain words) / squares of the others
    cells = by_size.where("size > 0").select("s", "size", (F.col("size") * F.col("docs")).alias("words"), (F.col("size") * F.col("size") * F.col("docs")).cast("decimal(38,0)").alias("squares"))
    cells = cells.withColumn("step", F.floor(F.log2("size") * 64).cast("int"))
    steps = cells.groupBy("s", "step").agg(F.sum("words").alias("words"), F.sum("squares").alias("squares"))
    earlier = Window.partitionBy("s").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("s", "step", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words0"), F.coalesce(F.sum("squares").over(earlier), F.lit(0)).alias("squares0"))
    up = Window.partitionBy("s", "step").orderBy("size")
    cells = cells.withColumn("below", F.sum("words").over(up)).withColumn("squares", F.sum("squares").over(up)).join(steps, ["s", "step"])
    cells = cells.withColumn("below", F.col("below") + F.col("words0")).withColumn("squares", F.col("squares") + F.col("squares0"))
    cells = cells.join(targets.select("s", "source_size", "rest"), "s")
    c = (F.col("rest") - (F.col("source_size") - F.col("below"))) / F.col("squares").cast("double")
    cells = cells.withColumn("c", c)
    # the largest c whose own group stays within 1 is the solution; when none does, every document is certain
    chance = materialize(cells.where("c * size <= 1").groupBy("s").agg(F.max("c").alias("c")), "mix-chance")

    scored = (
        thin.join(targets, "s").join(chance, "s", "left")
        .withColumn("p", F.when(F.col("size") > 0, F.least(F.lit(1.0), F.coalesce(F.greatest("c", F.lit(0.0)) * F.col("size"), F.lit(1.0)))).otherwise(F.lit(0.0)))
        .withColumn("u", uniform(F.col("id"), seed))
        .withColumn("q", F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) * (1 - F.col("p")) / F.col("p")))
    )
    log_bin = F.floor(F.greatest(F.lit(-63.0), F.least(F.lit(63.0), F.log2("q"))) * BINS / 2)
    scored = materialize(scored.withColumn("bin", F.when(F.col("q") > 0, log_bin).when(F.col("q") == 0, F.lit(-(1 << 20))).cast("int")), "mix-ranks")

    # equal rows are one ranked group; groups run up to the rest of the target bin by bin, inside the bin at the cut part by part
    groups = materialize(scored.where("q is not null and rest > 0").groupBy("s", "id", "size", "q", "bin", "rest").agg(F.count("*").alias("rows")), "mix-groups")
    groups = groups.withColumn("words", F.col("size") * F.col("rows"))

    def cut_by(rows: DataFrame, keys: list[str], part: str) -> DataFrame:
        """``state`` of every group (in, out, cut) and the words ``before`` its part."""
        sums = rows.groupBy(*keys, part).agg(F.sum("words").alias("part_words"), F.first("rest").alias("part_rest"), F.first("start").alias("part_start"))
        running = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("part_start") + F.coalesce(F.sum("part_words").over(running), F.lit(0)))
        state = F.when(F.col("before") + F.col("part_words") <= F.col("part_rest"), "in").when(F.col("before") >= F.col("part_rest"), "out").otherwise("cut")
        return rows.drop("start").join(sums.select(*keys, part, "before", state.alias("state")), [*keys, part])

    coarse = materialize(cut_by(groups.withColumn("start", F.lit(0).cast("long")), ["s"], "bin"), "mix-coarse")
    within = F.log2("q") * BINS / 2 - F.col("bin")
    finer = coarse.where("state = 'cut'").withColumn("part", F.when(F.col("q") == 0, 0).otherwise(F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), within)) * FINER)).cast("int"))
    finer = cut_by(finer.withColumnRenamed("before", "start").drop("state"), ["s", "bin"], "part")
    inside = Window.partitionBy("s", "bin", "part").orderBy("q", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = finer.where("state = 'cut'").withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
    fit = F.greatest(F.lit(0), F.least(F.col("rows"), F.floor((F.col("rest") - F.col("before")) / F.col("size")))).cast("long")
    whole = F.when(F.col("state") == "in", F.col("rows")).otherwise(F.lit(0).cast("long"))
    held = ["s", "id", "size", "q", "rows", "rest"]
    plan = last.select(*held, fit.alias("extras"))
    for rows in (coarse, finer):
        plan = plan.unionByName(rows.where("state <> 'cut'").select(*held, whole.alias("extras")))
    plan = materialize(plan, "mix-plan")

    # what the cut leaves open goes to one row of the group not all drawn whose size comes nearest to it: one group per source
    gap = materialize(plan.groupBy("s").agg((F.max("rest") - F.sum(F.col("size") * F.col("extras"))).alias("gap")), "mix-gaps")
    gap = F.broadcast(gap) if gap.count() <= FEW else gap  # one row a source
    nearest = plan.where("extras < rows").join(gap, "s").where("abs(gap - size) < gap")
    nearest = nearest.groupBy("s").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "q", "id", "size")).alias("best"))
    nearest = nearest.select(F.col("s").alias("n_s"), F.col("best.id").alias("n_id"), F.col("best.size").alias("n_size"))
    fills = (F.col("s") == F.col("n_s")) & F.col("id").eqNullSafe(F.col("n_id")) & (F.col("size") == F.col("n_size"))
    plan = plan.join(nearest, fills, "left").withColumn("extras", F.col("extras") + F.col("n_s").isNotNull().cast("long")).select("s", "id", "size", "rows", "extras")
    plan = materialize(plan, "mix-extras")
    alike = plan.where("extras > 0 and extras = rows").select("s", "id", "size", F.lit(1).alias("extra"))
    parted = plan.where("extras > 0 and extras < rows")  # at most two groups per source
    base = scored.select("s", "source", "id", "size", "source_size", "target", "copies")

    def joined(rows: DataFrame, plans: DataFrame, how: str) -> DataFrame:
        right = plans.select(F.col("s").alias("p_s"), F.col("id").alias("p_id"), F.col("size").alias("p_size"), *[c for c in plans.columns if c not in ("s", "id", "size", "rows")])
        on = (F.col("s") == F.col("p_s")) & F.col("id").eqNullSafe(F.col("p_id")) & (F.col("size") == F.col("p_size"))
        return rows.join(right, on, how).drop("p_s", "p_id", "p_size")

    parted = F.broadcast(parted) if parted.count() <= FEW else parted
    rest_rows = joined(joined(base, parted.select("s", "id", "size"), "left_anti"), alike, "left").withColumn("extra", F.coalesce("extra", F.lit(0)))
    cut_rows = pick_rows(joined(base, parted, "inner"), ["s", "id", "size"], "extras").withColumnRenamed("picked", "extra").drop("extras")
    final = rest_rows.unionByName(cut_rows)
    copies = F.col("copies") + F.col("extra")
    return final.select("id", "source", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: every row of ``docs`` as often as the mix takes it, all columns unchanged.

    Rows without words are not part of a mix by words and go.
    """
    id_col, text_col = options.pop("id_col", "doc_id"), options.pop("text_col", "text")
    source_col = options.pop("source_col", "source")
    names = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), word_count(docs[text_col].cast("string")).alias("size"))
    taken = mix_sizes(materialize(row.select("id", "source", "size"), "mix-rows"), options.get("weights", WEIGHTS), options.get("max_repeat", 3), options.get("seed", 11))
    plan = taken.where("size > 0").groupBy("id", "source", "size").agg(F.min(F.expr("taken div size")).alias("least"), F.sum(F.expr("taken div size")).alias("total"), F.count("*").alias("rows"))
    plan = materialize(plan.where("total > 0").select(F.col("id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), "least", (F.col("total") - F.col("least") * F.col("rows")).alias("more")), "mix-copies")
    same = F.col("id").eqNullSafe(F.col("p_id")) & F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))
    even = row.join(plan.where("more = 0"), same).select("row", F.col("least").alias("copies"))
    parted = plan.where("more > 0")  # at most two groups per source; their rows meet them without a shuffle of the others
    parted = F.broadcast(parted) if parted.count() <= FEW else parted
    uneven = pick_rows(row.join(parted, same).drop("p_id", "p_source", "p_size"), ["id", "source", "size"], "more")
    copies = even.unionByName(uneven.select("row", (F.col("least") + F.col("picked")).alias("copies"))).where("copies > 0")
    repeated = copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in names])
