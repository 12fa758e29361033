"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.ranks import number_rows
from orderloom.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code-point order, repeating; a source is repeated at most so often.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Documents of a first group, and groups that meet in one of the next level.
GROUP_ROWS = 256
FAN_IN = 64
# Sources in one running sum.
SOURCE_RUN = 4096
# Documents are paired with others of about their size: so many classes to a factor of two.
_CLASSES = 4


def word_count(text: Column) -> Column:
    """Words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    The targets share the sum of all sizes by weight. None is above ``most`` times its source's
    size; what is cut off is shared again by weight among the others. With sources in the order of
    size over weight this needs one pass: the level that is shared out at last is the highest that
    any number of capped sources gives. Sources come in code-point order, null last.
    """
    totals = sizes.groupBy(source).agg(F.coalesce(F.sum(size), F.lit(0)).alias("source_size"))
    placed = number_rows(totals.withColumn("_none", F.col(source).isNull()), ["_none", source], column="_rank")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_rank") % len(weights) + 1).cast("int"))
    cap = (most * F.col("source_size")).cast("double")
    placed = placed.withColumn("_weight", weight).withColumn("_ratio", F.col("source_size") / F.col("_weight"))
    ordered = number_rows(placed, ["_ratio", "_rank"], column="_at").withColumn("_cap", cap)
    # Running sums inside runs of SOURCE_RUN sources, and over the runs: one row per run there.
    ordered = ordered.withColumn("_run", F.floor(F.col("_at") / SOURCE_RUN))
    runs = ordered.groupBy("_run").agg(F.sum("_cap").alias("_caps"), F.sum("_weight").alias("_weights"))
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_run",
        F.coalesce(F.sum("_caps").over(earlier), F.lit(0.0)).alias("_caps"),
        F.coalesce(F.sum("_weights").over(earlier), F.lit(0.0)).alias("_weights"),
    )
    inside = Window.partitionBy("_run").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda value, run: F.coalesce(F.sum(value).over(inside), F.lit(0.0)) + F.col(run)
    ordered = ordered.join(runs, "_run").select(
        source, "source_size", "_weight", "_cap", before("_cap", "_caps").alias("_capped"), before("_weight", "_weights").alias("_weighed")
    )
    ordered = materialise(ordered, "sources")
    whole = ordered.agg(F.sum("source_size").alias("words"), F.sum("_weight").alias("weights")).first()
    open_weight = F.lit(whole.weights) - F.col("_weighed")
    level = ordered.agg(F.max((F.lit(whole.words) - F.col("_capped")) / open_weight)).first()[0]
    target = F.greatest(F.lit(0.0), F.least("_cap", F.lit(level).cast("double") * F.col("_weight")))
    return ordered.select(source, "source_size", target.alias("target"))


def chosen(rows: DataFrame, seed: int) -> DataFrame:
    """Round fractional copies: the ``row`` values that get one copy more.

    ``rows`` has ``row`` (unique), ``source``, ``size`` and ``mass``: the words of it that the mix still
    wants, below its size. Within a group two documents at a time move mass until one has none or
    all of its words; the sum stays as it is, and the one left over goes on to the group of the next
    level. The last one of a source is rounded to the nearer side, so that a source misses its target
    by half a document at most. Groups are first of documents of a source and about one
    size, then of the left-over ones of ``FAN_IN`` groups, at last of a whole source. A group never
    holds more than that, however large a source is, and every outcome follows from hashes of
    ``row`` and ``seed``.
    """
    rows = rows.where("mass > 0").withColumn("class", F.floor(_CLASSES * F.log2(F.col("size") + 1)))
    groups = max(1, -(-rows.count() // GROUP_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)))
    taken, level, last = [], 0, False
    while not last:
        last = groups == 0
        keys = ["source"] if last else ["source", "class", "shard"]
        luck = F.pmod(F.xxhash64("row", F.lit(seed), F.lit(level + 1)), F.lit(1 << 52)) / float(1 << 52)
        unit = F.struct("size", "row", "mass", luck.alias("luck"), "class", "shard")
        played = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
        played = played.select("source", F.aggregate("units", _nobody(rows), _play).alias("end"))
        played = materialise(played, "mixing")
        taken.append(played.select(F.explode("end.whole").alias("row")))
        rows = played.select("source", "end.row", "end.size", "end.mass", "end.class", "end.shard")
        groups = 0 if groups == 1 else -(-groups // FAN_IN)
        rows = rows.withColumn("shard", F.col("shard") % max(groups, 1))
        level += 1
    out = rows.where(2 * F.col("mass") >= F.col("size")).select("row")
    for part in taken:
        out = out.unionByName(part)
    return out


def _nobody(rows: DataFrame) -> Column:
    kind = dict(rows.dtypes)
    nothing = [F.lit(None).cast(kind[n]).alias(n) for n in ("size", "row", "mass", "class", "shard")]
    return F.struct(F.array().cast(f"array<{kind['row']}>").alias("whole"), *nothing)


def _play(held: Column, unit: Column) -> Column:
    """The held document and the next one play; the state keeps the one still undecided.

    Mass moves to the held one or away from it, as far as one of the two allows, at odds that leave
    either's expectation as it is.
    """
    both = held["mass"] + unit["mass"]
    room, unit_room = held["size"] - held["mass"], unit["size"] - unit["mass"]
    to_held, from_held = F.least(room, unit["mass"]), F.least(held["mass"], unit_room)
    up = unit["luck"] * (to_held + from_held) < from_held
    held_whole = up & (room <= unit["mass"])
    unit_whole = ~up & (held["mass"] > unit_room)
    begins = held["row"].isNull()
    held_stays = ~begins & F.when(up, ~held_whole).otherwise(unit_whole)
    winner = F.when(held_whole, held["row"]).when(unit_whole, unit["row"])
    whole = F.when(winner.isNull(), held["whole"]).otherwise(F.array_append(held["whole"], winner))
    spent = F.when(held_whole, held["size"]).when(unit_whole, unit["size"]).otherwise(0)
    mass = F.when(begins, unit["mass"]).otherwise(F.greatest(both - spent, F.lit(0.0)))
    pick = {n: F.when(held_stays, held[n]).otherwise(unit[n]).alias(n) for n in ("size", "row", "class", "shard")}
    return F.struct(whole.alias("whole"), pick["size"], pick["row"], mass.alias("mass"), pick["class"], pick["shard"])


def mix(
    documents: DataFrame,
    size: Column,
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 7,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies``: how often the mix takes a document.

    A document gets the whole part of its source's target over size, and by pivotal rounding one
    copy more or not; the copies of a source come near its target in size. Rows are numbered and
    fixed in shared storage first, so repeated rows are rounded one by one and lost tasks are
    repeated alike. Null sources are a source of their own; null or negative sizes count as 0.
    Existing columns of the added names, and those beginning with ``_mix_``, are replaced. An
    empty table gives an empty table.
    """
    added = ("size", "source_size", "target", "copies")
    own = [c for c in documents.columns if c not in added and not c.startswith("_mix_")]
    counted = documents.select(
        *own,
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("_mix_row"),
    )
    counted = materialise(counted, "mix")
    targets = materialise(source_targets(counted, source, "size", weights, most), "targets")
    targets = targets.withColumnRenamed(source, "_mix_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("_mix_ratio", F.least(ratio, F.lit(float(most))))
    # The copy of the sources' table is read back, so its size is known and Spark chooses the join.
    valued = counted.join(targets, counted[source].eqNullSafe(targets["_mix_source"])).drop("_mix_source")
    whole = F.floor("_mix_ratio")
    more = chosen(
        valued.select(
            F.col("_mix_row").alias("row"),
            F.col(source).alias("source"),
            "size",
            ((F.col("_mix_ratio") - whole) * F.col("size")).alias("mass"),
        ),
        seed,
    )
    more = more.select(F.col("row").alias("_mix_more"))
    joined = valued.join(more, F.col("_mix_row") == F.col("_mix_more"), "left")
    copies = (whole + F.col("_mix_more").isNotNull().cast("long")).cast("long").alias("copies")
    return joined.select(*own, "size", "source_size", "target", copies)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says."""
    return mixed.withColumn("_mix_copy", F.explode(F.expr("array_repeat(0, cast(copies as int))"))).drop("_mix_copy")
