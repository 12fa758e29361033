"""Deletion of repeated runs of lines by winnowing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.mixing import WORD, word_count
from orderloom.session import materialise

# A repeated run counts from this many words on; every run as long shares a fingerprint.
RUN_WORDS = 50


def line_windows(documents: DataFrame, text: str, run_words: int) -> DataFrame:
    """The shortest windows of lines with at least ``run_words`` words: one from each line on, one up to each line.

    A line of a run with that many words lies in the window of the run's first line, or the window of
    which it is the last line lies in the run. So a run that stands earlier is covered to both ends by
    windows that do, wherever each of these stands first.

    ``documents`` has ``_row`` and ``_order``. A row has the places of the first and last line, the
    ``fingerprint`` of the window (its least line hash, the last among equals) with its place, and
    ``content``, a hash of its lines in order. Lines without a word are passed over, so a window has
    at most ``run_words`` lines.
    """
    lines = documents.select("_row", "_order", F.posexplode(F.split(text, "\n")).alias("at", "line"))
    lines = lines.select(
        "_row", "_order", "at", F.xxhash64("line").alias("hash"), word_count(F.col("line")).alias("words")
    ).where("words > 0")
    in_order = Window.partitionBy("_row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("word_at", F.sum("words").over(in_order) - F.col("words"))
    placed = placed.withColumn("word_end", F.col("word_at") + F.col("words"))
    least = F.min(F.struct("hash", (-F.col("at")).alias("back")))
    content = F.collect_list("hash")
    ahead = Window.partitionBy("_row").orderBy("word_at").rangeBetween(0, run_words - 1)
    windows = placed.select(
        "_row",
        "_order",
        "at",
        F.max("at").over(ahead).alias("last"),
        (F.max("word_end").over(ahead) - F.col("word_at")).alias("held"),
        least.over(ahead).alias("least"),
        F.xxhash64(content.over(ahead)).alias("content"),
    )
    behind = Window.partitionBy("_row").orderBy("word_end").rangeBetween(1 - run_words, 0)
    ending = placed.select(
        "_row",
        "_order",
        F.min("at").over(behind).alias("at"),
        F.col("at").alias("last"),
        (F.col("word_end") - F.min("word_at").over(behind)).alias("held"),
        least.over(behind).alias("least"),
        F.xxhash64(content.over(behind)).alias("content"),
        "words",
    )
    # A window that falls below the limit without its last line as well is that of its first line.
    ending = ending.where(F.col("held") - F.col("words") >= run_words).drop("words")
    windows = windows.unionByName(ending)
    windows = windows.where(F.col("held") >= run_words)
    return windows.select(
        "_row",
        "_order",
        "at",
        "last",
        F.col("least.hash").alias("fingerprint"),
        (-F.col("least.back")).alias("fingerprint_at"),
        "content",
    )


def repeated_lines(windows: DataFrame) -> DataFrame:
    """``_row, lines``: the places from first to last line of windows that begin earlier as well.

    Positions are joined on the fingerprint first: only windows whose fingerprint stands in two
    places or more go on. Windows are the same if all their lines are. Of equal windows the first
    stays; what is compared with it are the others, never pairs of others, and firsts are found by
    partial aggregation. A match is extended line by line as far as any earlier place goes on: forwards
    by the windows that begin at its later lines, backwards and past its last window by those that end
    at each line. Extending along the first place alone would stop short where only a later one goes
    on, and extending along all places would pair all copies of a passage.
    """
    place = F.struct("_row", "fingerprint_at")
    ends = windows.groupBy("fingerprint").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    shared = ends.where("low != high").select("fingerprint")
    matched = windows.join(shared, "fingerprint", "left_semi").drop("fingerprint", "fingerprint_at")
    start = F.struct("_order", "_row", "at")
    firsts = matched.groupBy("content").agg(F.min(start).alias("first"), F.count(F.lit(1)).alias("times"))
    # Stored, so that the join reads plain shuffles, which adaptive execution can split at a common window.
    firsts = materialise(firsts.where("times > 1").drop("times"), "firsts")
    later = matched.join(firsts, "content").where(start > F.col("first"))
    covered = later.groupBy("_row", "at").agg(F.max("last").alias("last"))
    runs = covered.groupBy("_row").agg(F.collect_list(F.sequence("at", "last")).alias("runs"))
    return runs.select("_row", F.array_distinct(F.flatten("runs")).alias("lines"))


def dedup_lines(documents: DataFrame, order: str = "doc_id", text: str = "text", run_words: int = RUN_WORDS) -> DataFrame:
    """Delete lines of runs that repeat an earlier run; add ``n_lines`` and ``n_removed`` (long).

    A run is whole lines in a row with at least ``run_words`` words; lines without a word are not
    counted. A line goes if it lies in any run that stands, with the same lines in the same order,
    earlier too: in a document of smaller ``order``, or further up in the same one. So repeated runs go
    to both ends. Overlaps count, and runs are judged on the input. Lines without a word are never
    deleted.

    All rows and columns stay; a text may become empty. A null text stays null and has no lines, an
    empty one has one. Null orders come first; equal orders and repeated rows are told apart by a
    row number that is fixed in shared storage. Existing columns of the added names, and those
    beginning with an underscore, are replaced. An empty table gives an empty table.
    """
    own = [c for c in documents.columns if c not in ("n_lines", "n_removed") and not c.startswith("_")]
    fixed = documents.select(*own, F.monotonically_increasing_id().alias("_row"))
    fixed = materialise(fixed, "lines")
    windows = line_windows(fixed.withColumn("_order", F.col(order)), text, run_words)
    removed = repeated_lines(materialise(windows, "windows"))
    split = F.split(text, "\n")
    joined = fixed.join(removed, "_row", "left").withColumn(
        "_lines", F.filter("lines", lambda k: F.regexp_like(F.get(split, k), F.lit(WORD)))
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_lines"))
    rest = F.array_join(F.transform(kept, lambda k: F.get(split, k)), "\n")
    return joined.select(
        *(F.when(F.col("_lines").isNull(), F.col(c)).otherwise(rest).alias(c) if c == text else c for c in own),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_removed"),
    )
