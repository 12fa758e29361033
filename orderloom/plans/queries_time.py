"""Queries over partitions, freshness and streams."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.timestamps import nearest_hour, ntz_literal, start_of_day
from orderloom.operators import cleaned, freshness
from orderloom.operators.usage import usage_hourly
from orderloom.operators.windows import daily_partitions, partitions_with_rows
from orderloom.plans.registry import over, query
from orderloom.session import materialise, scratch_path
from orderloom.sources.order_views import OrderViews
from orderloom.sources.tables import TableStore
from orderloom.streaming.arrivals import append_arrivals, files_since
from orderloom.streaming.latest import land_by_day, refresh_latest
from orderloom.streaming.parents import ParentWatch
from orderloom.streaming.usage import run_usage, usage_so_far
from orderloom.streaming.windows import run_window_counts

HALF_MONTH = "2024-01-15 12:00:00"


@query("round_hour", """
    select event_id, case when past > 1800 or (past = 1800 and hour(h) % 2 = 1)
                          then h + interval 1 hour else h end as hour
    from (select event_id, date_trunc('hour', ts) as h,
                 (epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 1e6 as past from events)""")
def round_hour(spark, folder):
    return OrderViews(spark, folder).table("events").select("event_id", nearest_hour("ts").alias("hour"))


@query("daily_partition_rows", """
    select d as part_start, count(event_id) as n_rows
    from (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-01', interval 1 day)) as d)
         left join events on date_trunc('day', ts) = d
    group by 1""")
def daily_partition_rows(spark, folder):
    """Every day partition of a range with its rows, days without rows included."""
    held = partitions_with_rows(OrderViews(spark, folder).table("events"), "ts")
    days = daily_partitions(spark, "2023-12-30", "2024-02-02")
    return days.join(held, "part_start", "left").select("part_start", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("backfill_range", """
    select date_trunc('day', ts) as day, event_type, count(*) as n, round(sum(value), 2) as total
    from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-12' group by 1, 2
    union all
    select date_trunc('day', ts), event_type, count(*), round(sum(value) * 2, 2)
    from events where ts >= timestamp '2024-01-12' and ts < timestamp '2024-01-20' group by 1, 2""")
def backfill_range(spark, folder):
    """A range loaded in one run, then loaded again from its second week on with doubled values."""
    store = TableStore(spark, scratch_path(spark, "backfill"))
    events = OrderViews(spark, folder).table("events").select("ts", "event_type", "value")
    store.replace_window(events, "raw_data.events", "ts", "2024-01-05", "2024-01-20")
    doubled = events.withColumn("value", F.col("value") * 2)
    for _ in range(2):
        stored = store.replace_window(doubled, "raw_data.events", "ts", "2024-01-12", "2024-01-20")
    return stored.groupBy(start_of_day("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query("sink_partition_overwrite", over("lines", then="""
    select date_trunc('month', order_date) as month, count(*) as n,
           cast(sum(quantity + case when year(order_date) = 1997 then 1 else 0 end) as bigint) as items
    from lines where not (year(order_date) = 1997 and month(order_date) = 3) group by all"""))
def sink_partition_overwrite(spark, folder):
    """All orders stored by month, then one year replaced: corrected, and without its March."""
    store = TableStore(spark, scratch_path(spark, "months"))
    orders = cleaned.orders_cleaned(OrderViews(spark, folder).raw_orders(sku=False))
    store.replace_window(orders, "cleaned.orders_cleaned", "dt", grain="month")
    march = (F.col("dt") >= ntz_literal("1997-03-01")) & (F.col("dt") < ntz_literal("1997-04-01"))
    corrected = orders.where(~march).withColumn("quantity", F.col("quantity") + 1)
    stored = store.replace_window(
        corrected, "cleaned.orders_cleaned", "dt", "1997-01-01", "1998-01-01", grain="month"
    )
    return stored.groupBy(F.col("part_month").cast("timestamp_ntz").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("items")
    )


AS_OF = "2024-01-31 06:00:00"


@query("freshness_status", """
    select user_id, last_ts, age_seconds,
           case when age_seconds > 86400 then 'FAIL' when age_seconds > 43200 then 'WARN' else 'PASS' end as daily,
           case when age_seconds > 604800 then 'FAIL' when age_seconds > 172800 then 'WARN' else 'PASS' end as weekly,
           case when age_seconds > 604800 then 'FAIL' when age_seconds > 259200 then 'WARN' else 'PASS' end as regular,
           case when age_seconds > 86400 then 'FAIL' else 'PASS' end as fail_only
    from (select user_id, max(ts) as last_ts,
                 (epoch_us(timestamp '2024-01-31 06:00:00') - epoch_us(max(ts))) / 1e6 as age_seconds
          from events group by 1)""")
def freshness_status(spark, folder):
    limits = {
        "daily": freshness.DAILY_LIMITS,
        "weekly": freshness.WEEKLY_LIMITS,
        "regular": freshness.REGULAR_LIMITS,
        "fail_only": freshness.FAIL_ONLY_LIMITS,
    }
    return freshness.freshness_status(OrderViews(spark, folder).table("events"), "ts", AS_OF, limits, "user_id")


@query("freshness_deadline", """
    with due as (
        select 'evening' as rule, timezone('UTC', timezone('America/Los_Angeles', d + interval 1230 minutes)) as deadline,
               interval 23 hours as back
        from (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-02', interval 1 day)) as d)
        union all
        select 'hourly', unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-01', interval 1 hour)),
               interval 1 hour
        union all
        select 'monday', unnest(generate_series(timestamp '2024-01-01 09:00:00', timestamp '2024-02-01', interval 7 days)),
               interval 1980 seconds)
    select rule, deadline, count(event_id) as n_rows, count(event_id) > 0 as on_time
    from due left join events on ts between deadline - back and deadline
    where deadline between timestamp '2024-01-01' and timestamp '2024-02-01'
    group by 1, 2""")
def freshness_deadline(spark, folder):
    events = OrderViews(spark, folder).table("events")
    rules = {
        "evening": freshness.EVENING_DEADLINE,
        "hourly": freshness.HOURLY_DEADLINE,
        "monday": freshness.MONDAY_DEADLINE,
    }
    return freshness.freshness_deadlines(events, "ts", "2024-01-01", "2024-02-01", rules)


@query("freshness_anomaly", """
    with gaps as (
        select user_id, ts, (epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts))) / 1e6 as gap
        from events),
    stats as (
        select user_id, count(gap) as n_gaps, avg(gap) as mean_gap, stddev_pop(gap) as sd_gap, max(gap) as max_gap
        from gaps group by 1 having count(gap) > 0),
    ends as (select user_id, gap as last_gap from gaps
             qualify row_number() over (partition by user_id order by ts desc, gap) = 1)
    select user_id, n_gaps, round(mean_gap, 2) as mean_gap, round(sd_gap, 2) as sd_gap, round(max_gap, 2) as max_gap,
           round(last_gap, 2) as last_gap, last_gap > mean_gap + 1.5 * sd_gap as anomalous
    from stats join ends using (user_id)""")
def freshness_anomaly(spark, folder):
    out = freshness.freshness_anomaly(OrderViews(spark, folder).table("events"), "user_id", "ts", sigmas=1.5)
    for name in ("mean_gap", "sd_gap", "max_gap", "last_gap"):
        out = out.withColumn(name, F.round(name, 2))
    return out


@query("usage_hourly", """
    select 'model.' || event_type as model, date_trunc('hour', ts) as hour, count(*) as n_queries,
           round(sum(value), 2) as credits
    from events where ts < timestamp '2024-01-30 17:15:00' group by 1, 2""")
def usage(spark, folder):
    used = usage_hourly(OrderViews(spark, folder).query_history(), "2024-01-30 18:00:00")
    return used.withColumn("credits", F.round("credits", 2))


def _drop_files(events, landing: str, late: bool) -> None:
    """Land one half of the events as new files."""
    cut = F.col("ts") >= ntz_literal(HALF_MONTH)
    events.where(cut if late else ~cut).write.mode("append").parquet(landing)


@query("stream_file_arrivals", """
    select event_id, user_id, case when ts < timestamp '2024-01-15 12:00:00' then 1 else 3 end as run from events""")
def stream_file_arrivals(spark, folder):
    """Three runs on one checkpoint: first files, nothing new, more files."""
    base = scratch_path(spark, "arrivals")
    landing, target, cursor = f"{base}/landing", f"{base}/target", f"{base}/cursor"
    events = OrderViews(spark, folder).table("events").select("event_id", "user_id", "ts")

    def run(number: int) -> None:
        append_arrivals(
            spark, landing, events.schema, target, cursor, lambda rows: rows.withColumn("run", F.lit(number))
        )

    _drop_files(events, landing, late=False)
    run(1)
    run(2)
    _drop_files(events, landing, late=True)
    run(3)
    return spark.read.parquet(target).select("event_id", "user_id", "run")


@query("incremental_latest", """
    select date_trunc('day', ts) as day, event_type, count(*) as n, round(sum(value), 2) as total
    from events
    where (date_trunc('day', ts) = (select date_trunc('day', max(ts)) from events)
           and ts >= timestamp '2024-01-15 12:00:00')
       or (date_trunc('day', ts) = (select date_trunc('day', max(ts)) from events where ts < timestamp '2024-01-15 12:00:00')
           and ts < timestamp '2024-01-15 12:00:00')
    group by 1, 2""")
def incremental_latest(spark, folder):
    """The latest day is rebuilt at each arrival; the day that was latest before keeps what it had."""
    base = scratch_path(spark, "latest")
    landing, store = f"{base}/landing", TableStore(spark, f"{base}/store")
    events = OrderViews(spark, folder).table("events").select("ts", "event_type", "value")

    def build(day):
        counts = day.groupBy(start_of_day("ts").alias("ts"), "event_type")
        return counts.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

    for late in (False, True):
        cut = F.col("ts") >= ntz_literal(HALF_MONTH)
        land_by_day(events.where(cut if late else ~cut), landing, "ts")
        refresh_latest(spark, landing, events.schema, store, "analytics.event_stats", build, "ts", f"{base}/cursor")
    rows = store.read("analytics.event_stats")
    return rows.select(F.col("ts").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query("incremental_touched", """
    select date_trunc('day', ts) as day, event_type, count(*) as n, round(sum(value), 2) as total
    from events group by 1, 2""")
def incremental_touched(spark, folder):
    """Every day that an arrival has rows for is rebuilt, so late rows of earlier days count too."""
    base = scratch_path(spark, "touched")
    landing, store = f"{base}/landing", TableStore(spark, f"{base}/store")
    events = OrderViews(spark, folder).table("events").select("ts", "event_type", "value")

    def build(day):
        counts = day.groupBy(start_of_day("ts").alias("ts"), "event_type")
        return counts.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

    # Uneven ids come first, so both arrivals have rows of every day.
    ids = OrderViews(spark, folder).table("events").select("event_id", "ts", "event_type", "value")
    for rest in (1, 0):
        land_by_day(ids.where(F.col("event_id") % 2 == rest).select(*events.columns), landing, "ts")
        refresh_latest(
            spark, landing, events.schema, store, "analytics.event_stats", build, "ts", f"{base}/cursor", days="touched"
        )
    rows = store.read("analytics.event_stats")
    return rows.select(F.col("ts").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query("files_replaced", """
    select 'first' as cursor, count(*) as n_rows from events where event_id % 3 = 0
    union all select 'nothing new', 0
    union all select 'replaced', count(*) from events where event_id % 3 = 1""")
def files_replaced(spark, folder):
    """A cursor by modification time: files once, nothing twice, and a replaced file again."""
    base = scratch_path(spark, "replaced")
    events = OrderViews(spark, folder).table("events").select("event_id", "user_id")
    events.where("event_id % 3 = 0").write.mode("overwrite").parquet(base)
    cursor, counts = 0, []
    for label, rest in (("first", 0), ("nothing new", None), ("replaced", 1)):
        if rest is not None:
            time.sleep(1.1)  # some stores keep modification times to the second
            events.where(F.col("event_id") % 3 == rest).write.mode("overwrite").parquet(base)
        rows, cursor = files_since(spark, base, events.schema, cursor)
        counted = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("cursor"), "n_rows")
        # Stored, since the files are replaced afterwards.
        counts.append(materialise(counted, "cursor"))
    return reduce(DataFrame.unionByName, counts)


@query("stream_window_counts", """
    select time_bucket(interval 6 hours, ts, timestamp '2024-01-01') as window_start, event_type,
           count(*) as n, round(sum(value), 2) as total
    from events group by 1, 2
    having time_bucket(interval 6 hours, min(ts), timestamp '2024-01-01') + interval 6 hours
           <= (select max(ts) - interval 10 minutes from events)""")
def stream_window_counts(spark, folder):
    """Windows the watermark has closed after all events have arrived."""
    base = scratch_path(spark, "windows")
    schema = OrderViews(spark, folder).table("events").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    run_window_counts(
        spark, arriving, f"{base}/target", f"{base}/cursor", ts="ts", key="event_type", width="6 hours", lateness="10 minutes"
    )
    return spark.read.parquet(f"{base}/target").withColumn("total", F.round("total", 2))


@query("incremental_any_parent", """
    with months as (
        select 'lines' as parent, date_trunc('year', l_shipdate) as m, count(*) as n from lineitem group by 2
        union all select 'orders', date_trunc('year', o_orderdate), count(*) from orders group by 2
        union all select 'late', date_trunc('year', l_shipdate), count(*) from lineitem where l_linenumber = 1 group by 2),
    latest as (select max(m) as m from months),
    held as (select parent, n, 0 as since from months where m = (select m from latest) and parent <> 'late'
             union all select parent, n, 3 from months where m = (select m from latest) and parent = 'late'),
    states as (
        select r as run, parent, since <= r as there, r = 1 or (r = 3 and parent = 'late') as fresh, n
        from (select unnest([1, 2, 3, 4]) as r) cross join (select unnest(['lines', 'orders', 'late', 'never']) as parent)
             left join held using (parent))
    select run, strftime((select m from latest), '%Y-%m-%d') as part, parent,
           case when there is not true then 'missing' when fresh then 'updated' else 'current' end as state,
           bool_or(there is true and fresh) over (partition by run) as rebuilt, case when there then n end as n_rows
    from states""")
def incremental_any_parent(spark, folder):
    """A child of four parents by year, one of them late and one never there.

    Its latest year is built, left alone, built again when the late parent comes, and left alone when
    an earlier year of a parent is rewritten.
    """
    v, store = OrderViews(spark, folder), TableStore(spark, scratch_path(spark, "parents"))
    lines = v.table("lineitem").select(F.col("l_shipdate").alias("ts"), "l_linenumber")
    orders = v.table("orders").select(F.col("o_orderdate").alias("ts"))
    watch = ParentWatch(store, "child.by_parent", ["lines", "orders", "late", "never"], "year")

    def build(part, parents):
        counts = []
        for name in parents:
            rows = store.read(name).where(F.col("part_year") == F.lit(part).cast("date"))
            counts.append(rows.groupBy(F.col("part_year").cast("timestamp_ntz").alias("ts")).agg(F.count(F.lit(1)).alias("n_rows")))
            counts[-1] = counts[-1].withColumn("parent", F.lit(name))
        return reduce(DataFrame.unionByName, counts)

    done = []
    for run in (1, 2, 3, 4):
        if run == 1:
            store.replace_window(lines, "lines", "ts", grain="year")
            store.replace_window(orders, "orders", "ts", grain="year")
        elif run == 3:
            store.replace_window(lines.where("l_linenumber = 1"), "late", "ts", grain="year")
        elif run == 4:
            store.replace_window(orders, "orders", "ts", "1996-01-01", "1997-01-01", "year")
        states, rebuilt = watch.refresh(build, "ts")
        seen = spark.createDataFrame(
            [(run, s.part, s.parent, s.state, rebuilt) for s in states],
            "run int, part string, parent string, state string, rebuilt boolean",
        )
        held = store.read("child.by_parent").select(F.col("part_year").cast("string").alias("part"), "parent", "n_rows")
        # Stored, since the child is rebuilt afterwards.
        done.append(materialise(seen.join(held, ["part", "parent"], "left"), "states"))
    return reduce(DataFrame.unionByName, done).select("run", "part", "parent", "state", "rebuilt", "n_rows")


@query("usage_late", """
    with arrived as (
        select event_type, date_trunc('hour', ts) as hour, value,
               ts >= timestamp '2024-01-15 12:00:00' or (ts >= timestamp '2024-01-15 10:00:00' and event_id % 4 = 0) as late
        from events)
    select 'model.' || event_type as model, hour, count(*) as n_queries, round(sum(value), 2) as credits,
           count(distinct late) as n_batches
    from arrived group by 1, 2""")
def usage_late(spark, folder):
    """Usage in two arrivals: the second brings late records of hours already counted, and some for the second time."""
    base, v = scratch_path(spark, "usage"), OrderViews(spark, folder)
    ident = F.regexp_extract("query_text", r":(.+?)\]\]\]", 1)
    history = v.query_history().withColumn("query_id", ident)
    start, key = F.col("start_time"), F.col("query_id").cast("bigint")
    recent = (start >= ntz_literal("2024-01-15 10:00:00")) & (start < ntz_literal(HALF_MONTH))
    late = (start >= ntz_literal(HALF_MONTH)) | (recent & (key % 4 == 0))
    for arrival in (~late, late | (recent & (key % 3 == 0))):
        history.where(arrival).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(history.schema).parquet(f"{base}/landing")
        run_usage(spark, stream, f"{base}/hours", f"{base}/cursor", "query_id")
    return usage_so_far(spark, f"{base}/hours").withColumn("credits", F.round("credits", 2))


@query("freshness_quantile", """
    with gaps as (
        select user_id, ts, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) as gap
        from (select distinct user_id, ts from events)),
    ranked as (select user_id, gap, row_number() over (partition by user_id order by gap) as nth,
                      count(*) over (partition by user_id) as n_gaps from gaps where gap is not null),
    ends as (select user_id, gap as last from gaps qualify row_number() over (partition by user_id order by ts desc, gap) = 1)
    select user_id, n_gaps, gap / 1e6 as limit_gap, last / 1e6 as last_gap, last > gap as anomalous
    from ranked join ends using (user_id) where nth = ceil(round(0.9 * n_gaps, 6))""")
def freshness_quantile(spark, folder):
    """Users whose last gap is longer than nine in ten of their gaps."""
    return freshness.gap_quantile(OrderViews(spark, folder).table("events"), "user_id", "ts", quantile=0.9)


@query("files_same_moment", """
    select 'first' as cursor, count(*) as n_rows from events where event_id % 3 = 0
    union all select 'same moment', count(*) from events where event_id % 3 = 1
    union all select 'nothing new', 0""")
def files_same_moment(spark, folder):
    """Files whose modification time is the cursor's own arrive later: they are read, and once."""
    base = scratch_path(spark, "moment")
    events = OrderViews(spark, folder).table("events").select("event_id", "user_id")
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(base)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    cursor, counts = 0, []
    for label, rest in (("first", 0), ("same moment", 1), ("nothing new", None)):
        if rest is not None:
            events.where(F.col("event_id") % 3 == rest).write.mode("append").parquet(base)
            for file in system.listStatus(where):
                system.setTimes(file.getPath(), 1_700_000_000_000, -1)
        rows, cursor = files_since(spark, base, events.schema, cursor)
        counts.append(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("cursor"), "n_rows"))
    return reduce(DataFrame.unionByName, counts)
