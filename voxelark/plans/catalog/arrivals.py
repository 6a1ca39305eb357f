"""Incremental ingestion, and chains of steps replayed on new data."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxelark.functions.sizing import materialize, shared_dir
from voxelark.operators.predict import LinearScorer
from voxelark.plans.catalog.common import load, rounded, sql_round
from voxelark.plans.pipeline import Pipeline, Step
from voxelark.streaming.arrivals import (
    append_results,
    dedupe_stream,
    discover_new,
    read_arrivals,
    run_incremental,
    score_stream,
    settled_groups,
    settled_sizes,
    stable_items,
)

NOW = "2024-01-31 00:00:00"
CUT = "1998-01-01"
ID = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WEIGHTS = {"l_quantity": 1.0, "l_extendedprice": -2.0, "l_tax": 0.5}


def _listing(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("U"), F.col("user_id")).alias("patientID"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        F.round(F.col("value") * 100).cast("long").alias("length"),
        "event_type",
        "value",
    )


def _scratch(spark):
    return f"{shared_dir(spark)}/voxelark/stream-{uuid.uuid4().hex}"


def new_items(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    processed = listing.filter((F.col("event_type") == "purchase") & (F.col("value") > 250))
    return discover_new(listing, processed, 600, F.lit(NOW).cast("timestamp"))


def stable_sizes(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    earlier = listing.filter(F.col("modificationTime") < F.lit("2024-01-30 12:00:00").cast("timestamp"))
    return stable_items(earlier, listing)


def _event_stream(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    return read_arrivals(spark, sf_dir, schema, glob="events.parquet")


def settled_sessions(spark, sf_dir):
    """Activity sessions per user, closed once quiet for two hours."""
    stream = settled_groups(_event_stream(spark, sf_dir), "user_id", "ts", "2 hours", "1 hour")
    where = _scratch(spark)
    append_results(stream, f"{where}/out", f"{where}/checkpoint", partitions=2).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


WEEKS = [(1, 7), (8, 14), (15, 21), (22, 31)]
#: Polls, in bytes, whose items share a partition of state.
POLL_BYTES = 16 * 1024 * 1024


def sizes_settled(spark, sf_dir):
    """Total size of each user's data as seen by a poll at the end of each day, given once it was the same for three days.

    The polls arrive in several files; the query is stopped in the middle and started again.
    """
    e = load(spark, sf_dir, "events")
    daily = e.groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.round(F.col("value") * 100).cast("long"))).alias("grown")
    )
    whole = Window.partitionBy("user_id").orderBy("day")
    days = daily.groupBy("user_id").agg(F.min("day").alias("first")).select(
        "user_id", F.explode(F.sequence("first", F.lit(30))).alias("day")
    )
    polls = days.join(daily, ["user_id", "day"], "left").select(
        "user_id",
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("day"))).alias("seen"),
        F.sum(F.coalesce("grown", F.lit(0))).over(whole).alias("size"),
        "day",
    )
    # Written once; each week's file is then a plain copy of its rows.
    polls = materialize(polls, "polls")
    where, schema = _scratch(spark), "user_id long, seen timestamp, size long"
    partitions = max(2, -(-polls.measured // POLL_BYTES))
    for first, last in WEEKS:
        polls.filter(F.col("day").between(first, last)).drop("day").coalesce(1).write.mode("append").parquet(f"{where}/in")
        if first != WEEKS[1][0]:
            continue
        _follow_sizes(spark, where, schema, partitions).awaitTermination()
    _follow_sizes(spark, where, schema, partitions).awaitTermination()
    return spark.read.schema("user_id long, size long, since timestamp, settled timestamp").parquet(f"{where}/out")


def _follow_sizes(spark, where, schema, partitions):
    stream = read_arrivals(spark, f"{where}/in", schema, max_files=1)
    settled = settled_sizes(stream, "user_id", "seen", "size", "3 days", "1 day", groups=64 * partitions)
    return append_results(settled, f"{where}/out", f"{where}/checkpoint", partitions=partitions)


def _delivered(spark, sf_dir):
    """The events of each week as one more file, oldest first: yields the folder as each file arrives."""
    e = load(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    where = _scratch(spark)
    for week, (first, last) in enumerate(WEEKS):
        part = e.filter(F.col("day").between(first, last)).drop("day").withColumn("week", F.lit(week))
        part.coalesce(1).write.mode("append").parquet(f"{where}/in")
        yield where, part.schema


def deliveries_expired(spark, sf_dir):
    """Deliveries of each event type, dated by their week: a repetition is dropped until two days' watermark has
    forgotten the first, here after every other week."""
    for where, schema in _delivered(spark, sf_dir):
        stream = read_arrivals(spark, f"{where}/in", schema, max_files=1)
        dated = stream.select("event_type", F.make_date(F.lit(2024), F.lit(1), 1 + 7 * F.col("week")).cast("timestamp").alias("ts"))
        once = dedupe_stream(dated, ["event_type"], "ts", "2 days")
        append_results(once, f"{where}/out", f"{where}/checkpoint", partitions=2).awaitTermination()
    return spark.read.parquet(f"{where}/out").select("event_type", F.floor((F.dayofmonth("ts") - 1) / 7).cast("int").alias("week"))


def pools_polled(spark, sf_dir):
    """One pool for each delivered file, found by a query that polls at an interval until all are in."""
    for where, schema in _delivered(spark, sf_dir):
        pass
    stream = read_arrivals(spark, f"{where}/in", schema, max_files=1)

    def summarise(pool):
        return pool.groupBy("event_type").agg(F.count("*").alias("rows"))

    query = run_incremental(stream, summarise, f"{where}/out", f"{where}/checkpoint", poll="200 milliseconds")
    query.processAllAvailable()
    query.stop()
    query.awaitTermination()
    return spark.read.parquet(f"{where}/out").select("pool", "event_type", "rows")


def finished_archived(spark, sf_dir):
    """Inputs are moved to an archive once a later poll has begun; the last file of the last poll stays."""
    for where, schema in _delivered(spark, sf_dir):
        stream = read_arrivals(
            spark, f"{where}/in", schema, max_files=1, clean="archive", archive=f"{where}/archive"
        )
        append_results(stream, f"{where}/out", f"{where}/checkpoint").awaitTermination()
    # Files keep their path below the archive: what is left and what was moved are all rows, each once.
    moved = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{where}/archive")
    left = spark.read.schema(schema).parquet(f"{where}/in")
    both = moved.withColumn("moved", F.lit(1)).unionByName(left.withColumn("moved", F.lit(0)))
    read = spark.read.schema(schema).parquet(f"{where}/out").agg(F.count("*").alias("read"))
    return both.agg(F.count("*").alias("kept"), (F.sum("moved") > 0).alias("some_archived")).join(read)


def chain_timed(spark, sf_dir):
    """Seconds of each step of a chain, beside the steps' order."""
    train, _ = _split(spark, sf_dir)
    _, times = _chain().run(train, timer=True)
    return times.select("position", "step", (F.col("seconds") > 0).alias("measured"))


def repeated_deliveries_dropped(spark, sf_dir):
    stream = dedupe_stream(_event_stream(spark, sf_dir), ["user_id", "event_type"], "ts", "60 days")
    where = _scratch(spark)
    append_results(stream, f"{where}/out", f"{where}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{where}/out").select("user_id", "event_type")


def pool_summaries(spark, sf_dir):
    """Each poll's arrivals form a pool that is summarised once."""
    where = _scratch(spark)

    def summarise(pool):
        return pool.groupBy("event_type").agg(F.count("*").alias("rows"), F.max("value").alias("largest"))

    run_incremental(
        _event_stream(spark, sf_dir), summarise, f"{where}/out", f"{where}/checkpoint"
    ).awaitTermination()
    return rounded(spark.read.parquet(f"{where}/out").select("pool", "event_type", "rows", "largest"))


def _chain():
    return Pipeline(
        [
            Step("dedupe", {"keys": ID, "order_by": ["l_quantity"]}),
            Step("normalize", {"features": FEATURES, "method": "zscore", "by": "l_returnflag"}),
            Step("predict", {"model": LinearScorer(list(WEIGHTS), list(WEIGHTS.values()), 1.0)}),
        ],
        defaults={"keys": ID},
    )


def _split(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    columns = [*ID, "l_returnflag", *FEATURES]
    return (
        df.filter(F.col("l_shipdate") < CUT).select(*columns),
        df.filter(F.col("l_shipdate") >= CUT).select(*columns),
    )


def training_replayed(spark, sf_dir):
    """A chain trained on earlier shipments, replayed on later ones."""
    train, new = _split(spark, sf_dir)
    bundle, _ = _chain().fit(train)
    return rounded(bundle.transform(new))


def scored_stream(spark, sf_dir):
    """The trained chain applied to line items arriving as a stream."""
    train, _ = _split(spark, sf_dir)
    bundle, _ = _chain().fit(train)
    schema = load(spark, sf_dir, "lineitem").schema
    arriving = read_arrivals(spark, sf_dir, schema, glob="lineitem.parquet")
    arriving = arriving.filter(F.col("l_shipdate") >= CUT).select(*ID, "l_returnflag", *FEATURES)
    where = _scratch(spark)
    score_stream(arriving, bundle, f"{where}/out", f"{where}/checkpoint").awaitTermination()
    return rounded(spark.read.parquet(f"{where}/out").select(*ID, "predictions"))


QUERIES = {
    "sizes_settled": sizes_settled,
    "deliveries_expired": deliveries_expired,
    "pools_polled": pools_polled,
    "finished_archived": finished_archived,
    "chain_timed": chain_timed,
    "new_items": new_items,
    "stable_sizes": stable_sizes,
    "settled_sessions": settled_sessions,
    "repeated_deliveries_dropped": repeated_deliveries_dropped,
    "pool_summaries": pool_summaries,
    "training_replayed": training_replayed,
    "scored_stream": scored_stream,
}

# ---------------------------------------------------------------- checking SQL

_LISTING = """ls AS (SELECT 'U' || user_id AS patientID, ts AS modificationTime,
  CAST(round(value * 100) AS BIGINT) AS length, event_type, value FROM events)"""
_REPLAYED = f"""WITH u AS (SELECT DISTINCT {', '.join(ID)}, l_returnflag, {', '.join(FEATURES)},
  l_shipdate >= '{CUT}' AS is_new FROM lineitem),
s AS (SELECT l_returnflag, {', '.join(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in WEIGHTS)}
  FROM u WHERE NOT is_new GROUP BY 1)
SELECT {', '.join(ID)}, {sql_round('1.0 + ' + ' + '.join(
    f'{w} * ({f} - m_{f}) / s_{f}' for f, w in WEIGHTS.items()))} AS predictions
FROM u JOIN s USING (l_returnflag) WHERE is_new"""

ORACLES = {
    "sizes_settled": """WITH daily AS (SELECT user_id, day(ts) AS day,
  sum(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END) AS grown FROM events GROUP BY 1, 2),
days AS (SELECT user_id, unnest(range(min(day), 31)) AS day FROM daily GROUP BY 1),
polls AS (SELECT user_id, day, CAST(sum(coalesce(grown, 0)) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS size
  FROM days LEFT JOIN daily USING (user_id, day)),
same AS (SELECT user_id, size, min(day) AS d, max(day) AS e FROM polls GROUP BY 1, 2)
SELECT user_id, size, TIMESTAMP '2024-01-01' + d * INTERVAL 1 DAY AS since,
 TIMESTAMP '2024-01-01' + (d + 3) * INTERVAL 1 DAY AS settled FROM same WHERE e >= d + 3""",
    "deliveries_expired": """SELECT DISTINCT event_type, CAST((least(day(ts), 28) - 1) // 7 AS INTEGER) AS week
FROM events WHERE (least(day(ts), 28) - 1) // 7 IN (0, 2)""",
    "pools_polled": """SELECT CAST(least((least(day(ts), 28) - 1) // 7, 3) AS INTEGER) AS pool, event_type, count(*) AS rows
FROM events GROUP BY 1, 2""",
    "finished_archived": "SELECT count(*) AS kept, TRUE AS some_archived, count(*) AS read FROM events",
    "chain_timed": """SELECT * FROM (VALUES (0::INTEGER, 'dedupe', TRUE), (1, 'normalize', TRUE), (2, 'predict', TRUE))
 t(position, step, measured)""",
    "new_items": f"""WITH {_LISTING}, i AS (SELECT patientID, max(modificationTime) AS modificationTime,
  CAST(sum(length) AS BIGINT) AS length, count(*) AS files FROM ls GROUP BY 1)
SELECT * FROM i WHERE modificationTime < TIMESTAMP '{NOW}' - INTERVAL 600 MINUTE
 AND patientID NOT IN (SELECT patientID FROM ls WHERE event_type = 'purchase' AND value > 250)""",
    "stable_sizes": f"""WITH {_LISTING}
SELECT patientID, CAST(sum(length) AS BIGINT) AS length FROM ls GROUP BY 1
HAVING sum(length) = sum(CASE WHEN modificationTime < TIMESTAMP '2024-01-30 12:00:00' THEN length END)""",
    "settled_sessions": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 2 HOUR
   OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS head FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(head) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 2 HOUR AS settled, count(*) AS rows FROM g
GROUP BY user_id, k HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "repeated_deliveries_dropped": "SELECT DISTINCT user_id, event_type FROM events",
    "pool_summaries": f"""SELECT 0::INTEGER AS pool, event_type, count(*) AS rows,
 {sql_round('max(value)')} AS largest FROM events GROUP BY event_type""",
    "training_replayed": _REPLAYED,
    "scored_stream": _REPLAYED,
}
