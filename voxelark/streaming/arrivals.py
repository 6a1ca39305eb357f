"""Finding new, settled data and processing it incrementally."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxelark.functions.sizing import attach

DEFAULT_POLL = "10 minutes"


def discover_new(
    manifest: DataFrame,
    processed: DataFrame,
    min_age_minutes: float,
    now: Column | None = None,
    key: str = "patientID",
    changed: str = "modificationTime",
) -> DataFrame:
    """Items untouched for longer than ``min_age_minutes`` and not yet processed.

    For batch listings only: inside a streaming file source an age filter would
    consume young files without ever returning to them.
    """
    now = F.current_timestamp() if now is None else now
    items = manifest.groupBy(key).agg(
        F.max(changed).alias(changed), F.sum("length").alias("length"), F.count("*").alias("files")
    )
    age = (F.unix_micros(now) - F.unix_micros(F.col(changed))) / 60e6
    old = items.filter(age > F.lit(float(min_age_minutes)))
    done = processed.select(key).distinct().withColumn("__done", F.lit(True))
    return attach(old, done, [key], "left", "processed").filter(F.col("__done").isNull()).drop("__done")


def stable_items(first: DataFrame, second: DataFrame, key: str = "patientID") -> DataFrame:
    """Items whose total size is the same in two listings taken some time apart."""
    before = first.groupBy(key).agg(F.sum("length").alias("length"))
    after = second.groupBy(key).agg(F.sum("length").alias("__after"))
    return before.join(after, key).filter(F.col("length") == F.col("__after")).select(key, "length")


#: Groups that items are dealt into: the state of a group is read and written as one.
SIZE_GROUPS = 1024


def settled_sizes(
    stream: DataFrame,
    key: str = "patientID",
    ts: str = "modificationTime",
    length: str = "length",
    quiet: str = "10 minutes",
    watermark: str = "10 minutes",
    groups: int = SIZE_GROUPS,
) -> DataFrame:
    """``key, length, since, settled``: items whose size stayed the same for ``quiet``, once for every such size.

    Rows are observations of an item's total size, from any number of polls. Each item keeps its
    last size and since when it was seen; an equal observation ``quiet`` later settles it at once, and
    a timer settles it when the watermark passes without another one. A change starts the
    wait anew, also after a size was given. The state of an item is three numbers and survives a restart with
    the query's checkpoint. Of observations at one time the largest size counts; NULL keys, times and
    sizes are left out.

    Items are dealt into ``groups`` by a hash of their key and a group's state is one row with one timer, as a call
    costs milliseconds whatever it holds. A checkpoint belongs to one number of groups; a
    thousand items in a group are fine.
    """
    wait = int(pd.Timedelta(quiet).total_seconds() * 1000)
    kind = stream.schema[key].dataType.simpleString()
    # Keys travel as text: one type for the state, whatever the key is.
    text = F.base64(F.col(key)) if kind == "binary" else F.col(key).cast("string")
    timed = stream.select(
        text.alias("k"), F.col(ts).cast("timestamp").alias("at"), F.col(length).cast("long").alias("size")
    ).filter("k is not null and at is not null and size is not null")

    def follow(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items = {k: kept for k, *kept in zip(*state.get)} if state.exists else {}
        seen: dict[str, dict[int, int]] = {}
        for rows in [] if state.hasTimedOut else batches:
            moments = rows["at"].to_numpy().astype("datetime64[ms]").astype("int64")
            for k, at, now in zip(rows["k"].tolist(), moments.tolist(), rows["size"].tolist()):
                sizes = seen.setdefault(k, {})
                sizes[at] = max(now, sizes.get(at, now))
        passed, done = state.getCurrentWatermarkMs(), []
        for k, (_, since, given) in items.items():
            if not given and k not in seen and since + wait < passed:
                done.append((k, items[k][0], since, since + wait))
                items[k][2] = True
        for k, sizes in seen.items():
            size, since, given = items.get(k, (None, 0, False))
            for at, now in sorted(sizes.items()):
                if size is None or now != size:
                    size, since, given = now, at, False
                elif not given and at - since >= wait:
                    done.append((k, size, since, at))
                    given = True
            items[k] = [size, since, given]
        state.update((list(items), *(list(column) for column in zip(*items.values()))))
        open_ = [since + wait for _, since, given in items.values() if not given]
        if open_:
            state.setTimeoutTimestamp(max(min(open_), passed + 1))
        if done:
            yield pd.DataFrame(dict(zip(("k", "size", "since", "settled"), zip(*done))))

    dealt = timed.withColumn("g", F.pmod(F.xxhash64("k"), F.lit(groups)).cast("int"))
    settled = dealt.withWatermark("at", watermark).groupBy("g").applyInPandasWithState(
        follow,
        "k string, size long, since long, settled long",
        "k array<string>, size array<long>, since array<long>, given array<boolean>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return settled.select(
        (F.unbase64("k") if kind == "binary" else F.col("k").cast(kind)).alias(key),
        F.col("size").alias(length),
        F.timestamp_millis("since").alias("since"),
        F.timestamp_millis("settled").alias("settled"),
    )


def read_arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
    clean: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream of arriving files.

    ``clean`` removes finished inputs: ``archive`` moves them to the archive
    folder, ``delete`` drops them; off unless asked for.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    options = {"pathGlobFilter": glob, "maxFilesPerTrigger": max_files}
    if clean is not None:
        if clean not in ("archive", "delete"):
            raise ValueError("clean must be archive or delete")
        if clean == "archive" and not archive:
            raise ValueError("archive needs an archive folder")
        options |= {"cleanSource": clean, "sourceArchiveDir": archive if clean == "archive" else None}
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load(path)


def settled_groups(
    stream: DataFrame, key: str, ts: str, gap: str = "10 minutes", watermark: str = "10 minutes"
) -> DataFrame:
    """One row per key and activity session, emitted once it has been quiet for ``gap``."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    sessions = timed.groupBy(F.session_window(ts, gap).alias("session"), key).agg(F.count("*").alias("rows"))
    return sessions.select(
        key, F.col("session.start").alias("started"), F.col("session.end").alias("settled"), "rows"
    )


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """Drop repeated deliveries of a key that arrive within the watermark delay."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def run_incremental(
    stream: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    poll: str | None = None,
    name: str | None = None,
    keep: bool = True,
) -> StreamingQuery:
    """Run ``step`` once on everything found since the last poll.

    Each micro-batch is one pool, named by its batch number and written to its own
    partition with overwrite, so a batch repeated after a failure leaves no
    duplicates. Without ``poll`` the waiting data is processed and the query ends.

    A pool is persisted, so its source is read once by a step that reads the pool several times. For a step that reads
    it once, ``keep=False`` saves building that copy, which can be larger than the executors' memory.
    """

    def write_pool(batch: DataFrame, pool: int) -> None:
        if keep:
            batch.persist()
        try:
            if not batch.isEmpty():
                step(batch).write.mode("overwrite").parquet(f"{output}/pool={pool}")
        finally:
            if keep:
                batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_pool).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    return writer.trigger(**trigger).start()


def append_results(
    stream: DataFrame, output: str, checkpoint: str, poll: str | None = None, partitions: int | None = None
) -> StreamingQuery:
    """Write an append-mode stream to Parquet, exactly once.

    ``partitions`` is the number of state partitions of a new query (a store each, opened and committed in every
    poll); without it the session's shuffle partitions hold. The checkpoint keeps the number.
    """
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", output)
    trigger = {"processingTime": poll} if poll else {"availableNow": True}
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    conf, name = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    held = conf.get(name)
    try:
        if partitions is not None:
            conf.set(name, str(partitions))
        # A query copies the session's settings when it starts.
        return writer.start()
    finally:
        conf.set(name, held)


def score_stream(
    stream: DataFrame,
    bundle,
    output: str,
    checkpoint: str,
    poll: str | None = None,
    overrides: dict | Callable[[DataFrame], dict] | None = None,
    then: Sequence = (),
) -> StreamingQuery:
    """Apply a trained bundle (harmonize, normalize, predict) to every pool.

    ``overrides`` gives parameters per step label, such as the batch table of the new
    samples, or a function that makes them from a pool; ``then`` appends steps. A pool is persisted
    unless the chain reads it only once.
    """

    def step(pool: DataFrame) -> DataFrame:
        changed = overrides(pool) if callable(overrides) else overrides
        return bundle.transform(pool, changed, then)

    keep = callable(overrides) or not bundle.reads_once(then)
    return run_incremental(stream, step, output, checkpoint, poll, keep=keep)
