"""Scheduled jobs as Structured Streaming: new files are picked up once, then the job stops.

Sources, targets and checkpoints are folders shared by the cluster. Every sink is
idempotent per micro-batch, so a restart repeats no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions import money_sum
from ..operators.clean import clean_events
from ..quality.schema import TableSchema
from ..session import path_exists


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet",
                pattern: str = "*", max_files: int = 1000) -> DataFrame:
    """New files of a folder whose names match ``pattern``."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .option("pathGlobFilter", pattern).format(fmt).load(folder))


def _run(writer, wait: bool) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def incremental_stage(events: DataFrame, target: str, checkpoint: str,
                      clean: Callable[[DataFrame], DataFrame] = clean_events, wait: bool = True) -> StreamingQuery:
    """Clean every new raw drop into one staging table, exactly once."""
    return _run(clean(events).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", target), wait)


def incremental_daily_metrics(events: DataFrame, target: str, checkpoint: str, ts: str = "event_ts",
                              user: str = "user_id", kind: str = "event_type", amount: str = "amount",
                              delay: str = "1 day", wait: bool = True) -> StreamingQuery:
    """Daily totals emitted when a day is closed by the watermark; users by a fixed-size sketch."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return _run(_daily(timed, user, kind, amount).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", target), wait)


def _daily(events: DataFrame, user: str, kind: str, amount: str) -> DataFrame:
    hit = F.col(kind) == "purchase"
    return (events.groupBy(F.window("_ts", "1 day"))
            .agg(F.approx_count_distinct(user).alias("daily_active_users"), F.count("*").alias("total_events"),
                 F.count_if(hit).alias("purchases"), money_sum(F.when(hit, F.col(amount)).otherwise(0.0)).alias("revenue"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("date"), "daily_active_users",
                    "total_events", "purchases", "revenue"))


def all_days(closed: DataFrame, events: DataFrame, ts: str = "event_ts", user: str = "user_id",
             kind: str = "event_type", amount: str = "amount") -> DataFrame:
    """The days that ``incremental_daily_metrics`` has closed, and the open ones from the raw rows after them."""
    last = closed.agg((F.max("date") + F.expr("INTERVAL 1 DAY")).alias("d")).scalar()
    still = events.where(last.isNull() | (F.col(ts) >= last)).withColumn("_ts", F.col(ts).cast("timestamp"))
    return closed.unionByName(_daily(still, user, kind, amount))


def recompute_days(events: DataFrame, staged: str, target: str, checkpoint: str,
                   report: Callable[[DataFrame], DataFrame], ts: str = "event_ts",
                   wait: bool = True) -> StreamingQuery:
    """Exact daily reports kept current: a batch's rows are stored by day, and only the days
    it touches are recomputed and overwritten. ``report`` must return a ``date`` column.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("event_day", F.col(ts).cast("date"))
        (rows.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "event_day")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "event_day").parquet(staged))
        everything = spark.read.parquet(staged)
        touched = everything.where(F.col("batch_id") == batch_id).select("event_day").distinct()
        fresh = report(everything.join(F.broadcast(touched), "event_day", "left_semi"))  # one row per calendar day
        (fresh.withColumn("day", F.col("date").cast("date")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target))

    return _run(events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint), wait)


def stream_sessions(events: DataFrame, target: str, checkpoint: str, ts: str = "ts", user: str = "user_id",
                    gap: str = "30 minutes", delay: str = "1 hour", wait: bool = True) -> StreamingQuery:
    """Sessions per user, closed by a pause of ``gap``; emitted once the watermark has passed their end."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return _run(_sessions(timed, user, gap).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", target), wait)


def _sessions(events: DataFrame, user: str, gap: str) -> DataFrame:
    return (events.groupBy(user, F.session_window("_ts", gap))
            .agg(F.count("*").alias("events"), F.max("_ts").alias("last"))
            .select(user, F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("last").cast("timestamp_ntz").alias("session_last"), "events"))


def all_sessions(closed: DataFrame, events: DataFrame, ts: str = "ts", user: str = "user_id",
                 gap: str = "30 minutes") -> DataFrame:
    """The sessions that ``stream_sessions`` has closed, and the open ones from each user's events after them."""
    last = closed.groupBy(F.col(user).alias("_user")).agg(F.max("session_last").alias("_last"))
    still = events.join(last, F.col(user) == F.col("_user"), "left").where(F.col("_last").isNull() | (F.col(ts) > F.col("_last")))
    return closed.unionByName(_sessions(still.withColumn("_ts", F.col(ts).cast("timestamp")), user, gap))


BUCKETS = 64
PLACE = "_place"


def stream_quality_gate(events: DataFrame, schema: TableSchema, valid: str, rejected: str, checkpoint: str,
                        wait: bool = True, order: Sequence[str] = (), index: str | None = None) -> StreamingQuery:
    """Split every batch into valid rows and rejected rows with reasons.

    Unique columns hold over all batches, and which rows hold them does not depend on how files fall into
    batches. With an ``order`` the first of the rows that pass the other checks owns a key (missing values first; equal rows by
    their values, then by arrival) and the others are rejected. Without one all rows of a repeated key are rejected, as
    ``TableSchema`` does. A batch looks its keys up in ``index``, files by hash of the key, and reads only the buckets that its own keys
    fall into, and of them what lies in the range of its keys. What a later batch changes for rows of earlier ones is not rewritten: ``gate_result`` reads both parts with
    such changes made. Each batch owns directories that a retry overwrites, and looks only at those of earlier
    batches. An empty part gets a file too, so both folders can be read from the first batch on.
    """
    unique = [c for c, rule in schema.columns.items() if rule.unique]
    by_row = replace(schema, columns={c: replace(rule, unique=False) for c, rule in schema.columns.items()})
    index = index or f"{valid}-keys"

    def step(batch: DataFrame, batch_id: int) -> None:
        marked = by_row.marked(batch).persist()  # both halves come from one run of the checks
        held = [marked]
        good, bad = by_row.parts(marked, batch.columns)
        if unique:
            place = F.struct(*order, F.to_json(F.struct(*batch.columns)).alias("values"), F.lit(batch_id).alias("batch"),
                             F.monotonically_increasing_id().alias("row"))
            good, asked = good.withColumn(PLACE, place), marked.withColumn(PLACE, place)
            repeated = []
            for i, c in enumerate(unique):
                firsts = _firsts(good if order else asked, c, f"{index}/{c}", batch_id).persist()  # for the index and for both halves
                held.append(firsts)
                fresh = firsts.where(F.col("_known").isNull() | (F.col("_least") < F.col("_known"))) if order else firsts
                # A bucket is written by one task, so a batch adds at most BUCKETS files, sorted so that a scan can skip parts of them.
                (fresh.select("key", F.col("_least").alias(PLACE), "n", _bucket("key").alias("bucket")).repartition("bucket")
                 .sortWithinPartitions("bucket", "key").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{index}/{c}/batch_id={batch_id}"))
                own = firsts.select(F.col("key").alias(f"_key{i}"), F.least("_least", "_known").alias(f"_first{i}"), F.expr("n + coalesce(_n, 0)").alias(f"_n{i}"))
                good = good.join(own, F.col(c) == F.col(f"_key{i}"), "left")
                repeated.append(_lost(c, i, bool(order)))
            good = good.select(*batch.columns, PLACE, F.array_compact(F.array(*repeated)).alias("reasons")).persist()
            held.append(good)
            late = good.where(F.size("reasons") > 0).drop(PLACE)
            good, bad = good.where(F.size("reasons") == 0).drop("reasons"), bad.unionByName(late)
        for part, path in ((good, valid), (bad, rejected)):
            part.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        for frame in held:
            frame.unpersist()

    return _run(events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint), wait)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _lost(column: str, i: int, ordered: bool) -> Column:
    """Reason where a row does not own its key: another row is first, or the key has other rows at all."""
    other = F.col(PLACE) != F.col(f"_first{i}") if ordered else F.col(f"_n{i}") > 1
    return F.when(F.col(column).isNotNull() & other, F.lit(f"{column}:unique"))


def _firsts(rows: DataFrame, column: str, index: str, batch_id: int) -> DataFrame:
    """``key, _least, n, _known, _n``: first place and rows of every key in a batch, and the same of earlier batches."""
    spark = rows.sparkSession
    own = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.min(PLACE).alias("_least"), F.count("*").alias("n"))
    place = rows.schema[PLACE].dataType
    if not path_exists(spark, index):
        return own.withColumns({"_known": F.lit(None).cast(place), "_n": F.lit(0).cast("long")})
    # Of the index only the buckets of the batch's keys (at most BUCKETS numbers) between the least and the greatest of them.
    touched, least, greatest = own.agg(F.collect_set(_bucket("key")), F.min("key"), F.max("key")).first()
    if not touched:
        return own.withColumns({"_known": F.lit(None).cast(place), "_n": F.lit(0).cast("long")})
    kind = rows.schema[column].dataType
    least, greatest = (F.lit(bytes(x) if isinstance(x, bytearray) else x).cast(kind) for x in (least, greatest))
    types = StructType([StructField("key", kind), StructField(PLACE, place), StructField("n", LongType()),
                        StructField("bucket", IntegerType()), StructField("batch_id", IntegerType())])
    known = spark.read.schema(types).parquet(index).where((F.col("batch_id") < batch_id) & F.col("bucket").isin(touched) & F.col("key").between(least, greatest))
    return own.join(known.groupBy("key").agg(F.min(PLACE).alias("_known"), F.sum("n").alias("_n")), "key", "left")


def gate_result(spark: SparkSession, schema: TableSchema, valid: str, rejected: str, index: str | None = None,
                order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows of ``stream_quality_gate`` over all batches: rows that lost a key to a later batch are rejected."""
    unique = [c for c, rule in schema.columns.items() if rule.unique]
    good, bad = spark.read.parquet(valid), spark.read.parquet(rejected)
    if not unique:
        return good, bad
    for i, c in enumerate(unique):
        firsts = spark.read.parquet(f"{index or valid + '-keys'}/{c}").groupBy(F.col("key").alias(f"_key{i}")).agg(
            F.min(PLACE).alias(f"_first{i}"), F.sum("n").alias(f"_n{i}"))
        good = good.join(firsts, F.col(c) == F.col(f"_key{i}"), "left")
    lost = [_lost(c, i, bool(order)) for i, c in enumerate(unique)]
    marked = good.select(*[c for c in bad.columns if c != "reasons"], F.array_compact(F.array(*lost)).alias("reasons"))
    return marked.where(F.size("reasons") == 0).drop("reasons"), bad.unionByName(marked.where(F.size("reasons") > 0))
