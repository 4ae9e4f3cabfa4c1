import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from lakeworks.catalog import QUERIES
from lakeworks.operators.marts import daily_event_metrics
from lakeworks.plans.pipelines import event_run, multi_source_run, quality_pipeline
from lakeworks.quality.rules import RuleLog
from lakeworks.quality.schema import Rule, SchemaError, TableSchema
from lakeworks.sources.writers import write_csv
from lakeworks.streaming import jobs

RAW = "user_id bigint, event_type string, timestamp string, amount double"


def land(spark, folder, rows):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(folder)


def test_only_new_drops_are_staged(spark, folder):
    for users in ([1, 2], [3, None]):
        land(spark, f"{folder}/raw", [(u, "click", "2024-01-01T10:00:00", 1.0) for u in users])
        jobs.incremental_stage(jobs.file_stream(spark, f"{folder}/raw", RAW), f"{folder}/staged", f"{folder}/cp")
    assert sorted(r["user_id"] for r in spark.read.parquet(f"{folder}/staged").collect()) == [1, 2, 3]


def test_days_are_recomputed_exactly(spark, folder, tuples):
    stream_args = (f"{folder}/staged", f"{folder}/daily", f"{folder}/cp", daily_event_metrics)
    drops = [[(1, "click", "2024-01-01T10:00:00", 1.0), (2, "click", "2024-01-02T10:00:00", 2.0)],
             [(1, "click", "2024-01-01T11:00:00", 5.0), (3, "view", "2024-01-03T10:00:00", 1.0)]]
    for rows in drops:
        land(spark, f"{folder}/raw", rows)
        events = jobs.file_stream(spark, f"{folder}/raw", RAW)
        jobs.recompute_days(events.withColumn("event_ts", F.col("timestamp").cast("timestamp_ntz")), *stream_args)
    got = tuples(spark.read.parquet(f"{folder}/daily"), "date", "event_type", "event_count", "unique_users", "total_amount")
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    assert got == [(day[0], "click", 2, 1, 6.0), (day[1], "click", 1, 1, 2.0), (day[2], "view", 1, 1, 1.0)]


def test_closed_sessions_equal_the_batch(spark, sf, folder, tuples):
    events = spark.read.parquet(f"{sf}/events.parquet")
    stream = jobs.file_stream(spark, sf, events.schema, pattern="events.parquet")
    jobs.stream_sessions(stream, f"{folder}/s", f"{folder}/cp")
    batch = events.groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes")).agg(
        F.count("*").alias("events"), F.max("ts").alias("last"))
    closed = batch.where(F.col("session_window.end") <= events.agg(F.max("ts").cast("timestamp")).scalar() - F.expr("INTERVAL 1 HOUR"))
    assert tuples(spark.read.parquet(f"{folder}/s"), "user_id", "session_last", "events") == tuples(closed, "user_id", "last", "events")


def test_gate_splits_every_batch(spark, folder):
    schema = TableSchema({"user_id": Rule("bigint", ge=1), "event_type": Rule("string", isin=["click", "view"])})
    for rows in ([(1, "click", "t", 1.0), (0, "click", "t", 1.0)], [(2, "view", "t", 1.0), (3, "login", "t", 1.0), (None, "x", "t", 1.0)]):
        land(spark, f"{folder}/raw", rows)
        jobs.stream_quality_gate(jobs.file_stream(spark, f"{folder}/raw", RAW), schema, f"{folder}/ok", f"{folder}/bad", f"{folder}/cp")
    good, bad = spark.read.parquet(f"{folder}/ok"), spark.read.parquet(f"{folder}/bad")
    assert sorted(r["user_id"] for r in good.collect()) == [1, 2] and bad.count() == 3
    assert good.select("batch_id").distinct().count() == 2
    assert bad.where("user_id IS NULL").first()["reasons"] == ["user_id:not_null", "event_type:isin(['click', 'view'])"]


@pytest.mark.parametrize("drops", [[[1, 2], [1, 3]], [[1, 1, 2], [2, None], [None, 3]], [[3], [3], [3]]])
def test_batches_do_not_decide_who_owns_a_key(spark, folder, drops):
    schema = TableSchema({"user_id": Rule("bigint", nullable=True, unique=True), "event_type": Rule("string", isin=["click", "view"], unique=False)})
    for i, users in enumerate(drops):
        # Times run against the order of arrival, so later drops take keys over; the last row of a drop fails its own check.
        land(spark, f"{folder}/raw", [(u, "click", f"t{9 - i}", float(k)) for k, u in enumerate(users)] + [(users[0], "login", "t0", 0.0)])
    results = []
    for files in (1, 1000):
        at = f"{folder}/{files}"
        source = jobs.file_stream(spark, f"{folder}/raw", RAW, max_files=files)
        jobs.stream_quality_gate(source, schema, f"{at}/ok", f"{at}/bad", f"{at}/cp", order=["timestamp", "amount"])
        good, bad = jobs.gate_result(spark, schema, f"{at}/ok", f"{at}/bad", order=["timestamp", "amount"])
        results.append((sorted(map(str, good.drop("batch_id").collect())), sorted(map(str, bad.drop("batch_id").collect()))))
    assert results[0] == results[1]
    everything = [(f"t{9 - i}", float(k), u) for i, users in enumerate(drops) for k, u in enumerate(users)]
    first = {}
    for t, a, u in sorted(everything, key=lambda x: x[:2]):
        first.setdefault(u if u is not None else (t, a), (t, a, u))
    assert len(results[0][0]) == len(first) and len(results[0][1]) == len(everything) - len(first) + len(drops)


def test_a_batch_reads_only_its_own_buckets(spark, folder):
    schema = TableSchema({"user_id": Rule("bigint", unique=True)})
    for users in (range(500), [3]):
        land(spark, f"{folder}/raw", [(u, "click", "t", 0.0) for u in users])
        jobs.stream_quality_gate(jobs.file_stream(spark, f"{folder}/raw", RAW, max_files=1), schema, f"{folder}/ok", f"{folder}/bad", f"{folder}/cp",
                                 order=["timestamp"])
    index = spark.read.parquet(f"{folder}/ok-keys/user_id")
    assert index.where("batch_id = 0").select("bucket").distinct().count() == jobs.BUCKETS
    assert index.where("batch_id = 1").count() == 0  # the repeated row, equal in all values, comes later
    good, bad = jobs.gate_result(spark, schema, f"{folder}/ok", f"{folder}/bad", order=["timestamp"])
    assert good.count() == 500 and bad.count() == 1


@pytest.mark.parametrize("kind", ["bigint", "string", "binary", "double"])
def test_a_batch_adds_a_file_a_bucket_to_the_index(spark, folder, kind):
    schema = TableSchema({"k": Rule(kind, unique=True)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tasks are as many as the shuffle has
    try:
        for first in (0, 2000, 1000):
            spark.range(first, first + 2000).select(F.col("id").cast("string").cast(kind).alias("k"), "id").coalesce(1).write.mode("append").parquet(f"{folder}/raw")
            jobs.stream_quality_gate(jobs.file_stream(spark, f"{folder}/raw", f"k {kind}, id bigint"), schema, f"{folder}/ok", f"{folder}/bad", f"{folder}/cp",
                                     order=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for batch in range(3):
        assert len(glob.glob(f"{folder}/ok-keys/k/batch_id={batch}/bucket=*/*.parquet")) <= jobs.BUCKETS
    good, bad = jobs.gate_result(spark, schema, f"{folder}/ok", f"{folder}/bad", order=["id"])
    assert good.select("k").distinct().count() == good.count() == 4000
    assert sorted(r["id"] for r in bad.collect()) == list(range(1000, 3000))


@pytest.mark.parametrize("files", [1, 1000])
def test_without_an_order_repeated_keys_have_no_owner(spark, folder, files):
    schema = TableSchema({"user_id": Rule("bigint", unique=True), "event_type": Rule("string", isin=["click"])})
    for rows in ([(1, "click", "t", 0.0), (2, "click", "t", 0.0)], [(1, "click", "t", 1.0), (3, "click", "t", 0.0)], [(3, "login", "t", 0.0)]):
        land(spark, f"{folder}/raw", rows)
    source = jobs.file_stream(spark, f"{folder}/raw", RAW, max_files=files)
    jobs.stream_quality_gate(source, schema, f"{folder}/ok", f"{folder}/bad", f"{folder}/cp")
    good, bad = jobs.gate_result(spark, schema, f"{folder}/ok", f"{folder}/bad")
    assert [r["user_id"] for r in good.collect()] == [2] and sorted(r["user_id"] for r in bad.collect()) == [1, 1, 3, 3]


def test_a_part_without_rows_is_not_listed(spark, sf, folder):
    events = spark.read.parquet(f"{sf}/events.parquet")
    both = events.unionByName(events.withColumn("event_id", F.col("event_id") + 1_000_000))  # no minute has one event only
    both.coalesce(1).write.parquet(f"{folder}/all")
    os.rename(glob.glob(f"{folder}/all/*.parquet")[0], f"{folder}/events.parquet")
    assert [tuple(r) for r in QUERIES["stream_quality_gate"](spark, folder).collect()] == [("rejected", both.count())]


def test_daily_metrics_stream_emits_closed_days(spark, folder):
    land(spark, f"{folder}/raw", [(u, "purchase", f"2024-01-0{d}T10:00:00", 2.0) for d in (1, 2, 3, 4) for u in range(d)])
    events = jobs.file_stream(spark, f"{folder}/raw", RAW).withColumn("event_ts", F.col("timestamp").cast("timestamp_ntz"))
    jobs.incremental_daily_metrics(events, f"{folder}/d", f"{folder}/cp")
    got = {r["date"].day: (r["total_events"], r["purchases"], r["revenue"], r["daily_active_users"])
           for r in spark.read.parquet(f"{folder}/d").collect()}
    assert got == {1: (1, 1, 2.0, 1), 2: (2, 2, 4.0, 2)}


def test_quality_pipeline(spark, folder):
    rows = [(f"O{i}", i % 5 + 1, dt.date(2024, 10, 1 + i % 20), 10.0 + i / 100, 1, "shipped") for i in range(60)]
    ddl = "order_id string, customer_id bigint, order_date date, amount double, quantity int, status string"
    orders, customers = spark.createDataFrame(rows, ddl), spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")
    write_csv(orders, f"{folder}/good")
    log = RuleLog(spark, f"{folder}/log")
    done = quality_pipeline(spark, f"{folder}/good", f"{folder}/out", customers, log, as_of="2024-12-01")
    assert done.count() == 60 and log.read().count() == 3
    with pytest.raises(ValueError, match="orphan_orders"):
        quality_pipeline(spark, f"{folder}/good", f"{folder}/out2", customers.where("id > 1"), log, as_of="2024-12-01")
    write_csv(orders.withColumn("status", F.lit("shippd")), f"{folder}/bad")
    with pytest.raises(SchemaError):
        quality_pipeline(spark, f"{folder}/bad", f"{folder}/out3", customers, log)


def test_event_run_sample(spark, folder, tuples):
    raw = spark.createDataFrame([(u, "click" if u <= 50 else "view", "2024-01-01T10:00:00", 10.0) for u in range(1, 101)], RAW)
    assert [r[1:] for r in tuples(event_run(raw, folder))] == [("click", 50, 50, 500.0), ("view", 50, 50, 500.0)]
    with pytest.raises(SchemaError):
        event_run(raw.withColumn("timestamp", F.lit("not a time")), folder)


def test_multi_source_run_counts_and_refuses(spark, folder):
    day = dt.datetime(2024, 1, 1)
    customers = spark.createDataFrame([(1, "a@b.cc", "old", day), (1, "a@b.cc", "new", day + dt.timedelta(1)), (2, "c@d.ee", "x", day)],
                                      "customer_id bigint, email string, name string, updated_at timestamp_ntz")
    orders = spark.createDataFrame([(1, 1, 8.0, day, [(2.5, 2), (1.0, 3)]), (2, 9, 1.0, day, [(1.0, 1)])],
                                   "order_id bigint, customer_id bigint, total double, order_date timestamp_ntz, line_items array<struct<price:double,quantity:int>>")
    stock = spark.createDataFrame([(1, -1), (2, 0)], "sku int, quantity int")
    metrics = multi_source_run(customers, orders, stock, f"{folder}/out")
    assert metrics["customers"]["removed"] == 1 and metrics["orders"] == {"rows": 2, "revenue": 9.0}
    assert {r["order_id"]: r["name"] for r in spark.read.parquet(f"{folder}/out/orders").collect()} == {1: "new", 2: None}
    assert spark.read.parquet(f"{folder}/out/inventory").count() == 1
    with pytest.raises(ValueError, match="1 orders with total mismatches"):
        multi_source_run(customers, orders.withColumn("total", F.when(F.col("order_id") == 1, 8.5).otherwise(1.0)), stock, f"{folder}/o2")
