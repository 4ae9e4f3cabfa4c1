import datetime as dt
import glob
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeworks.catalog import QUERIES
from lakeworks.catalog.files import TABLES
from lakeworks.functions import month_range
from lakeworks.plans.pipelines import ingest_sales, raw_to_curated
from lakeworks.session import size_shuffles
from lakeworks.sources import layout, readers, writers

DDL = "id bigint, at timestamp_ntz, x double"


@pytest.fixture
def facts(spark):
    start = dt.datetime(2023, 12, 30)
    return spark.createDataFrame([(i, start + dt.timedelta(days=i % 70), float(i)) for i in range(300)], DDL)


def test_csv_variants(spark, facts, folder, tuples):
    writers.write_csv(facts, f"{folder}/plain", delimiter=";")
    writers.write_csv(facts, f"{folder}/gz", gzip=True)
    assert glob.glob(f"{folder}/gz/*.csv.gz")
    want = tuples(facts)
    assert tuples(readers.scan_csv(spark, f"{folder}/plain", schema=DDL, delimiter=";")) == want
    back = readers.scan_csv_gz(spark, f"{folder}/gz", schema=DDL, spread=6)
    assert tuples(back) == want and back.rdd.getNumPartitions() == 6
    with open(f"{folder}/bad.csv", "w") as f:
        f.write("id,at,x\nnope,2024-01-01,1\n")
    with pytest.raises(Exception):
        readers.scan_csv(spark, f"{folder}/bad.csv", schema=DDL).collect()


def test_json_documents(spark, folder, tuples):
    with open(f"{folder}/array.json", "w") as f:
        json.dump([{"id": 1, "x": 2.5}, {"id": 2, "x": None}], f)
    assert tuples(readers.scan_json_array(spark, f"{folder}/array.json", schema="id bigint, x double")) == [(1, 2.5), (2, None)]
    for page in (1, 2):
        with open(f"{folder}/page{page}.json", "w") as f:
            json.dump({"orders": [{"id": page * 10}, {"id": page * 10 + 1}], "page": page}, f)
    got = readers.scan_json_pages(spark, f"{folder}/page*.json", field="orders", item_schema=StructType.fromDDL("id bigint"))
    assert tuples(got) == [(10,), (11,), (20,), (21,)]


def test_raw_drops_are_immutable_and_the_newest_is_read(spark, facts, folder):
    root = f"{folder}/raw"
    writers.land_raw(facts, root, "20240101T000000")
    writers.land_raw(facts.where("id < 10"), root, "20240102T000000")
    with pytest.raises(AnalysisException):
        writers.land_raw(facts, root, "20240102T000000")
    newest = readers.latest_landing(readers.scan_csv_gz(spark, root, schema=DDL + ", ingest_ts string"), root)
    assert newest.count() == 10
    assert "PartitionFilters: [isnotnull(ingest_ts" in layout.plan_text(newest, "simple")


def test_date_tree_prunes(spark, facts, folder):
    layout.write_by_date(facts, f"{folder}/t", "at")
    assert os.path.isdir(f"{folder}/t/year=2024/month=1")
    january = readers.scan_partitioned(spark, f"{folder}/t").where("year = 2024 AND month = 1")
    assert january.count() == facts.where(month_range("at", "2024-01")).count() > 0
    assert "PartitionFilters: [isnotnull(year" in layout.plan_text(january, "simple")
    assert set(january.columns) == {"id", "at", "x", "year", "month", "day"}
    (one,) = glob.glob(f"{folder}/t/year=2024/month=1/*.parquet")
    times = [r["at"] for r in spark.read.parquet(one).collect()]
    assert times == sorted(times)


def test_month_dates_leave_out_stray_years(spark, facts, folder):
    layout.write_by_month_date(facts, f"{folder}/m", "at", 2024)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{folder}/m/pickup_month=*")) == [
        "pickup_month=2024-01-01", "pickup_month=2024-02-01", "pickup_month=2024-03-01"]


def test_buckets_keep_a_key_together(spark, facts, folder):
    layout.write_hash_buckets(facts.withColumn("k", F.col("id") % 37), f"{folder}/b", "k")
    df = readers.scan_partitioned(spark, f"{folder}/b")
    assert df.count() == 300 and df.groupBy("k").agg(F.count_distinct("bucket").alias("n")).where("n > 1").count() == 0
    assert df.agg(F.max("bucket")).first()[0] <= 15


def test_bucketed_join_needs_no_shuffle(spark, facts):
    layout.save_bucketed(facts, "facts_a", "id", 4)
    layout.save_bucketed(facts, "facts_b", "id", 4)
    joined = spark.table("facts_a").hint("merge").join(spark.table("facts_b"), "id")
    text = layout.plan_text(joined, "simple")
    assert "SortMergeJoin" in text and "Exchange" not in text and joined.count() == 300


def test_buckets_grow_with_the_table_and_are_a_file_each(spark, facts, folder):
    facts.repartition(6).write.parquet(f"{folder}/raw")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{folder}/raw/*.parquet"))
    assert layout.bucket_count(spark, f"{folder}/raw") == 8
    assert layout.bucket_count(spark, f"{folder}/raw", bucket_bytes=size // 12) in (12, 13)
    layout.save_bucketed(facts.repartition(6), "facts_by_size", "id", 12, path=f"{folder}/t")
    assert len(glob.glob(f"{folder}/t/*.parquet")) == 12 and spark.table("facts_by_size").count() == 300


def test_single_file_of_a_small_table(spark, facts, folder):
    layout.write_single(facts, f"{folder}/one")
    assert len(glob.glob(f"{folder}/one/*.parquet")) == 1


def test_bucketing_anew_leaves_no_old_rows(spark, facts, folder):
    layout.write_hash_buckets(facts, f"{folder}/b", "id", 16)
    layout.write_hash_buckets(facts, f"{folder}/b", "id", 8)
    assert spark.read.parquet(f"{folder}/b").count() == 300 and len(glob.glob(f"{folder}/b/bucket=*")) == 8


def test_sorted_files_hold_disjoint_ranges(spark, facts, folder):
    layout.sorted_write(facts, f"{folder}/s", ["id"])
    ranges = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/s").groupBy(F.input_file_name().alias("f"))
                    .agg(F.min("id").alias("lo"), F.max("id").alias("hi")).select("lo", "hi").collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_sort_value_may_fill_several_files(spark, facts, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.sorted_write(facts.withColumn("k", F.lit(1)), f"{folder}/s", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{folder}/s/*.parquet")) > 4 and spark.read.parquet(f"{folder}/s").count() == 300


def test_shuffles_are_sized_from_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10 << 40) == 40_960 and size_shuffles(spark, 100 << 40) == 409_600
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_reports_on_files(spark, facts, folder):
    layout.write_by_date(facts, f"{folder}/t", "at")
    report = layout.partition_report(spark, f"{folder}/t").collect()
    assert all(r["verdict"] == "small" and r["path"].startswith("year=") for r in report)
    files = glob.glob(f"{folder}/t/**/*.parquet", recursive=True)
    total = layout.footer_totals(spark, f"{folder}/t").first()
    assert (total["files"], total["num_rows"]) == (len(files), 300)
    assert layout.footer_report(spark, f"{folder}/t").where("ratio IS NULL").count() == 0


def test_footers_of_a_table_in_several_files_add_up(spark, sf, folder):
    for name in TABLES:
        rows = spark.read.parquet(f"{sf}/{name}.parquet")
        (rows.repartition(3) if name in ("orders", "documents") else rows.coalesce(1)).write.parquet(f"{folder}/{name}.parquet")
    report = QUERIES["footer_report"](spark, folder).collect()
    assert len(report) == len(TABLES) and all(r["shrunk"] for r in report)
    assert {r["name"]: r["num_rows"] for r in report} == {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in TABLES}


def test_compaction_and_export(spark, facts, folder):
    facts.repartition(20).write.parquet(f"{folder}/many")
    writers.compact(spark, [f"{folder}/many"], f"{folder}/few")
    assert len(glob.glob(f"{folder}/few/*.parquet")) < 5 and spark.read.parquet(f"{folder}/few").count() == 300
    facts.createOrReplaceTempView("facts_view")
    assert writers.export_tables(spark, ["facts_view", "gone"], f"{folder}/out", "csv") == ["facts_view"]
    assert readers.scan_csv(spark, f"{folder}/out/facts_view", schema=DDL).count() == 300


def test_object_store_settings():
    options = readers.object_store_options("http://host:9000", "key", "secret")
    assert options["spark.hadoop.fs.s3a.path.style.access"] == "true"
    with pytest.raises(ValueError):
        readers.scan_object_store(None, "/local/path")


def test_ingest_and_curate(spark, folder):
    sales = spark.createDataFrame([(1, 50.0), (2, 150.0), (3, 100.0)], "order_id bigint, amount double")
    writers.write_csv(sales, f"{folder}/sales")
    assert ingest_sales(spark, f"{folder}/sales", f"{folder}/out", "order_id bigint, amount double") == 1
    raw = spark.createDataFrame([("1", "A@b.c", "2024-01-15 10:00:00", "0", "paid", "x")],
                                "id string, email string, created_at string, total_price string, financial_status string, fulfillment_status string")
    with pytest.raises(ValueError, match="no rows"):
        raw_to_curated(raw, f"{folder}/staging", f"{folder}/curated")
