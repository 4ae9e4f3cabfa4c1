import time

import pytest
from pyspark.sql import functions as F

from lakeworks.plans import versions, warehouse
from lakeworks.session import cut_lineage, new_folder, path_exists


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(i, f"n{i}", 1.5 * i) for i in range(50)], "id bigint, name string, x double")


@pytest.fixture
def store(spark, folder):
    return versions.VersionStore(spark, f"{folder}/store")


def test_hash_ignores_order_partitions_and_column_order(df):
    want = versions.fingerprint(df).first()
    assert versions.fingerprint(df.repartition(9).orderBy(F.rand()).select("x", "name", "id")).first() == want
    assert versions.fingerprint(df.withColumn("x", F.when(F.col("id") == 3, 0.0).otherwise(F.col("x")))).first() != want
    assert versions.fingerprint(df.unionByName(df.where("id = 1"))).first() != want
    assert versions.fingerprint(df.where("false")).first()["content_hash"] == "0-0-0"


def test_diff(df, tuples):
    assert versions.diff(df, df.repartition(5), ["id"]).count() == 0
    new = df.where("id <> 7").withColumn("x", F.when(F.col("id") == 8, -1.0).otherwise(F.col("x"))).unionByName(
        df.where("id = 1").withColumn("id", F.lit(100).cast("bigint")))
    assert tuples(versions.diff(df, new, ["id"])) == [(100, "added"), (7, "removed"), (8, "changed")]
    # A repeated key counts as a change, and so does a NULL that became a value.
    assert tuples(versions.diff(df, df.unionByName(df.where("id = 2")), ["id"])) == [(2, "changed")]
    nulled = df.withColumn("name", F.when(F.col("id") == 4, None).otherwise(F.col("name")))
    assert tuples(versions.diff(nulled, df, ["id"])) == [(4, "changed")]


def test_commit_tag_checkout(df, store):
    first = store.commit(df.where("id < 10"), "t", "ten rows", {"pipeline": "ingest_v1", "git_commit": "abc1234"})
    store.tag("t", "v1")
    second = store.commit(df, "t", "all rows")
    assert store.checkout("t").count() == 50 and store.checkout("t", "v1").count() == 10
    assert store.checkout("t", first).count() == 10 and store.resolve("t", "main") == second
    entry = store.manifest("t").where(F.col("snapshot") == first).first()
    assert entry["row_count"] == 10 and entry["metadata"]["git_commit"] == "abc1234" and entry["message"] == "ten rows"
    assert entry["content_hash"] == versions.fingerprint(df.where("id < 10")).first()["content_hash"]
    with pytest.raises(KeyError):
        store.checkout("t", "v9")


def test_branch_and_merge(df, store):
    store.commit(df, "t")
    store.branch("t", "experiment")
    store.commit(df.where("id < 5"), "t", branch="experiment")
    assert store.checkout("t").count() == 50 and store.checkout("t", "experiment").count() == 5
    store.merge("t", "experiment")
    assert store.checkout("t").count() == 5


def test_failed_audit_leaves_main(df, store):
    checks = {"rows": F.count("*") > 0, "x": F.min("x") >= 0}
    store.write_audit_publish(df, "t", checks)
    with pytest.raises(ValueError, match="x"):
        store.write_audit_publish(df.withColumn("x", F.lit(-1.0)), "t", checks)
    assert versions.diff(df, store.checkout("t"), ["id"]).count() == 0
    assert store.checkout("t", "staged").agg(F.min("x")).first()[0] == -1.0


def test_stage_lock(df, store):
    def build(source):
        return source.groupBy().agg(F.count("*").alias("n"))

    assert store.run_stage("s", {"source": df}, build)[1]
    assert not store.run_stage("s", {"source": df.repartition(3)}, build)[1]
    assert store.run_stage("s", {"source": df}, build, code_version="2")[1]
    result, rebuilt = store.run_stage("s", {"source": df.where("id > 0")}, build, code_version="2")
    assert rebuilt and result.first()["n"] == 49


def test_stale_and_cached(spark, df, store, folder):
    df.write.parquet(f"{folder}/in")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(f"{folder}/in").agg(F.count("*").alias("n"))

    inputs = [f"{folder}/in"]
    assert [warehouse.materialise_if_stale(spark, f"{folder}/out", inputs, build)[1] for _ in range(2)] == [True, False]
    assert [warehouse.materialise_cached(store, "c", inputs, build)[1] for _ in range(2)] == [True, False]
    time.sleep(1.1)  # file times have a resolution of a second on some systems
    df.write.mode("append").parquet(f"{folder}/in")
    assert warehouse.materialise_if_stale(spark, f"{folder}/out", inputs, build)[0].first()["n"] == 100
    result, rebuilt = warehouse.materialise_cached(store, "c", inputs, build)
    assert rebuilt and result.first()["n"] == 100
    assert warehouse.materialise_cached(store, "c", inputs, build, ttl_seconds=0)[1] and len(calls) == 5


def test_warehouse_reopens(spark, folder):
    trips = spark.createDataFrame([(1, 10.0, 5.0)], "zone int, miles double, fare double")
    trips.select(F.current_timestamp().cast("timestamp_ntz").alias("tpep_pickup_datetime"),
                 F.current_timestamp().cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
                 F.lit(1).alias("passenger_count"), F.col("miles").alias("trip_distance"), F.col("zone").alias("PULocationID"),
                 F.col("zone").alias("DOLocationID"), F.lit(1).alias("RatecodeID"), F.lit(1).alias("payment_type"),
                 F.col("fare").alias("fare_amount"), F.lit(0.0).alias("tip_amount"), F.col("fare").alias("total_amount")
                 ).write.parquet(f"{folder}/trips")
    other = spark.newSession()
    assert warehouse.register_views(other, f"{folder}/trips", f"{folder}/summary") == ["trips", "clean_trips"]
    assert other.sql("SELECT trip_efficiency(clean_distance, 30) AS mph FROM clean_trips").first()["mph"] == pytest.approx(20.0)
    assert other.sql("SELECT trip_efficiency(10, 0) AS mph").first()["mph"] is None
    other.sql("SELECT 1 AS n").write.parquet(f"{folder}/summary")
    assert "daily_summary" in warehouse.register_views(other, f"{folder}/trips", f"{folder}/summary")


def test_scratch_folder_follows_the_session(spark, df):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = new_folder(spark, "x")
    assert named is None or path.startswith(named)
    kept = cut_lineage(df, "kept")
    assert kept.count() == 50 and kept.schema == df.schema
    assert not path_exists(spark, path) and path_exists(spark, "/tmp")
