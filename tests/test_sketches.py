"""Stored sketches and digests: longer periods, exact medians, files that are not read again."""

import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.functions.vector import hashed_ngrams
from lakeworks.operators import marts
from lakeworks.operators import retrieval as ret
from lakeworks.plans import versions
from lakeworks.quality.schema import Rule, TableSchema
from lakeworks.quality import schema


def grams(text, dim, n):
    out, text = [0.0] * dim, text or ""
    for i in range(len(text) - n + 1):
        code = 0
        for c in text[i:i + n]:
            code = (code * 65599 + ord(c)) % 1000000007
        out[code % dim] += 1
    return out


@pytest.mark.parametrize("dim,n", [(384, 3), (7, 2), (1, 1)])
def test_hashed_ngrams(spark, dim, n):
    texts = [None, "", "a", "ab", "abc", "aaaa aaaa", "h\u00e9llo w\u00f6rld", "\U0001f600\U0001f600x\U0001f600", "word " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", hashed_ngrams("t", dim, n).alias("v"))
    assert {r["id"]: list(r["v"]) for r in df.collect()} == {i: grams(t, dim, n) for i, t in enumerate(texts)}


def trips_of(rows, spark):
    return spark.createDataFrame(rows, "d string, pickup_zone bigint, clean_amount double").select(
        F.col("d").cast("timestamp_ntz").alias("pickup_date"), "pickup_zone", "clean_amount", F.lit(1.0).alias("clean_distance"))


@pytest.mark.parametrize("margin", [0.02, 0.0, 0.4])
def test_medians_of_months_from_days(spark, margin):
    draw = random.Random(4)
    rows = [(f"2024-0{1 + k % 2}-{1 + k % 28:02d}", 1 if k % 3 else k % 40, None if k % 17 == 0 else round(draw.expovariate(0.01), 2)) for k in range(9000)]
    rows += [("2024-01-05", 90, 7.0)] * 50 + [("2024-01-05", 91, None), ("2024-02-01", 92, 3.25), ("2024-02-01", 92, 4.0)]
    trips = trips_of(rows, spark)
    want = {(r["pickup_date"], r["pickup_zone"]): (r["trip_count"], r["median_fare"]) for r in marts.monthly_zone_summary(trips).collect()}
    found = marts.monthly_medians(marts.zone_sketches(trips, size=64), trips, margin=margin)
    assert {(r["pickup_date"], r["pickup_zone"]): (r["trip_count"], r["median_fare"]) for r in found.collect()} == want
    assert marts.monthly_medians(marts.zone_sketches(trips.where("false")), trips.where("false")).collect() == []


def test_users_of_weeks_from_days(spark):
    rows = [(f"2024-03-{4 + k % 14:02d} 10:00:00", (k * 7919) % 5000) for k in range(40000)] + [("2024-03-04 00:00:00", None)]
    events = spark.createDataFrame(rows, "ts string, user bigint").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    days = marts.daily_user_sketches(events, "ts", "user")
    parts = marts.daily_user_sketches(events.where("user < 2500"), "ts", "user").unionByName(
        marts.daily_user_sketches(events.where("user >= 2500 OR user IS NULL"), "ts", "user"))
    exact = {r["w"]: r["n"] for r in events.groupBy(F.date_trunc("week", "ts").cast("timestamp_ntz").alias("w")).agg(F.count_distinct("user").alias("n")).collect()}
    for days in (days, parts):  # late rows of a day may come as another sketch
        got = {r["week"]: r for r in marts.active_users(days, "week").collect()}
        assert set(got) == set(exact) and sum(r["events"] for r in got.values()) == len(rows)
        assert all(abs(got[w]["users"] - n) <= 0.03 * n for w, n in exact.items())


def test_digests_are_taken_once_per_file(spark, folder):
    store, drops = versions.VersionStore(spark, f"{folder}/store"), f"{folder}/drops"
    df = spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name"))
    built = []

    def build(source):
        built.append(1)
        return source.agg(F.count("*").alias("n"))

    def run(**options):
        result, again = store.run_stage_on_files("s", {"source": drops}, build, **options)
        return result.first()["n"], again, spark.read.parquet(f"{store.root}/digests").count()

    df.where("id < 60").repartition(3).write.parquet(drops)
    assert run() == (60, True, 3) and run() == (60, False, 3)
    df.where("id >= 60").coalesce(1).write.mode("append").parquet(drops)
    assert run() == (100, True, 4) and run() == (100, False, 4) and run(code_version="2") == (100, True, 4)
    assert store.folder_hash(drops) == versions.fingerprint(df).first()["content_hash"]
    # The same rows in other files are the same input; files that are gone no longer count.
    df.repartition(2).write.mode("overwrite").parquet(drops)
    assert run(code_version="2") == (100, False, 6) and len(built) == 3
    df.where("id < 0").write.mode("overwrite").parquet(drops)
    assert run(code_version="2")[:2] == (0, True) and store.folder_hash(drops) == "0-0-0"
    assert len(glob.glob(f"{drops}/*.parquet")) >= 1


def test_probes_of_clustered_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    data = [(i, [float(x) for x in centres[i % 12] + 0.2 * rng.normal(size=16)]) for i in range(600)] + [(600, None), (601, [0.0] * 16)]
    df = spark.createDataFrame(data, "id bigint, embedding array<float>")
    asked = df.withColumnRenamed("id", "q")
    exact = {(r["q"], r["id"]) for r in ret.topk_cosine_batch(df, asked, 5, ["id"], "q").collect()}

    def found(**options):
        return {(r["q"], r["id"]) for r in ret.topk_ann_batch(df, asked, 5, ["id"], "q", **options).collect()}

    assert found(probes=64) == exact
    few = found(probes=16)
    assert len(few) == len(exact) and len(few & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("words", [1 << 16, 1])
def test_unique_columns_whatever_the_filter_holds(spark, monkeypatch, words):
    monkeypatch.setattr(schema, "FILTER_WORDS", words)  # a filter that is full lets rows through, no more
    rows = [(i, None if i % 5 == 0 else f"k{i % 70}", i // 2 if i < 20 else i + 1000, "x") for i in range(100)] + [(None, None, 7, "x")] * 2
    df = spark.createDataFrame(rows, "a bigint, b string, c bigint, pad string")
    table = TableSchema({"a": Rule("bigint", nullable=True, unique=True), "b": Rule("string", nullable=True, unique=True), "c": Rule("bigint", unique=True)})
    count = [{v: sum(r[k] == v for r in rows) for v in {r[k] for r in rows}} for k in range(3)]
    want = sorted(((*r, [f"{n}:unique" for k, n in enumerate("abc") if r[k] is not None and count[k][r[k]] > 1] or None) for r in rows), key=str)
    assert sorted((tuple(r) for r in table.marked(df).collect()), key=str) == want
    assert table.marked(df.where("false")).collect() == []
    valid, rejected = table.split(df)
    assert valid.count() + rejected.count() == len(rows) and rejected.count() == sum(w[4] is not None for w in want)
