import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeworks.functions import nested_total
from lakeworks.operators import clean, joins, marts
from lakeworks.sources.readers import union_by_name


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([("Alice@Example.com", 1500.0, "US"), ("bob@test.COM", None, None),
                                  ("Charlie@DEMO.org", 2300.0, "CA"), ("dave@site.NET", 450.0, "UK")],
                                 "email string, revenue double, country string")


def test_customers_example(customers, tuples):
    cleaned = clean.clean_customers(customers)
    assert cleaned.columns == ["email", "revenue", "country", "email_clean", "country_clean"]
    assert ("bob@test.com", 0.0, "UNKNOWN") in tuples(cleaned, "email_clean", "revenue", "country_clean")
    got = [tuple(r) for r in marts.country_summary(cleaned).collect()]
    assert got == [("CA", 1, 2300.0, 2300.0), ("US", 1, 1500.0, 1500.0), ("UK", 1, 450.0, 450.0), ("UNKNOWN", 1, 0.0, 0.0)]


def test_status_thresholds_are_strict(spark):
    cases = [(85.0, 100.0, 5.0, "normal"), (85.1, 100.0, 5.0, "warning"), (92.1, 100.0, 5.0, "critical"),
             (70.0, 152.0, 5.0, "warning"), (70.0, 100.0, 12.1, "critical"), (85.1, 152.1, 0.0, "critical")]
    df = spark.createDataFrame(cases, "temperature double, pressure double, vibration double, want string")
    assert clean.classify_status(df).where("status <> want").count() == 0


def test_routing(spark):
    cases = [("Find events like overheating", "semantic_search"), ("What is vibration", "docs"),
             ("average mean temperature", "docs"), ("count by facility", "sql")]
    df = clean.route_questions(spark.createDataFrame(cases, "q string, want string"), "q")
    assert df.where("tool <> want").count() == 0
    term = spark.createDataFrame([("find events like pump too hot ",)], "q string").select(clean.search_term("q")).first()[0]
    assert term == "pump too hot"


def test_schema_evolution(spark, tuples):
    jan = spark.createDataFrame([(i, "2024-01-0%d" % i, 10 * i) for i in (1, 2, 3)],
                                "user_id bigint, signup_date string, revenue bigint")
    feb = spark.createDataFrame([(4, "2024-02-01", 40, "google"), (5, "2024-02-02", 50, "email"), (6, "2024-02-03", 60, "direct")],
                                "user_id bigint, signup_date string, revenue bigint, referral_source string")
    both = union_by_name([jan, feb])
    sources = [(1, None), (2, None), (3, None), (4, "google"), (5, "email"), (6, "direct")]
    assert tuples(both, "user_id", "referral_source") == sources
    filled = clean.add_column_with_default(both, "referral_source", "unknown")
    assert tuples(filled, "user_id", "referral_source")[:3] == [(1, "unknown"), (2, "unknown"), (3, "unknown")]
    assert tuples(clean.add_column_with_default(jan, "referral_source", "unknown"), "referral_source") == [("unknown",)] * 3
    wide = clean.add_column_as_new_type(jan, "revenue", "revenue_double", "double")
    assert dict(wide.dtypes)["revenue"] == "bigint" and dict(wide.dtypes)["revenue_double"] == "double"
    with pytest.raises(ValueError):
        clean.add_column_as_new_type(jan, "revenue", "revenue", "double")
    text = clean.add_column_as_new_type(jan, "signup_date", "n", "int", lenient=True)
    assert tuples(text, "n") == [(None,)] * 3


def test_stage_orders(spark, tuples):
    raw = spark.createDataFrame([("1", "A@B.C", "2024-01-15 10:20:30", "12.5", "paid", None),
                                 ("2", "d@e.f", "2024-01-15 10:20:31", "0", "paid", "fulfilled")],
                                "id string, email string, created_at string, total_price string, financial_status string, fulfillment_status string")
    staged = clean.stage_orders(raw)
    assert tuples(staged) == [(1, "a@b.c", at("2024-01-15 10:20:30"), 12.5, "paid", None)]
    assert marts.null_profile(staged).first()["total_nulls"] == 1


def test_keep_latest_and_dedup(spark, tuples):
    df = spark.createDataFrame([(1, "old", at("2024-01-01")), (1, "new", at("2024-01-02")), (2, "x", None), (2, "y", at("2023-01-01"))],
                               "id int, v string, ts timestamp_ntz")
    assert tuples(clean.keep_latest(df, "id", "ts"), "id", "v") == [(1, "new"), (2, "y")]
    assert tuples(clean.dedup(df, ["id"], ["v"]), "id", "v") == [(1, "new"), (2, "x")]
    assert clean.dedup(df, ["id"]).count() == 2


def test_sample_is_stable_and_complete(spark, tuples):
    df = spark.range(1000)
    first = tuples(clean.sample_rows(df, 50, ["id"]))
    assert len(first) == 50 and first == tuples(clean.sample_rows(df.repartition(13), 50, ["id"]))
    assert first != tuples(clean.sample_rows(df, 50, ["id"], seed=7))
    assert clean.sample_rows(df, 5000, ["id"]).count() == 1000


def test_text_and_events(spark):
    row = spark.createDataFrame([("pump", "S1", "A01", "warning", 86.5, 120.0, 3.2)],
                                "device_type string, sensor_id string, facility string, status string, temperature double, pressure double, vibration double")
    assert clean.render_text(row).first()["searchable_text"] == (
        "pump sensor S1 at A01: status warning, temp 86.5°C, pressure 120.0 PSI, vibration 3.2 mm/s")
    raw = spark.createDataFrame([(1, "click", "2024-01-01T10:00:00", None), (None, "view", "2024-01-01T10:00:00", 1.0),
                                 (2, "login", "2024-01-01T10:00:00", 1.0), (3, "view", "never", 2.0)],
                                "user_id bigint, event_type string, timestamp string, amount double")
    got = {r["user_id"]: (r["event_ts"], r["amount"]) for r in clean.clean_events(raw).collect()}
    assert got == {1: (at("2024-01-01 10:00:00"), 0.0), 3: (None, 2.0)}


def test_nested_total(spark):
    df = spark.createDataFrame([([(2.5, 2), (1.0, 3)],), ([],)], "items array<struct<price:double,quantity:int>>")
    assert [r[0] for r in df.select(nested_total("items")).collect()] == [8.0, 0.0]


def test_enrich_keeps_unmatched_and_renames_clashes(spark, tuples):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    right = spark.createDataFrame([(1, "x", 9)], "k int, name string, extra int")
    assert tuples(joins.enrich(left, right, "k")) == [(1, "a", "x", 9), (2, "b", None, None)]
    assert joins.enrich(left, right, "k").columns == ["k", "name", "name_right", "extra"]
    assert joins.enrich(left, right, "k", ["extra"], how="inner").columns == ["k", "name", "extra"]


def test_anti_join_with_null_keys(spark, tuples):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert tuples(joins.anti_join(left, right, "k")) == [(2,), (None,)]


def test_star_join_drops_unknown_codes(spark, tuples):
    trips = spark.createDataFrame([(2, 1, 10.0), (2, 1, 20.0), (3, 9, 1.0), (99, 1, 5.0), (None, 1, 5.0)],
                                  "rate_code int, payment_type int, fare_amount double")
    assert tuples(joins.star_join(trips)) == [("JFK", "Credit card", 2, 15.0, 30.0)]


def test_normalise(spark):
    df = spark.createDataFrame([(1.239, "2024-01-01", " Shipped\t")], "amount double, order_date string, status string")
    row = clean.normalise_text_num(df).first()
    assert (row["amount"], row["order_date"], row["status"]) == (1.24, dt.date(2024, 1, 1), "shipped")
    assert clean.add_fee(df).first()["fee"] == pytest.approx(1.239 * 0.029)
    assert clean.snapshot_inventory(spark.createDataFrame([(-1,), (0,), (2,)], "quantity int")).count() == 2
