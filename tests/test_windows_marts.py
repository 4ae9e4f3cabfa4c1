import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeworks import functions as fn
from lakeworks.operators import marts, windows
from lakeworks.operators.clean import clean_events, clean_trips


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def visits(spark):
    day = "2024-10-01 "
    data = [(1, "S1", "10:00"), (1, "S1", "10:05"), (1, "S2", "11:00"), (2, "S3", "09:30"), (2, "S3", "09:45"),
            (3, "S4", "14:00"), (3, "S4", "14:20"), (3, "S4", "14:25"), (3, "S5", "15:30")]
    return spark.createDataFrame([(u, s, at(day + t)) for u, s, t in data],
                                 "user_id bigint, session_id string, event_time timestamp_ntz")


@pytest.mark.parametrize("bucket", [1, 600, 3600, 10 ** 6])
def test_session_gaps_example(visits, tuples, bucket):
    gaps = windows.session_gaps(visits, bucket_seconds=bucket)
    assert tuples(gaps, "user_id", "session_gap_seconds") == [(1, 3300), (3, 3900)]
    assert tuples(marts.gap_stats(gaps)) == [(1, 1, 3300.0), (3, 1, 3900.0)]


def test_gap_of_exactly_the_limit_is_kept_in_the_session(spark):
    df = spark.createDataFrame([(1, "a", at("2024-10-01 10:00:00")), (1, "b", at("2024-10-01 10:30:00.900"))],
                               "user_id bigint, session_id string, event_time timestamp_ntz")
    assert windows.session_gaps(df).count() == 0


@pytest.mark.parametrize("chunk", [3, 50, 500, 100_000])
def test_chunked_lag_equals_plain_lag(spark, tuples, chunk):
    rng = random.Random(chunk)
    start = at("2024-01-01 00:00:00")
    # One user holds most rows, ids and times are missing for some, times repeat.
    data = [(rng.choice([1] * 8 + [2, None]), start + dt.timedelta(seconds=rng.randint(0, 5000)), i) for i in range(600)]
    data += [(1, None, 1000), (1, None, 1001), (None, None, 1002)]
    df = spark.createDataFrame(data, "u bigint, ts timestamp_ntz, id bigint")
    plain = df.withColumn("p", F.lag("ts").over(Window.partitionBy("u").orderBy("ts", "id")))
    chunked = windows.previous_event(df, "u", "ts", "id", chunk, "p")
    assert tuples(chunked, "id", "p") == tuples(plain, "id", "p")


def test_moving_average_and_shares(spark):
    days = spark.createDataFrame([(at(f"2024-01-{d:02d}"), "a" if d % 2 else "b", 10.0 * d)
                                  for d in range(1, 11) for _ in range(d)], "ts timestamp_ntz, s string, x double")
    got = [r["rolling_avg_7d"] for r in windows.moving_average(days, "ts").collect()]
    assert got == [statistics.mean(range(max(1, d - 6), d + 1)) for d in range(1, 11)]
    shares = windows.share_of_total(days, "s", "x").collect()
    assert sum(r["pct"] for r in shares) == pytest.approx(100, abs=0.02)
    assert [r["revenue"] for r in shares] == sorted([r["revenue"] for r in shares], reverse=True)


def test_rank_breaks_ties_by_zone(spark):
    df = spark.createDataFrame([(at("2024-01-05"), z) for z in [9, 9, 1, 2, 3, 4, 5, 6]], "ts timestamp_ntz, z int")
    got = [(r["pickup_zone"], r["rank"]) for r in windows.top_n_per_month(df, "ts", "z", 3).collect()]
    assert got == [(9, 1), (1, 2), (2, 3)]


def test_zscore(spark):
    values = [10.0] * 50 + [1000.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double")
    (row,) = windows.zscore_outliers(df, "id", "x").collect()
    want = (1000 - statistics.mean(values)) / statistics.stdev(values)
    assert row["order_id"] == 50 and row["z_score"] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("approximate", [False, True])
def test_median_per_zone(spark, approximate):
    rng = random.Random(3)
    data = [(at("2024-01-01"), rng.choice([1, 1, 1, 2, 3]), rng.choice([None, 1.0, 2.5]),
             rng.choice([None] + [round(rng.uniform(0, 50), 2) for _ in range(5)])) for _ in range(401)]
    data.append((at("2024-01-01"), 7, None, None))
    df = spark.createDataFrame(data, "pickup_date timestamp_ntz, pickup_zone int, clean_distance double, clean_amount double")
    for r in marts.daily_zone_summary(df, approximate=approximate).collect():
        mine = [d for d in data if d[1] == r["pickup_zone"]]
        amounts, lengths = [d[3] for d in mine if d[3] is not None], [d[2] for d in mine if d[2] is not None]
        assert r["trip_count"] == len(mine)
        if not amounts:
            assert r["median_fare"] is None and r["total_revenue"] is None and r["avg_distance"] is None
            continue
        assert r["total_revenue"] == pytest.approx(sum(amounts), abs=0.005)
        assert r["avg_distance"] == pytest.approx(statistics.mean(lengths), abs=0.0051)
        if not approximate:
            assert r["median_fare"] == pytest.approx(statistics.median(amounts), abs=0.0051)


def test_event_metrics_example(spark, tuples):
    raw = spark.createDataFrame([(u, "click" if u <= 50 else "view", "2024-01-01T10:00:00", 10.0) for u in range(1, 101)],
                                "user_id bigint, event_type string, timestamp string, amount double")
    got = tuples(marts.daily_event_metrics(clean_events(raw)))
    assert got == [(at("2024-01-01"), "click", 50, 50, 500.0), (at("2024-01-01"), "view", 50, 50, 500.0)]


def test_category_value_is_a_parameter(spark):
    items = spark.createDataFrame([(1, 5.0, at("2024-01-10"))], "k int, amount double, ts timestamp_ntz")
    products = spark.createDataFrame([(1, "A'; DROP TABLE x --")], "id int, cat string")
    args = (("k", "id"), "cat", "amount", "ts")
    got = marts.category_weekly(items, products, "A'; DROP TABLE x --", *args, as_of="2024-01-20").collect()
    assert [(r["week"], r["revenue"]) for r in got] == [(at("2024-01-08"), 5.0)]
    assert marts.category_weekly(items, products, "' OR 1=1 --", *args, as_of="2024-01-20").count() == 0


def test_trailing_reports_default_to_today(spark):
    today = dt.datetime.now().replace(hour=0, minute=0, second=0, microsecond=0)
    df = spark.createDataFrame([(today, 4.0), (today - dt.timedelta(days=400), 9.0)], "ts timestamp_ntz, x double")
    row = marts.recent_kpis(df, "ts", "x").first()
    assert (row["total_revenue"], row["total_orders"], row["avg_order_value"]) == (4.0, 1, 4.0)
    empty = marts.recent_kpis(df.where("false"), "ts", "x").first()
    assert (empty["total_revenue"], empty["total_orders"], empty["avg_order_value"]) == (None, 0, None)


def test_rounding_time_and_macro(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first()["v"]

    assert value(fn.round2(F.lit(0.285))) == 0.28 and value(fn.round2(F.lit(1.005))) == 1.0
    assert value(fn.round2(F.lit(-2.346))) == -2.35
    assert value(fn.minute_boundaries(F.lit("2024-01-01 00:00:59").cast("timestamp_ntz"),
                                      F.lit("2024-01-01 00:01:01").cast("timestamp_ntz"))) == 1
    assert value(fn.trip_efficiency(F.lit(10.0), F.lit(0))) is None
    assert value(fn.trip_efficiency(F.lit(10.0), F.lit(30))) == pytest.approx(20.0)
    assert value(fn.weekday_name(F.lit("2024-01-01").cast("date"))) == "Monday"
    assert value(fn.strip_all(F.lit("\t a b \n"))) == "a b"
    assert value(fn.week_of(F.lit("2024-01-07").cast("date"))) == at("2024-01-01")


def test_clean_trips_keeps_raw_beside_clean(spark):
    base = dict(tpep_pickup_datetime=at("2023-01-01 10:00:00"), tpep_dropoff_datetime=at("2023-01-01 10:10:00"),
                PULocationID=1, DOLocationID=2, RatecodeID=1, payment_type=1, tip_amount=0.0)
    cases = [(1, 0.0, 5.0, 10.0), (1, 101.0, 5.0, 501.0), (1, 100.0, 0.0, 500.0), (0, 1.0, 5.0, 9.0), (1, 1.0, -1.0, 9.0)]
    rows = [base | dict(passenger_count=p, trip_distance=d, fare_amount=f, total_amount=t) for p, d, f, t in cases]
    from lakeworks.operators.clean import TAXI_COLUMNS
    got = clean_trips(spark.createDataFrame(rows), TAXI_COLUMNS).collect()
    assert [(r["trip_distance"], r["clean_distance"], r["clean_amount"]) for r in got] == [
        (0.0, None, 10.0), (101.0, None, None), (100.0, 100.0, 500.0)]


@pytest.mark.parametrize("bucket", [7, 3600])
def test_previous_event_is_lag_for_any_bucket(spark, tuples, bucket):
    import random

    draw = random.Random(bucket)
    rows = [(draw.choice([1, 2, None]), f"s{i}", None if i % 17 == 0 else at("2024-01-01") + dt.timedelta(seconds=draw.randrange(200)))
            for i in range(150)]
    df = spark.createDataFrame(rows, "user_id bigint, session_id string, event_time timestamp_ntz")
    plain = df.selectExpr("*", "lag(event_time) over (partition by user_id order by event_time, session_id) as prev_event_time")
    assert tuples(windows.previous_event(df, "user_id", "event_time", "session_id", bucket)) == tuples(plain)


def test_gaps_shuffle_the_events_once(spark, visits):
    from lakeworks.sources.layout import plan_text

    text = plan_text(windows.previous_event(visits, "user_id", "event_time", "session_id"), "simple")
    assert text.count("Exchange hashpartitioning") <= 3 and "Broadcast" not in text


def test_zone_summaries_have_tasks_by_the_number_of_trips(spark, monkeypatch):
    monkeypatch.setattr(marts, "ZONE_ROWS", 50)
    rows = [(dt.datetime(2024, 1, 1 + i % 9), i % 37, float(i % 11), float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "pickup_date timestamp_ntz, pickup_zone long, clean_amount double, clean_distance double")
    out = marts.daily_zone_summary(df)
    assert out.rdd.getNumPartitions() == 40  # none is merged with another
    assert out.agg(F.sum("trip_count")).first()[0] == 2000
