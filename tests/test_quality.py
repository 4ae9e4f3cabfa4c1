import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import marts
from lakeworks.operators.clean import dedup
from lakeworks.quality import contracts as con
from lakeworks.quality import metrics
from lakeworks.quality.rules import (RuleLog, failures, future_orders, orphan_orders, quality_scorecard, require_no_critical,
                                     revenue_anomaly, scorecard_alert)
from lakeworks.quality.schema import CLEANED_EVENTS, CUSTOMERS, ORDERS, Rule, SchemaError, TableSchema

ORDER_DDL = "order_id string, customer_id bigint, order_date date, amount double, quantity int, status string"
DAY = dt.date(2024, 10, 1)


@pytest.fixture
def planted(spark):
    good = [(f"O{i:03d}", i % 50 + 1, DAY + dt.timedelta(days=i % 30), 10.0 + i, i % 10 + 1, "pending") for i in range(1, 96)]
    bad = [("O096", 1, DAY, -99999.0, 1, "pending"), ("O097", 1, DAY, 50.0, 0, "pending"),
           ("O098", 1, dt.date(2025, 1, 1), 50.0, 1, "pending"), ("O099", 1, DAY, 50.0, 1, "shippd"),
           ("O099", 2, DAY, 60.0, 1, "shipped")]
    return spark.createDataFrame(good + bad, ORDER_DDL)


def test_planted_errors_are_caught_exactly(planted, tuples):
    got = tuples(ORDERS.failure_cases(planted, "order_id"))
    assert got == [("O096", "amount", "greater_than(0)", "-99999.0"),
                   ("O097", "quantity", "greater_than_or_equal_to(1)", "0"),
                   ("O099", "order_id", "unique", "O099"), ("O099", "order_id", "unique", "O099"),
                   ("O099", "status", "isin(['pending', 'shipped', 'delivered', 'cancelled'])", "shippd")]
    with pytest.raises(SchemaError) as caught:
        ORDERS.validate(planted, "order_id")
    assert "order_id unique: 2" in str(caught.value) and caught.value.failure_cases.count() == 5


def test_split_keeps_every_row(planted):
    valid, rejected = ORDERS.split(planted)
    assert (valid.count(), rejected.count()) == (96, 4)
    assert valid.columns == planted.columns
    (row,) = rejected.where("order_id = 'O096'").collect()
    assert row["reasons"] == ["amount:greater_than(0)"]


def test_clean_step_leaves_97_rows(planted):
    kept = planted.where((F.col("amount") > 0) & (F.col("quantity") >= 1) & (F.col("status") != "shippd"))
    assert dedup(kept, ["order_id"], ["customer_id"]).count() == 97


def test_event_schema_rejects_bad_rows(spark, tuples):
    t = dt.datetime(2024, 1, 1)
    bad = spark.createDataFrame([(None, "click", t, 10.0), (2, "invalid", t, 20.0), (3, "view", t, 30.0)],
                                "user_id bigint, event_type string, event_ts timestamp_ntz, amount double")
    assert [(c, k) for _, c, k, _ in tuples(CLEANED_EVENTS.failure_cases(bad, "user_id"))] == [
        ("event_type", "isin(['click', 'view', 'purchase'])"), ("user_id", "not_null")]
    with pytest.raises(SchemaError, match="not in schema"):
        CLEANED_EVENTS.validate(bad.withColumn("timestamp", F.lit("x")), "user_id")
    assert CLEANED_EVENTS.validate(bad.where("user_id = 3"), "user_id").count() == 1


def test_coercion_reports_values_that_do_not_cast(spark, tuples):
    schema = TableSchema({"id": Rule("int"), "x": Rule("double", ge=0)}, strict=True, coerce=True)
    df = spark.createDataFrame([("1", "2.5"), ("two", "3"), ("3", None), ("4", "-1")], "id string, x string")
    assert tuples(schema.failure_cases(df, "id")) == sorted([
        ("two", "id", "dtype(int)", "two"), ("3", "x", "not_null", None), ("4", "x", "greater_than_or_equal_to(0)", "-1")], key=str)
    good, bad = schema.split(df)
    assert {r["id"] for r in bad.collect()} == {"two", "3", "4"}
    assert good.dtypes == [("id", "int"), ("x", "double")] and good.count() == 1


def test_structure_and_regex(spark):
    df = spark.createDataFrame([(1, "a@b.cc", "A", dt.datetime(2024, 1, 1)), (2, "no mail", "B", dt.datetime(2024, 1, 1))],
                               "customer_id bigint, email string, name string, updated_at timestamp_ntz")
    (case,) = CUSTOMERS.failure_cases(df, "customer_id").collect()
    assert (case["row_key"], case["column"]) == ("2", "email")
    with pytest.raises(SchemaError, match="missing"):
        CUSTOMERS.validate(df.drop("name"), "customer_id")
    with pytest.raises(SchemaError, match="expected bigint"):
        CUSTOMERS.validate(df.withColumn("customer_id", F.col("customer_id").cast("int")), "customer_id")


@pytest.fixture
def staging(spark):
    orders = [(f"O{i}", 999 if i % 20 == 0 else i % 50 + 1, DAY + dt.timedelta(days=i % 20),
               5000.0 if i == 7 else 10.0, 1, "pending") for i in range(100)]
    return spark.createDataFrame(orders, ORDER_DDL), spark.createDataFrame([(i,) for i in range(1, 51)], "id bigint")


def test_rules_and_log(spark, staging, folder):
    orders, customers = staging
    log = RuleLog(spark, f"{folder}/log")
    first = log.run([orphan_orders(orders, customers), revenue_anomaly(orders), future_orders(orders, as_of="2024-10-11")],
                    "first", "2024-10-11 08:00:00")
    assert {r["check_name"]: r["failing_rows"] for r in first.collect()} == {
        "orphan_orders": 5, "revenue_anomaly": 1, "future_orders": 45}
    assert [r["level"] for r in failures(first).collect()] == ["critical", "critical", "warning"]
    with pytest.raises(ValueError, match="orphan_orders"):
        require_no_critical(first)
    # The next run is judged by its own rows only.
    second = log.run([orphan_orders(orders.where("customer_id < 900"), customers), revenue_anomaly(orders)], "second")
    assert require_no_critical(second) == ["revenue_anomaly"]
    assert log.read().count() == 5
    # Repeating a run replaces its own rows; a name that looks like a number stays text.
    log.run([revenue_anomaly(orders)], "007")
    log.run([revenue_anomaly(orders.where("false"))], "007")
    assert log.read("007").first()["failing_rows"] == 0 and log.read().count() == 6
    report = {r["check_name"]: r["failure_count"] for r in marts.quality_report(log.read()).collect()}
    assert report == {"orphan_orders": 1, "revenue_anomaly": 2, "future_orders": 1}


def test_scorecard(staging):
    orders, _ = staging
    good = quality_scorecard({"a": orders.where("amount < 0"), "b": orders.where("customer_id IS NULL")})
    assert not scorecard_alert(good) and scorecard_alert(quality_scorecard({"c": orders.where("amount > 100")}))


def test_contract_example(spark, tuples):
    orders = spark.createDataFrame([("O001", "2024-10-01", 100.50), ("O002", "2024-10-01", 250.75), ("O003", "2024-10-02", 50.25)],
                                   "order_id string, order_date string, amount double")
    contract = con.daily_revenue_contract()
    assert tuples(contract.run(marts.contract_daily_revenue, orders)) == [("2024-10-01", 351.25, 2), ("2024-10-02", 50.25, 1)]
    with pytest.raises(con.ContractError, match="pre-condition 0"):
        contract.run(marts.contract_daily_revenue, orders.where("false"))
    with pytest.raises(con.ContractError, match="pre-condition 1"):
        contract.run(marts.contract_daily_revenue, orders.withColumn("order_id", F.lit(None).cast("string")))
    with pytest.raises(con.ContractError, match="post-condition 2"):
        contract.run(marts.contract_daily_revenue, orders.withColumn("amount", -F.col("amount")))
    with pytest.raises(con.ContractError, match="post-condition 3"):
        contract.run(lambda df: marts.contract_daily_revenue(df.where("amount < 200")), orders)


def test_policy(spark):
    df = spark.range(5)
    _, issues = con.apply_policy(df, {"rows": (con.has_rows(), con.CRITICAL), "big": (F.max("id") > 100, con.WARNING),
                                      "note": (F.min("id") > 0, con.INFO)})
    assert issues == {"critical": [], "warning": ["big"], "info": ["note"]}
    with pytest.raises(ValueError, match="big"):
        con.apply_policy(df, {"big": (F.max("id") > 100, con.CRITICAL)})
    with pytest.raises(ValueError, match="absent"):
        con.apply_policy(df, {"absent": (F.max("nope") > 1, con.WARNING), "rows": (con.has_rows(), con.CRITICAL)})


def test_row_loss_and_dataset_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    assert not con.no_row_loss(df, df.where("id = 1")).first()["passed"] and con.no_row_loss(df, df).first()["passed"]
    result = con.dataset_checks(df, "t", ["id", "s", "gone"])
    assert {r["check"]: r["passed"] for r in result.collect()} == {
        "file_exists": True, "row_count": True, "no_nulls(id)": True, "no_nulls(s)": False, "no_nulls(gone)": False}
    assert tuple(con.checks_passed(result).first()) == (3, 5)
    assert not con.dataset_checks(None, "t", spark=spark).first()["passed"]


def test_run_metrics_are_observed_once(spark, folder):
    seen, before = metrics.observed(spark.range(10), "before")
    kept, after = metrics.observed(seen.where("id < 8"), "after", top=F.max("id"))
    kept.write.parquet(f"{folder}/x")
    assert metrics.run_metrics(before, after) == {"rows_in": 10, "rows_out": 8, "removed": 2, "pass_rate": 80.0, "top": 7}


def test_total_mismatch(spark):
    df = spark.createDataFrame([(1, 8.0, [(2.5, 2), (1.0, 3)]), (2, 8.02, [(2.5, 2), (1.0, 3)])],
                               "order_id int, total double, line_items array<struct<price:double,quantity:int>>")
    assert [r["order_id"] for r in metrics.total_mismatch(df).collect()] == [2]
