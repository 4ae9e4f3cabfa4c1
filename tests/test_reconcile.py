import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from lakeworks.operators import reconcile as rec
from lakeworks.plans.pipelines import reconcile as reconcile_run

BANK = "bank_id string, amount double, timestamp timestamp_ntz, description string"
LEDGER = "ledger_id string, amount double, timestamp timestamp_ntz, reference string"


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def example(spark):
    bank = spark.createDataFrame([
        ("B001", 1500.00, at("2024-10-01 09:15:30"), "Invoice #1234"),
        ("B002", 2300.50, at("2024-10-01 14:22:10"), "Payment XYZ"),
        ("B003", 890.25, at("2024-10-02 11:05:45"), "Refund"),
        ("B004", 1500.00, at("2024-10-02 16:30:20"), "Invoice #1234")], BANK)
    ledger = spark.createDataFrame([
        ("L001", 1500.00, at("2024-10-01 09:16:00"), "INV-1234"),
        ("L002", 2300.50, at("2024-10-01 14:22:15"), "PAY-XYZ"),
        ("L003", 995.00, at("2024-10-02 10:58:30"), "SAL-995")], LEDGER)
    return rec.prepare(bank), rec.prepare(ledger)


@pytest.mark.parametrize("strict", [False, True])
def test_worked_example_matches(example, tuples, strict):
    matches = rec.match_transactions(*example, strict=strict)
    assert tuples(matches, "bank_id", "ledger_id", "amount", "time_diff_seconds") == [
        ("B001", "L001", 1500.0, -30), ("B002", "L002", 2300.5, -5)]


def test_worked_example_unmatched(example, tuples):
    bank, ledger = example
    matches = rec.match_transactions(bank, ledger)
    by_id = rec.find_unmatched(bank, matches, "bank_id", "UNMATCHED_BANK")
    assert tuples(by_id, "bank_id", "status") == [("B003", "UNMATCHED_BANK"), ("B004", "UNMATCHED_BANK")]
    assert by_id.columns == ["bank_id", "amount", "timestamp", "description", "status"]
    assert tuples(rec.unmatched(bank, ledger, "UNMATCHED_BANK"), "bank_id") == [("B003",), ("B004",)]
    assert tuples(rec.unmatched(ledger, bank, "UNMATCHED_LEDGER"), "ledger_id", "status") == [
        ("L003", "UNMATCHED_LEDGER")]


def test_worked_example_report_and_rules(spark, example, folder):
    report, rules = reconcile_run(*(d.drop(*rec.MATCH_KEYS) for d in example), f"{folder}/report", f"{folder}/rules",
                                  run_timestamp="2024-10-03 00:00:00")
    matches = rec.match_transactions(*example)
    ordered = [r["bank_id"] or r["ledger_id"] for r in rec.recon_report(*example, matches).collect()]
    assert ordered == ["B001", "B002", "B003", "B004", "L003"]
    assert report.count() == 5
    got = {r["rule"]: (r["passed"], r["message"]) for r in rules.collect()}
    assert got == {"Matched totals equal": (True, "Bank: $3800.50 | Ledger: $3800.50"),
                   "No duplicate bank matches": (True, "OK"),
                   "Match rate >= 80%": (False, "50.0% (2/4)"),
                   "Time differences <= 5min": (True, "Max: 30s")}


def feeds(spark, seed, n=150):
    """Few amounts and little time, so that rows have many candidates; whole and broken seconds."""
    rng = random.Random(seed)
    start = at("2024-10-01 23:50:00")

    def side(prefix):
        return [(f"{prefix}{i}", rng.choice([10.0, 20.0, 10.004]),
                 start + dt.timedelta(seconds=rng.randint(0, 1200), microseconds=rng.choice([0, 250_000])), "x")
                for i in range(n)]

    return side("B"), side("L")


def brute_pairs(bank, ledger, tolerance):
    out = []
    for b in bank:
        for l in ledger:
            same = b[2].date() == l[2].date() and round(b[1] * 100) == round(l[1] * 100)
            secs = [t.hour * 3600 + t.minute * 60 + t.second for t in (b[2], l[2])]
            if same and abs(secs[0] - secs[1]) <= tolerance:
                out.append((b[0], l[0], int((b[2] - l[2]).total_seconds())))
    return sorted(out)


@pytest.mark.parametrize("seed,tolerance", [(1, 60), (2, 7), (3, 0)])
def test_matches_equal_brute_force(spark, tuples, seed, tolerance):
    b, l = feeds(spark, seed)
    bank, ledger = rec.rec.prepare(spark.createDataFrame(b, BANK)), rec.rec.prepare(spark.createDataFrame(l, LEDGER))
    want = brute_pairs(b, l, tolerance)
    got = rec.match_transactions(bank, ledger, tolerance)
    assert sorted(tuples(got, "bank_id", "ledger_id", "time_diff_seconds")) == want
    matched = {x[0] for x in want}
    assert {r[0] for r in tuples(rec.unmatched(bank, ledger, "U", tolerance), "bank_id")} == {
        x[0] for x in b} - matched
    # Counting pairs gives the same measures as forming them.
    assert rec.measure_feeds(bank, ledger, tolerance).collect() == rec.measure_matches(bank, ledger, got).collect()


def test_total_rule_sees_differences_below_a_cent(spark):
    b, l = feeds(spark, 4)
    bank, ledger = rec.rec.prepare(spark.createDataFrame(b, BANK)), rec.rec.prepare(spark.createDataFrame(l, LEDGER))
    row = rec.measure_feeds(bank, ledger).first()
    assert row["bank_total"] != row["ledger_total"] and row["duplicates"] > 0


def test_strict_is_one_to_one_and_crosses_midnight(spark, tuples):
    bank = rec.rec.prepare(spark.createDataFrame([("B1", 5.0, at("2024-10-01 23:59:50"), "x"),
                                              ("B2", 5.0, at("2024-10-01 23:59:40"), "x")], BANK))
    ledger = rec.rec.prepare(spark.createDataFrame([("L1", 5.0, at("2024-10-02 00:00:10"), "x")], LEDGER))
    assert rec.match_transactions(bank, ledger).count() == 0
    assert tuples(rec.match_transactions(bank, ledger, strict=True), "bank_id", "ledger_id") == [("B1", "L1")]


@pytest.mark.parametrize("seed", [5, 6])
def test_strict_equals_brute_force_mutual_best(spark, tuples, seed):
    b, l = feeds(spark, seed, 80)
    gap = {(x[0], y[0]): abs((x[2] - y[2]).total_seconds()) for x in b for y in l
           if round(x[1] * 100) == round(y[1] * 100) and abs((x[2] - y[2]).total_seconds()) <= 60}
    best_b = {x[0]: min((g, k[1]) for k, g in gap.items() if k[0] == x[0])[1] for x in b if any(k[0] == x[0] for k in gap)}
    best_l = {y[0]: min((g, k[0]) for k, g in gap.items() if k[1] == y[0])[1] for y in l if any(k[1] == y[0] for k in gap)}
    want = sorted((k, v) for k, v in best_b.items() if best_l[v] == k)
    bank, ledger = rec.rec.prepare(spark.createDataFrame(b, BANK)), rec.rec.prepare(spark.createDataFrame(l, LEDGER))
    assert tuples(rec.match_transactions(bank, ledger, strict=True), "bank_id", "ledger_id") == want


def test_no_transactions_at_all(spark, example):
    bank, ledger = (d.where("false") for d in example)
    rules = {r["rule"]: r["passed"] for r in rec.recon_rules(rec.measure_feeds(bank, ledger)).collect()}
    assert rules["Matched totals equal"] and not rules["Match rate >= 80%"]


def test_matched_and_unmatched_make_up_both_sides(example):
    bank, ledger = example
    report = rec.recon_report(bank, ledger, rec.match_transactions(bank, ledger))
    assert report.where("bank_id IS NOT NULL").count() == bank.count()
    assert report.where("ledger_id IS NOT NULL").count() == ledger.count()


def test_month_tree(spark, example, folder):
    assert rec.match_by_month(*example, f"{folder}/r").count() == 5
    report = rec.match_by_month(*example, f"{folder}/r")  # a second run replaces the month
    assert report.count() == 5
    assert {r["month"] for r in report.select("month").distinct().collect()} == {"2024-10"}
    assert report.where(F.col("status") == "MATCHED").count() == 2


def test_one_amount_filling_a_minute_needs_no_pairs(spark):
    """20,000 rows per side share amount and minute: 400 million pairs, counted but never formed."""
    n = 20_000
    second = F.timestamp_add("SECOND", (F.col("id") % 60).cast("int"), F.lit("2024-10-01 12:00:00").cast("timestamp_ntz"))
    same = spark.range(n).select(F.col("id").cast("string").alias("i"), F.lit(9.99).alias("amount"), second.alias("timestamp"))
    bank, ledger = (rec.prepare(same.withColumnRenamed("i", c)) for c in ("bank_id", "ledger_id"))
    row = rec.measure_feeds(bank, ledger).first()
    assert (row["pairs"], row["duplicates"], row["bank_rows"], row["max_seconds"]) == (n * n, n, n, 59)
    assert row["bank_total"] == row["ledger_total"] == pytest.approx(9.99 * n * n)
    assert rec.unmatched(bank, ledger, "UNMATCHED_BANK").count() == 0
    late = ledger.withColumn("time_seconds", F.col("time_seconds") + 3600)
    assert rec.unmatched(bank, late, "UNMATCHED_BANK").count() == n


def test_strict_matching_of_one_amount_in_one_minute(spark):
    """Many rows of one amount in one minute: the work is that of sorting, not of pairs."""
    def feed(name, shift):
        return spark.range(100_000).select(
            F.concat(F.lit(name[0]), "id").alias(name), F.lit(5.0).alias("amount"),
            F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, cast(id as decimal(18, 6)) * 0.0006 + {shift})")
            .alias("timestamp"))

    bank, ledger = (rec.prepare(feed(n, s)) for n, s in (("bank_id", 0), ("ledger_id", 0.0001)))
    matched = rec.match_transactions(bank, ledger, strict=True)
    assert matched.count() == 100_000
    assert matched.where("substr(bank_id, 2) != substr(ledger_id, 2)").count() == 0


def hot_feeds(spark, n):
    """n transactions a side, all of one amount in one minute, and a few elsewhere."""
    base = spark.range(n).select(F.col("id"), F.lit(9.99).alias("amount"))
    at = F.expr("timestamp_ntz'2024-03-01 12:00:00' + make_dt_interval(0, 0, 0, id % 60)")
    later = F.expr("timestamp_ntz'2024-03-01 12:00:00' + make_dt_interval(0, 0, 0, 30 + id % 90)")
    return (rec.prepare(base.select(F.concat(F.lit("B"), "id").alias("bank_id"), "amount", at.alias("timestamp"))),
            rec.prepare(base.select(F.concat(F.lit("L"), "id").alias("ledger_id"), "amount", later.alias("timestamp"))))


def test_runs_of_a_hot_minute_take_seconds(spark):
    bank, ledger = hot_feeds(spark, 200_000)
    start = time.monotonic()
    runs = rec.match_runs(bank, ledger)
    measured = rec.measure_runs(bank, runs).first()
    assert rec.run_report(bank, ledger, runs).groupBy("status").count().collect()
    assert time.monotonic() - start < 60
    # Seconds b of 0..59 and l of 30..119 match where l - b <= 60; counts per second are known.
    b_n = [sum(1 for _ in range(s, 200_000, 60)) for s in range(60)]
    l_n = [sum(1 for _ in range(s, 200_000, 90)) for s in range(90)]
    assert measured["pairs"] == sum(b * n for s, b in enumerate(b_n) for t, n in enumerate(l_n) if abs(30 + t - s) <= 60)
    assert measured["max_seconds"] == 60


def test_runs_say_what_the_pairs_say(spark):
    draw = random.Random(3)

    def feed(name, n):
        rows = [(f"{name}{i}", draw.choice([1.0, 1.004, 2.5, None]), None if draw.random() < 0.05 else
                 dt.datetime(2024, 3, draw.choice([1, 2]), draw.choice([0, 23]), draw.choice([0, 1, 58, 59]), draw.randrange(60), draw.randrange(10**6)))
                for i in range(n)]
        return rec.prepare(spark.createDataFrame(rows, f"{name}_id string, amount double, timestamp timestamp_ntz"))

    bank, ledger = feed("bank", 150), feed("ledger", 130)
    pairs, runs = rec.match_transactions(bank, ledger), rec.match_runs(bank, ledger)
    assert sorted(map(tuple, rec.expand_runs(runs, bank, ledger).collect())) == sorted(map(tuple, pairs.collect()))
    assert rec.measure_runs(bank, runs).first() == rec.measure_matches(bank, ledger, pairs).first()
    report = {(r["side"], r["id"]): r for r in rec.run_report(bank, ledger, runs).collect()}
    assert len(report) == 280
    for side in ("bank", "ledger"):
        counts = {r[0]: r[1] for r in pairs.groupBy(f"{side}_id").count().collect()}
        for (s, i), r in report.items():
            if s == side:
                assert r["partners"] == counts.get(i, 0) and r["status"] == ("MATCHED" if i in counts else f"UNMATCHED_{side.upper()}")


def test_a_rerun_removes_months_without_rows(spark, folder):
    rows = [("B1", 5.0, dt.datetime(2024, 1, 5, 1)), ("B2", 6.0, dt.datetime(2024, 2, 5, 1))]
    bank = rec.prepare(spark.createDataFrame(rows, "bank_id string, amount double, timestamp timestamp_ntz"))
    ledger = rec.prepare(spark.createDataFrame([("L1", 5.0, dt.datetime(2024, 1, 5, 1))], "ledger_id string, amount double, timestamp timestamp_ntz"))
    assert {r["month"] for r in rec.match_by_month(bank, ledger, f"{folder}/r").collect()} == {"2024-01", "2024-02"}
    found = rec.match_by_month(bank.where("bank_id = 'B1'"), ledger, f"{folder}/r").collect()
    assert [(r["month"], r["status"]) for r in found] == [("2024-01", "MATCHED")]
