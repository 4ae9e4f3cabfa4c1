"""Business rules and their log."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_date, day_of, money_sum
from ..operators.joins import orphans
from ..operators.windows import value_stats

# Rules whose failure stops a pipeline, and the rule texts the log shows.
CRITICAL_RULES = ["orphan_orders", "future_orders"]
ORPHAN_TEXT = "SELECT * FROM orders WHERE customer_id NOT IN (SELECT id FROM customers)"
ANOMALY_TEXT = "Daily revenue >3σ from mean"
FUTURE_TEXT = "SELECT * FROM orders WHERE order_date > CURRENT_DATE"

LOG = ("check_name string, check_type string, failing_rows bigint, check_query string, "
       "run_at timestamp_ntz, run_id string")


@dataclass(frozen=True)
class BusinessRule:
    """A rule is the DataFrame of the rows (or groups) that break it."""

    name: str
    kind: str
    failing: DataFrame
    text: str

    def row(self) -> DataFrame:
        return self.failing.agg(F.lit(self.name).alias("check_name"), F.lit(self.kind).alias("check_type"),
                                F.count("*").alias("failing_rows"), F.lit(self.text).alias("check_query"))


def orphan_orders(orders: DataFrame, customers: DataFrame, key: str = "customer_id",
                  parent_key: str = "id") -> BusinessRule:
    return BusinessRule("orphan_orders", "referential_integrity", orphans(orders, key, customers, parent_key),
                        ORPHAN_TEXT)


def anomalous_days(orders: DataFrame, ts: str = "order_date", amount: str = "amount",
                   sigmas: float = 3.0) -> DataFrame:
    """Days whose revenue is further than ``sigmas`` sample deviations from the daily mean."""
    daily = orders.groupBy(day_of(ts).alias("day")).agg(money_sum(amount).alias("revenue"))
    marked = daily.withColumn("_s", value_stats(daily, "revenue"))
    return (marked.where(F.abs(F.col("revenue") - F.col("_s.mean")) > sigmas * F.col("_s.std"))
            .drop("_s"))


def revenue_anomaly(orders: DataFrame, ts: str = "order_date", amount: str = "amount") -> BusinessRule:
    return BusinessRule("revenue_anomaly", "statistical_outlier", anomalous_days(orders, ts, amount),
                        ANOMALY_TEXT)


def future_orders(orders: DataFrame, ts: str = "order_date", as_of=None) -> BusinessRule:
    late = orders.where(F.col(ts) > as_of_date(as_of).cast("timestamp_ntz"))
    return BusinessRule("future_orders", "temporal_logic", late, FUTURE_TEXT)


def run_rules(rules: Iterable[BusinessRule]) -> DataFrame:
    """One row per rule: (check_name, check_type, failing_rows, check_query)."""
    out = None
    for rule in rules:
        out = rule.row() if out is None else out.unionByName(rule.row())
    return out


class RuleLog:
    """Log table. Every run is a partition of its own: it never sees another run's rows, and
    repeating it after a failure replaces only its own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def run(self, rules: Iterable[BusinessRule], run_id: str | None = None, run_at=None) -> DataFrame:
        run_id = run_id or uuid.uuid4().hex
        stamp = F.current_timestamp() if run_at is None else F.lit(run_at)
        rows = run_rules(rules).withColumns({"run_at": stamp.cast("timestamp_ntz"), "run_id": F.lit(run_id)})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").parquet(self.path))
        return self.read(run_id)

    def read(self, run_id: str | None = None) -> DataFrame:
        log = self.spark.read.schema(LOG).parquet(self.path)
        return log if run_id is None else log.where(F.col("run_id") == run_id)


def failures(log: DataFrame, limit: int | None = 10, critical: Sequence[str] = tuple(CRITICAL_RULES)) -> DataFrame:
    """Failing checks, newest first, marked critical or warning."""
    level = F.when(F.col("check_name").isin(*critical), "critical").otherwise("warning")
    failing = (log.where("failing_rows > 0").select("check_name", "failing_rows", "run_at", level.alias("level"))
               .orderBy(F.desc("run_at"), "check_name"))
    return failing if limit is None else failing.limit(limit)


def require_no_critical(log: DataFrame, critical: Sequence[str] = tuple(CRITICAL_RULES)) -> list[str]:
    """Raise if a critical rule failed; return the names of the other failing rules."""
    rows = failures(log, None, critical).collect()
    bad = [(r["check_name"], r["failing_rows"]) for r in rows if r["level"] == "critical"]
    if bad:
        raise ValueError(f"critical checks failed: {bad}")
    return [r["check_name"] for r in rows]


def quality_scorecard(checks: dict[str, DataFrame]) -> DataFrame:
    """{label: failing rows} as one table of (check_name, failures)."""
    out = None
    for name, failing in checks.items():
        row = failing.agg(F.lit(name).alias("check_name"), F.count("*").alias("failures"))
        out = row if out is None else out.unionByName(row)
    return out


def scorecard_alert(card: DataFrame) -> bool:
    return card.agg(F.sum("failures") > 0).first()[0]
