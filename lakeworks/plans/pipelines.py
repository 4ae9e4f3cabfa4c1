"""End-to-end runs composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (clean_events, keep_latest, normalise_text_num, snapshot_inventory, stage_orders)
from ..operators.joins import enrich
from ..operators.marts import daily_event_metrics, daily_order_stats, daily_revenue
from ..operators.reconcile import match_transactions, measure_feeds, prepare, recon_report, recon_rules
from ..quality.contracts import Contract, keeps_rows
from ..quality.metrics import observed, revenue_measure, run_metrics, total_mismatch
from ..quality.rules import RuleLog, future_orders, orphan_orders, require_no_critical, revenue_anomaly
from ..quality.schema import CLEANED_EVENTS, CUSTOMERS, ORDERS, TableSchema
from ..session import cut_lineage
from ..sources.layout import write_by_date
from ..sources.readers import scan_csv, scan_partitioned
from ..sources.writers import write_parquet

ORDERS_CSV = "order_id string, customer_id bigint, order_date date, amount double, quantity int, status string"


def ingest_sales(spark: SparkSession, source: str, target: str, schema: str, amount: str = "amount",
                 above: float = 100) -> int:
    """CSV -> rows above an amount -> Parquet. The row count is observed while writing."""
    kept, watch = observed(scan_csv(spark, source, schema=schema).where(F.col(amount) > above), "ingest_sales")
    write_parquet(kept, target, mode="overwrite")
    return watch.get["rows"]


def raw_to_curated(raw: DataFrame, staging: str, curated: str) -> DataFrame:
    """Raw export -> typed staging -> partitioned fact table -> daily statistics."""
    staged, watch = observed(stage_orders(raw), "stage_orders")
    write_parquet(staged, staging, "snappy", mode="overwrite")
    if watch.get["rows"] == 0:
        raise ValueError("no rows left after filtering")
    spark = raw.sparkSession
    write_by_date(spark.read.parquet(staging), curated, "order_date")
    return daily_order_stats(scan_partitioned(spark, curated), "order_date", "revenue")


def quality_pipeline(spark: SparkSession, source: str, target: str, customers: DataFrame, log: RuleLog,
                     schema: TableSchema = ORDERS, as_of=None) -> DataFrame:
    """CSV -> schema check -> rule log -> clean -> row-loss contract -> Parquet."""
    raw = scan_csv(spark, source, schema=ORDERS_CSV, mode="PERMISSIVE")
    orders = schema.validate(raw, "order_id")
    run = log.run([orphan_orders(orders, customers), revenue_anomaly(orders), future_orders(orders, as_of=as_of)])
    require_no_critical(run)
    contract = Contract("clean_orders", pre=[], post=[keeps_rows(0.99)])
    clean = contract.run(normalise_text_num, orders)
    write_parquet(clean, target, mode="overwrite")
    return spark.read.parquet(target)


def clean_customer_table(customers: DataFrame) -> tuple[DataFrame, dict]:
    """Latest row per customer, checked; with rows in, out and removed."""
    seen, before = observed(customers, "customers_in")
    # Of rows with the same time the one whose values sort last stays, whatever the partitioning.
    marked = seen.withColumn("_values", F.to_json(F.struct(*customers.columns)))
    latest, after = observed(keep_latest(marked, "customer_id", "updated_at", "_values").drop("_values"), "customers_out")
    stored = cut_lineage(latest, "customers")
    CUSTOMERS.validate(stored, "customer_id")
    return stored, run_metrics(before, after)


def multi_source_run(customers: DataFrame, orders: DataFrame, inventory: DataFrame, target: str) -> dict:
    """Customers, orders and stock to staging tables, then daily revenue. Returns run metrics."""
    spark = customers.sparkSession
    clean, removed = clean_customer_table(customers)
    joined, watch = observed(enrich(orders, clean, "customer_id", ["name"]), "orders", revenue=revenue_measure("total"))
    write_parquet(joined, f"{target}/orders", mode="overwrite")
    stored = spark.read.parquet(f"{target}/orders")
    wrong = total_mismatch(stored).count()
    if wrong:
        raise ValueError(f"{wrong} orders with total mismatches")
    write_parquet(clean, f"{target}/customers", mode="overwrite")
    write_parquet(snapshot_inventory(inventory), f"{target}/inventory", mode="overwrite")
    write_parquet(daily_revenue(stored, "order_date", "customer_id", "total"), f"{target}/daily_revenue",
                  mode="overwrite")
    return {"customers": removed, "orders": watch.get}


def event_run(raw: DataFrame, target: str) -> DataFrame:
    """Raw events -> clean, validated staging -> daily metrics."""
    spark = raw.sparkSession
    write_parquet(clean_events(raw), f"{target}/staging", mode="overwrite")
    staged = spark.read.parquet(f"{target}/staging")
    # The raw text time is not part of the checked schema.
    CLEANED_EVENTS.validate(staged.drop("timestamp"), "user_id")
    write_parquet(daily_event_metrics(staged), f"{target}/daily_metrics", mode="overwrite")
    return spark.read.parquet(f"{target}/daily_metrics")


def reconcile(bank: DataFrame, ledger: DataFrame, report_path: str, rules_path: str, tolerance: int = 60,
              run_timestamp: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Match, report, check. Matches are stored once and read three times by the report."""
    spark = bank.sparkSession
    b, r = prepare(bank), prepare(ledger)
    matches = cut_lineage(match_transactions(b, r, tolerance), "matches")
    write_parquet(recon_report(b, r, matches), report_path, "snappy", mode="overwrite")
    write_parquet(recon_rules(measure_feeds(b, r, tolerance), run_timestamp=run_timestamp), rules_path, "snappy", mode="overwrite")
    return spark.read.parquet(report_path), spark.read.parquet(rules_path)
