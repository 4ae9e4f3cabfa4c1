"""Run metrics collected while the data is written: no second scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import money_sum, nested_total


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count and further aggregates; read ``.get`` after an action has run."""
    watch = Observation(name)
    return df.observe(watch, F.count("*").alias("rows"), *[c.alias(n) for n, c in measures.items()]), watch


def revenue_measure(total: str) -> Column:
    return money_sum(total)


def run_metrics(before: Observation, after: Observation) -> dict[str, float]:
    """Rows in and out, rows removed and pass rate in percent of one step."""
    rows_in, rows_out = before.get["rows"], after.get["rows"]
    extra = {k: v for k, v in after.get.items() if k != "rows"}
    return {"rows_in": rows_in, "rows_out": rows_out, "removed": rows_in - rows_out,
            "pass_rate": 100.0 * rows_out / rows_in if rows_in else 0.0, **extra}


def total_mismatch(orders: DataFrame, total: str = "total", items: str = "line_items",
                   tolerance: float = 0.01) -> DataFrame:
    """Orders whose total differs from their line items by more than the tolerance, or that lack either."""
    computed = orders.withColumn("calculated_total", nested_total(items))
    gap = F.abs(F.col(total) - F.col("calculated_total"))
    return computed.where(gap.isNull() | (gap > tolerance))
