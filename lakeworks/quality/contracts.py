"""Pre- and post-conditions around a transformation.

A condition is an aggregate expression that must be true, so all conditions of
one side are answered by a single pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money_sum
from ..session import cut_lineage

CRITICAL, WARNING, INFO = "critical", "warning", "info"


class ContractError(ValueError):
    pass


def has_rows() -> Column:
    return F.count("*") > 0


def no_nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull()) == 0


def none_below(column: str, low: float = 0) -> Column:
    return F.count_if(F.col(column) < low) == 0


def keeps_total(before: str, column: str, share: float = 0.99) -> Callable[[Mapping], Column]:
    """The result's total is at least ``share`` of the measure taken on the input."""
    return lambda measured: money_sum(column) >= F.lit(float(measured[before] or 0)) * share


def keeps_rows(share: float = 0.99) -> Callable[[Mapping], Column]:
    return lambda measured: F.count("*") >= F.lit(measured["rows"]) * share


@dataclass(frozen=True)
class Contract:
    name: str
    pre: Sequence[Column]
    post: Sequence[Column | Callable[[Mapping], Column]]
    measures: Mapping[str, Column] = field(default_factory=dict)

    def run(self, transform: Callable[[DataFrame], DataFrame], df: DataFrame) -> DataFrame:
        """Check, transform, check again. The result is stored before its check, so it is computed once."""
        row = df.agg(F.count("*").alias("rows"),
                     *[F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(self.pre)],
                     *[c.alias(n) for n, c in self.measures.items()]).first().asDict()
        self._require("pre", row, len(self.pre))
        result = cut_lineage(transform(df), "contract")
        post = [c(row) if callable(c) and not isinstance(c, Column) else c for c in self.post]
        checked = result.agg(F.count("*").alias("rows"), *[
            F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(post)]).first().asDict()
        self._require("post", checked, len(post))
        return result

    def _require(self, side: str, row: Mapping, n: int) -> None:
        for i in range(n):
            if not row[f"c{i}"]:
                raise ContractError(f"{self.name}: {side}-condition {i} failed")


def daily_revenue_contract() -> Contract:
    return Contract(
        "daily_revenue_aggregation",
        pre=[has_rows(), no_nulls("order_id")],
        post=[has_rows(), no_nulls("order_date"), none_below("revenue"), keeps_total("amount", "revenue")],
        measures={"amount": money_sum("amount")})


def apply_policy(df: DataFrame, checks: Mapping[str, tuple[Column, str]]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Run levelled checks in one pass. A critical failure raises; others are returned by level.

    If the pass itself fails, checks are tried one by one, and a crashing check
    counts as critical.
    """
    names = list(checks)
    try:
        row = df.agg(*[checks[n][0].alias(f"c{i}") for i, n in enumerate(names)]).first()
        passed = {n: bool(row[f"c{i}"]) for i, n in enumerate(names)}
        crashed: list[str] = []
    except Exception:  # noqa: BLE001 - find out which check it was
        passed, crashed = {}, []
        for n in names:
            try:
                passed[n] = bool(df.agg(checks[n][0]).first()[0])
            except Exception:  # noqa: BLE001
                crashed.append(n)
    issues: dict[str, list[str]] = {CRITICAL: list(crashed), WARNING: [], INFO: []}
    for n, ok in passed.items():
        if not ok:
            issues[checks[n][1]].append(n)
    if issues[CRITICAL]:
        raise ValueError(f"critical quality failures: {issues[CRITICAL]}")
    return df, issues


def no_row_loss(before: DataFrame, after: DataFrame, share: float = 0.99) -> DataFrame:
    """(rows_before, rows_after, passed)."""
    counts = before.agg(F.count("*").alias("rows_before"), after.agg(F.count("*")).scalar().alias("rows_after"))
    return counts.withColumn("passed", F.col("rows_after") >= F.col("rows_before") * share)


def dataset_checks(df: DataFrame | None, name: str, columns: Sequence[str] = (), min_rows: int = 1,
                   spark=None) -> DataFrame:
    """(check, passed, detail): the dataset exists, has rows, and has the columns without NULLs."""
    if df is None:
        return spark.createDataFrame([("file_exists", False, f"File not found: {name}")],
                                     "check string, passed boolean, detail string")
    present = [c for c in columns if c in df.columns]
    measured = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in present])

    def result(check: str, passed: Column, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), passed.alias("passed"), detail.alias("detail"))

    rows = [result("file_exists", F.lit(True), F.lit(f"File exists: {name}")),
            result("row_count", F.col("n") >= min_rows, F.format_string("%d rows, expected at least " + str(min_rows), "n"))]
    for c in columns:
        if c in present:
            nulls = F.col(f"nulls_{c}")
            rows.append(result(f"no_nulls({c})", nulls == 0, F.format_string("%d nulls", nulls)))
        else:
            rows.append(result(f"no_nulls({c})", F.lit(False), F.lit(f"missing column: {c}")))
    return measured.select(F.inline(F.array(*rows)))


def checks_passed(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"))
