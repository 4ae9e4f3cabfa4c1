"""Joins. Only literal code tables are broadcast by hint; the rest is left to Spark's check of bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money_avg, money_sum, round2
from ..sources.readers import inline_dim

# The two code tables of the trip data.
RATE_CODES = [(1, "Standard rate"), (2, "JFK"), (3, "Newark"), (4, "Nassau or Westchester"),
              (5, "Negotiated fare"), (6, "Group ride")]
PAYMENT_TYPES = [(1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"),
                 (5, "Unknown"), (6, "Voided trip")]

def rate_codes(spark: SparkSession) -> DataFrame:
    return inline_dim(spark, RATE_CODES, "rate_code_id int, description string")


def payment_types(spark: SparkSession) -> DataFrame:
    return inline_dim(spark, PAYMENT_TYPES, "payment_type_id int, description string")


def star_join(trips: DataFrame, codes: Sequence[int] | None = None, rate: str | Column = "rate_code",
              payment: str | Column = "payment_type", amount: str = "fare_amount") -> DataFrame:
    """Trips by rate type and payment method.

    The fact is grouped by the two codes first, so only one row per code pair
    meets the dimensions, which are literals of six rows and safe to broadcast.
    """
    spark = trips.sparkSession
    rates, payments = rate_codes(spark), payment_types(spark)
    keyed = trips.select(F.col(rate).alias("rate_code_id") if isinstance(rate, str) else rate.alias("rate_code_id"),
                         F.col(payment).alias("payment_type_id") if isinstance(payment, str)
                         else payment.alias("payment_type_id"), F.col(amount).alias("amount"))
    known = keyed.where(F.col("rate_code_id").isin(*(codes or [c for c, _ in RATE_CODES])))
    grouped = known.groupBy("rate_code_id", "payment_type_id").agg(
        F.count("*").alias("trips"), money_avg("amount").alias("avg_fare"),
        money_sum("amount").alias("total_revenue"))
    return (grouped.join(F.broadcast(rates.withColumnRenamed("description", "rate_type")), "rate_code_id")
            .join(F.broadcast(payments.withColumnRenamed("description", "payment_method")), "payment_type_id")
            .select("rate_type", "payment_method", "trips", round2("avg_fare").alias("avg_fare"),
                    round2("total_revenue").alias("total_revenue"))
            .orderBy(F.desc("trips"), "rate_type", "payment_method"))


def enrich(left: DataFrame, right: DataFrame, on: str | Sequence[str], columns: Sequence[str] | None = None,
           how: str = "left", suffix: str = "_right") -> DataFrame:
    """Equi-join that keeps every left column; clashing right columns get ``suffix``.

    ``columns`` projects the right side first. How the sides meet is Spark's choice:
    both shuffle on the key unless the right one turns out small in bytes, and AQE
    splits a key that is far larger than the rest.
    """
    keys = [on] if isinstance(on, str) else list(on)
    wanted = right.select(*keys, *columns) if columns else right
    clash = {c: c + suffix for c in wanted.columns if c in left.columns and c not in keys}
    return left.join(wanted.withColumnsRenamed(clash), keys, how)


def anti_join(df: DataFrame, other: DataFrame, on: str, other_on: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other`` (NOT EXISTS).

    The other side is reduced to distinct keys before the shuffle, so a key that
    fills a third of it travels once per task.
    """
    keys = other.select(F.col(other_on or on).alias("_key")).distinct()
    return df.join(keys, F.col(on) == F.col("_key"), "left_anti")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return anti_join(df, parent, key, parent_key)
