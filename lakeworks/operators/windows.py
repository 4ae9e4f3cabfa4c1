"""Window reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_col, millionths, elapsed_seconds, month_of, ratio, round2, round_to


def top_n_per_month(df: DataFrame, ts: str, zone: str, n: int = 5) -> DataFrame:
    """The ``n`` busiest zones of each month.

    The rank filter becomes a group limit on both sides of the shuffle: a task
    sends at most ``n`` zones per month, however many zones a month has.
    """
    counted = df.groupBy(month_of(ts).alias("month"), F.col(zone).alias("pickup_zone")).agg(
        F.count("*").alias("trips"))
    w = Window.partitionBy("month").orderBy(F.desc("trips"), "pickup_zone")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).orderBy("month", "rank")


def moving_average(df: DataFrame, ts: str, days: int = 7) -> DataFrame:
    """Daily row count and its mean over the last ``days`` days that have rows.

    The window runs on one row per calendar day, so its single task is bounded by
    the length of the calendar.
    """
    daily = df.groupBy(F.col(ts).cast("date").alias("d")).agg(F.count("*").alias("orders"))
    w = Window.orderBy("d").rowsBetween(1 - days, 0)
    return (daily.withColumn("rolling_avg_7d", F.avg("orders").over(w))
            .select(F.col("d").cast("timestamp_ntz").alias("order_date"), "orders", "rolling_avg_7d")
            .orderBy("order_date"))


def share_of_total(df: DataFrame, group: str, amount: str) -> DataFrame:
    """Each group's sum and its percentage of the whole.

    The whole is a scalar subquery over the same grouped rows, so both share one
    scan and one shuffle.
    """
    grouped = df.groupBy(F.col(group).alias("status")).agg(F.sum(millionths(amount)).alias("c"))
    whole = grouped.agg(F.sum("c")).scalar()
    share = grouped.select("status", (F.col("c").cast("double") / 1_000_000.0).alias("revenue"),
                           (F.lit(100.0) * ratio(F.col("c"), whole)).alias("_share"))
    return (share.select("status", "revenue", round2("_share").alias("pct"))
            .orderBy(F.desc("revenue"), "status"))


def previous_event(df: DataFrame, user: str, ts: str, tie: str, bucket_seconds: int = 3600,
                   name: str = "prev_event_time") -> DataFrame:
    """``lag(ts)`` per user without putting all events of a user into one task.

    Rows are shuffled once, by user and time bucket, and ``lag`` runs inside a bucket.
    The last time of a user's previous bucket comes from a small table with one row per
    user and bucket; it joins its bucket as a row of its own, which sorts first and is
    taken out again.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    bucketed = df.withColumn("_b", F.floor(micros / F.lit(bucket_seconds * 1_000_000)).cast("bigint"))
    ends = bucketed.where(F.col(ts).isNotNull()).groupBy(user, "_b").agg(F.max(ts).alias("_end"))
    carried = ends.select(user, "_b", F.lag("_end").over(Window.partitionBy(user).orderBy("_b")).alias(ts)).where(F.col(ts).isNotNull())
    rows = bucketed.withColumn("_own", F.lit(True)).unionByName(carried.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    inside = Window.partitionBy(user, "_b").orderBy(ts, tie)
    return rows.withColumn(name, F.lag(ts).over(inside)).where("_own").drop("_b", "_own")


def session_gaps(df: DataFrame, user: str = "user_id", ts: str = "event_time", tie: str = "session_id",
                 gap_seconds: int = 1800, bucket_seconds: int = 3600) -> DataFrame:
    """Events that follow the user's previous event by more than ``gap_seconds`` whole seconds."""
    lagged = previous_event(df, user, ts, tie, bucket_seconds)
    return (lagged.withColumn("session_gap_seconds", elapsed_seconds(ts, "prev_event_time"))
            .where(F.col("session_gap_seconds") > gap_seconds))


def value_stats(df: DataFrame, x: str | Column) -> Column:
    """(mean, std) of a column as one scalar-subquery struct."""
    x = as_col(x)
    return df.agg(F.struct(F.avg(x).alias("mean"), F.stddev(x).alias("std"))).scalar()


def zscore_outliers(df: DataFrame, key: str, amount: str, sigmas: float = 3.0) -> DataFrame:
    """Rows further than ``sigmas`` sample deviations from the mean.

    Mean and deviation enter as scalar subqueries, so rows stay where they are read.
    """
    x = F.col(amount)
    marked = df.select(F.col(key).alias("order_id"), x.alias("amount"), value_stats(df, x).alias("_s"))
    off = F.col("amount") - F.col("_s.mean")
    return (marked.where(F.abs(off) > sigmas * F.col("_s.std"))
            .select("order_id", "amount", round_to(F.try_divide(off, F.col("_s.std")), 6).alias("z_score")))
