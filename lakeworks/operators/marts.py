"""Aggregate reports. Column names are parameters; money is summed in whole millionths.

Distinct counts are exact. With one distinct column Spark first groups by
(keys, value), so a hot group is spread over all tasks before it is counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (as_col, millionths, date_range, day_of, money_avg, money_sum,
                         month_of, ratio, round2, round_to, trailing_days, trailing_months, trip_efficiency,
                         week_of, weekday_name, weekday_number)
from ..session import cut_lineage

def rows() -> Column:
    return F.count("*")


# --- orders ----------------------------------------------------------------

def monthly_status_rollup(df: DataFrame, ts: str, status: str, amount: str, since: str) -> DataFrame:
    return (df.where(F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
            .groupBy(month_of(ts).alias("month"), F.col(status).alias("status"))
            .agg(rows().alias("orders"), money_sum(amount).alias("revenue"), money_avg(amount).alias("avg_order"))
            .orderBy("month", "status"))


def global_summary(df: DataFrame, amount: str) -> DataFrame:
    return df.agg(rows().alias("orders"), money_sum(amount).alias("revenue"), money_avg(amount).alias("avg_order"),
                  F.min(amount).alias("min_order"), F.max(amount).alias("max_order"))


def daily_revenue(df: DataFrame, ts: str, customer: str, amount: str) -> DataFrame:
    return (df.groupBy(day_of(ts).alias("date"))
            .agg(rows().alias("order_count"), F.count_distinct(customer).alias("unique_customers"),
                 money_sum(amount).alias("total_revenue"), money_avg(amount).alias("avg_order_value"),
                 F.max(amount).alias("max_order_value"))
            .orderBy(F.desc("date")))


def monthly_customer_value(df: DataFrame, ts: str, customer: str, amount: str, months: int = 12,
                           as_of=None) -> DataFrame:
    grouped = (df.where(trailing_months(ts, months, as_of)).groupBy(month_of(ts).alias("month"))
               .agg(money_sum(amount).alias("revenue"), F.count_distinct(customer).alias("customers")))
    return (grouped.withColumn("avg_customer_value", ratio(F.col("revenue"), F.col("customers")))
            .orderBy("month"))


def recent_kpis(df: DataFrame, ts: str, amount: str, days: int = 30, as_of=None) -> DataFrame:
    return df.where(trailing_days(ts, days, as_of)).agg(
        money_sum(amount).alias("total_revenue"), rows().alias("total_orders"),
        money_avg(amount).alias("avg_order_value"))


def materialised_daily(df: DataFrame, ts: str, customer: str, amount: str) -> DataFrame:
    return (df.groupBy(day_of(ts).alias("date"))
            .agg(money_sum(amount).alias("revenue"), rows().alias("orders"),
                 F.count_distinct(customer).alias("active_customers")))


def status_summary(df: DataFrame, status: str, amount: str, above: float | None = None) -> DataFrame:
    kept = df if above is None else df.where(F.col(amount) > above)
    return (kept.groupBy(F.col(status).alias("status"))
            .agg(rows().alias("order_count"), money_sum(amount).alias("total_revenue"),
                 money_avg(amount).alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), "status"))


def country_summary(df: DataFrame, country: str = "country_clean", revenue: str = "revenue") -> DataFrame:
    return (df.groupBy(F.col(country).alias("country_clean"))
            .agg(rows().alias("customer_count"), money_sum(revenue).alias("total_revenue"),
                 round2(money_avg(revenue)).alias("avg_revenue"))
            .orderBy(F.desc("total_revenue"), "country_clean"))


def product_revenue_in_region(df: DataFrame, region: str, value: str, product: str, revenue: str) -> DataFrame:
    return (df.where(F.col(region) == value).groupBy(F.col(product).alias("product_id"))
            .agg(money_sum(revenue).alias("revenue")).orderBy(F.desc("revenue"), "product_id"))


def daily_order_stats(df: DataFrame, ts: str, amount: str, days: int = 10, newest: bool = False) -> DataFrame:
    """The first (or, with ``newest``, the last) ``days`` days that have orders."""
    day = F.desc("order_day") if newest else F.asc("order_day")
    return (df.groupBy(day_of(ts).alias("order_day"))
            .agg(rows().alias("orders"), money_sum(amount).alias("revenue"), money_avg(amount).alias("avg_order"))
            .orderBy(day).limit(days))


def month_total(df: DataFrame, amount: str, where: Column) -> DataFrame:
    """Row count and total of one month. ``where`` is a partition filter or a ``month_range``."""
    return df.where(where).agg(rows().alias("orders"), round2(money_sum(amount)).alias("revenue"))


def contract_daily_revenue(df: DataFrame, ts: str = "order_date", amount: str = "amount",
                           order: str = "order_id") -> DataFrame:
    return df.groupBy(F.col(ts).alias("order_date")).agg(
        money_sum(amount).alias("revenue"), F.count(order).alias("order_count"))


def order_totals(df: DataFrame, customer: str, amount: str, top: int = 10) -> DataFrame:
    return (df.groupBy(F.col(customer).alias("customer_id"))
            .agg(money_sum(amount).alias("total_spent"), rows().alias("order_count"))
            .orderBy(F.desc("total_spent"), "customer_id").limit(top))


# --- order items and products ----------------------------------------------

def top_products(items: DataFrame, products: DataFrame, on: tuple[str, str], name: str, quantity: str,
                 amount: str, ts: str, days: int = 30, as_of=None, top: int = 10) -> DataFrame:
    """Items are summed per product key before the join, so a best seller travels as one row per task."""
    item_key, product_key = on
    sold = (items.where(trailing_days(ts, days, as_of)).groupBy(F.col(item_key).alias("_key"))
            .agg(F.sum(quantity).alias("units"), F.sum(millionths(amount)).alias("amount_parts")))
    named = products.select(F.col(product_key).alias("_key"), F.col(name).alias("product_name"))
    return (sold.join(named, "_key").groupBy("product_name")
            .agg(F.sum("units").alias("units_sold"),
                 (F.sum("amount_parts").cast("double") / 1_000_000.0).alias("revenue"))
            .orderBy(F.desc("revenue"), "product_name").limit(top))


def items_with_products(items: DataFrame, products: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Inner join on a shared key name, as USING does: the key appears once."""
    item_key, product_key = on
    return items.withColumnRenamed(item_key, "product_id").join(
        products.withColumnRenamed(product_key, "product_id"), "product_id")


CATEGORY_WEEKLY = """
WITH sold AS (
  SELECT {key} AS k, trunc(CAST({ts} AS DATE), 'week') AS week,
         sum(CAST(rint({amount} * 100) AS BIGINT)) AS amount_parts
  FROM {items}
  WHERE {ts} >= CAST(date_sub(CAST(:as_of AS DATE), :days) AS TIMESTAMP_NTZ)
  GROUP BY 1, 2
)
SELECT CAST(week AS TIMESTAMP_NTZ) AS week, CAST(sum(amount_parts) AS DOUBLE) / 100.0 AS revenue
FROM sold JOIN {products} p ON sold.k = p.{product_key}
WHERE p.{category} = :category
GROUP BY sold.week
ORDER BY week
"""


def category_weekly(items: DataFrame, products: DataFrame, category: str, on: tuple[str, str],
                    category_column: str, amount: str, ts: str, as_of: str, days: int = 90) -> DataFrame:
    """Weekly revenue of one category. The user's value is a named parameter, never spliced into SQL."""
    text = CATEGORY_WEEKLY.replace("{items}", "{items_df}").replace("{products}", "{products_df}")
    for name, value in {"key": on[0], "product_key": on[1], "category": category_column,
                        "amount": amount, "ts": ts}.items():
        text = text.replace("{" + name + "}", f"`{value}`")
    return items.sparkSession.sql(text, args={"category": category, "as_of": as_of, "days": days},
                                  items_df=items, products_df=products)


# --- events ----------------------------------------------------------------

def daily_active(df: DataFrame, ts: str, user: str, approximate: bool = False) -> DataFrame:
    """Distinct users and events per day; ``approximate`` trades exactness for a fixed-size sketch."""
    users = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return df.groupBy(day_of(ts).alias("date")).agg(users.alias("dau"), rows().alias("events"))


def daily_user_sketches(df: DataFrame, ts: str, user: str, lg_size: int = 14) -> DataFrame:
    """Events and a sketch of the users per day, to be stored: weeks and months come from it without the raw rows.

    A sketch has at most ``2 ** lg_size`` cells whatever the day holds, and its relative error is about ``1.04 / sqrt(2 ** lg_size)``.
    """
    return df.groupBy(day_of(ts).alias("date")).agg(F.hll_sketch_agg(user, F.lit(lg_size)).alias("users"), rows().alias("events"))


def active_users(days: DataFrame, period: str) -> DataFrame:
    """Users and events per week, month or any period of ``date_trunc``, from stored days; tables of days may be united first."""
    return (days.groupBy(F.date_trunc(period, "date").cast("timestamp_ntz").alias(period))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"), F.sum("events").alias("events")))


def daily_event_metrics(df: DataFrame, ts: str = "event_ts", kind: str = "event_type", user: str = "user_id",
                        amount: str = "amount") -> DataFrame:
    return (df.groupBy(day_of(ts).alias("date"), F.col(kind).alias("event_type"))
            .agg(rows().alias("event_count"), F.count_distinct(user).alias("unique_users"),
                 money_sum(amount).alias("total_amount")))


def daily_conditional(df: DataFrame, ts: str, user: str, kind: str, amount: str,
                      value: str = "purchase") -> DataFrame:
    hit = F.col(kind) == value
    return (df.groupBy(day_of(ts).alias("date"))
            .agg(F.count_distinct(user).alias("daily_active_users"), rows().alias("total_events"),
                 F.count_if(hit).alias("purchases"),
                 money_sum(F.when(hit, F.col(amount)).otherwise(0.0)).alias("revenue"))
            .orderBy(F.desc("date")))


def weekday_hour_demand(df: DataFrame, ts: str) -> DataFrame:
    return (df.groupBy(weekday_number(ts).alias("_n"), weekday_name(ts).alias("day_of_week"),
                       F.hour(ts).alias("hour"))
            .agg(rows().alias("trips")).orderBy("_n", "hour").drop("_n"))


def gap_stats(gaps: DataFrame, user: str = "user_id", gap: str = "session_gap_seconds") -> DataFrame:
    """Count and mean of the long gaps of each user."""
    return gaps.groupBy(user).agg(rows().alias("large_gap_count"), ratio(F.sum(gap), rows()).alias("avg_gap_seconds"))


# --- trips -----------------------------------------------------------------

def monthly_trip_stats(df: DataFrame, ts: str, distance: str, amount: str, start: str, end: str) -> DataFrame:
    return (df.where((F.col(distance) > 0) & date_range(ts, start, end))
            .groupBy(month_of(ts).alias("month"))
            .agg(rows().alias("trips"), round2(money_avg(distance)).alias("avg_distance"),
                 round2(money_avg(amount)).alias("avg_fare"))
            .orderBy("month"))


ZONE_ROWS = 250_000  # trips that a task of a zone summary ranks, but for a zone and period that has more


def zone_summary(df: DataFrame, period: Column, zone: str = "pickup_zone", amount: str = "clean_amount",
                 distance: str = "clean_distance", approximate: bool = False) -> DataFrame:
    """Trips, revenue, mean distance and median fare per period and zone.

    The median is exact. Trips are first counted per distinct amount, which combines
    on the map side; a running count over those amounts then finds the middle. A hot
    zone is thus bounded by the number of distinct amounts up to the outlier
    limit, not by its trips, and the sort spills. ``approximate`` uses a sketch.
    """
    keys = ["pickup_date", "pickup_zone"]
    keyed = df.select(period.alias("pickup_date"), F.col(zone).alias("pickup_zone"),
                      millionths(amount).alias("c"), millionths(distance).alias("d"))
    if approximate:
        grouped = keyed.groupBy(*keys).agg(
            rows().alias("n"), F.sum("c").alias("c"), F.sum("d").alias("d"), F.count("d").alias("nd"),
            (F.percentile_approx("c", 0.5, 10_000) / F.lit(1_000_000.0)).alias("m"))
    else:
        counts = (keyed.groupBy(*keys, "c").agg(rows().alias("n"), F.sum("d").alias("d"), F.count("d").alias("nd"))
                  .withColumn("v", F.when(F.col("c").isNull(), 0).otherwise(F.col("n"))))
        # As many tasks as keep the rows of one about the same; a count by size alone lets the planner merge too many.
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ZONE_ROWS))
        zone_rows = Window.partitionBy(*keys)
        placed = (counts.repartition(tasks, *keys).withColumn("upto", F.sum("v").over(zone_rows.orderBy("c").rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("all", F.sum("v").over(zone_rows)))

        def holds(rank: Column) -> Column:
            return (F.col("upto") - F.col("v") <= rank) & (rank < F.col("upto"))

        def amount_at(rank: str) -> Column:
            return F.max(F.when(holds(F.expr(rank)), F.col("c"))) / F.lit(1_000_000.0)

        # Between two middle amounts the value is interpolated in double, as percentile_cont does.
        lower, upper = amount_at("(`all` - 1) div 2"), amount_at("`all` div 2")
        grouped = placed.groupBy(*keys).agg(
            F.sum("n").alias("n"), F.sum(F.col("c") * F.col("n")).alias("c"), F.sum("d").alias("d"),
            F.sum("nd").alias("nd"),
            (lower * 0.5 + upper * 0.5).alias("m"))
    return grouped.select(
        *keys, F.col("n").alias("trip_count"), round2(F.col("c").cast("double") / 1_000_000.0).alias("total_revenue"),
        round2(F.try_divide(F.col("d").cast("double"), F.col("nd") * F.lit(1_000_000.0))).alias("avg_distance"),
        round2("m").alias("median_fare"))


def daily_zone_summary(trips: DataFrame, **options) -> DataFrame:
    return zone_summary(trips, F.col("pickup_date"), **options)


def monthly_zone_summary(trips: DataFrame, **options) -> DataFrame:
    return zone_summary(trips, month_of("pickup_date"), **options)


def zone_sketches(trips: DataFrame, zone: str = "pickup_zone", amount: str = "clean_amount", size: int = 400) -> DataFrame:
    """Trips and a quantile sketch of the fares per day and zone, to be stored: medians of longer periods start from it."""
    return (trips.select(F.col("pickup_date"), F.col(zone).alias("pickup_zone"), millionths(amount).alias("c"))
            .groupBy("pickup_date", "pickup_zone")
            .agg(rows().alias("trip_count"), F.count("c").alias("fares"), F.kll_sketch_agg_bigint("c", F.lit(size)).alias("sketch")))


def monthly_medians(sketches: DataFrame, trips: DataFrame, zone: str = "pickup_zone", amount: str = "clean_amount",
                    margin: float = 0.02) -> DataFrame:
    """The exact median fare per month and zone, from the daily sketches and the few trips about the middle.

    The merged sketch of a month gives two amounts that the median lies between but for rare misses. Of the trips, only the amounts
    between them are counted; those below add to one number. Zones where the count shows that the bracket missed the middle get
    one that is open on both sides, so the result is exact whatever the sketch says.
    """
    keys = ["pickup_date", "pickup_zone"]
    merged = (sketches.groupBy(month_of("pickup_date").alias("pickup_date"), "pickup_zone")
              .agg(F.sum("trip_count").alias("trip_count"), F.sum("fares").alias("fares"), F.kll_merge_agg_bigint("sketch").alias("s")))

    def at(rank: float) -> Column:
        return F.when(F.col("fares") > 0, F.kll_sketch_get_quantile_bigint("s", F.lit(rank)))

    brackets = merged.select(*keys, "trip_count", "fares", at(0.5 - margin).alias("low"), at(0.5 + margin).alias("high"))
    fares = trips.select(month_of("pickup_date").alias("pickup_date"), F.col(zone).alias("pickup_zone"), millionths(amount).alias("c")).where("c IS NOT NULL")

    def middle(asked: DataFrame) -> DataFrame:
        """The asked zones with the median, NULL where the bracket missed it."""
        inside = fares.join(asked, keys).withColumn("c", F.when(F.col("c") < F.col("low"), None).otherwise(F.col("c"))).where("c IS NULL OR c <= high")
        counted = inside.groupBy(*keys, "fares", "c").agg(rows().alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("c")).rowsBetween(Window.unboundedPreceding, 0))
        placed = counted.withColumn("upto", upto)

        def amount_at(rank: str) -> Column:
            r = F.expr(rank)
            return F.max(F.when((F.col("upto") - F.col("n") <= r) & (r < F.col("upto")), F.col("c")))

        return placed.groupBy(*keys).agg(amount_at("(fares - 1) div 2").alias("lower"), amount_at("fares div 2").alias("upper"))

    first = cut_lineage(brackets.join(middle(brackets), keys, "left"), "medians")
    missed = first.where("fares > 0 AND (lower IS NULL OR upper IS NULL)").select(
        *keys, "fares", F.lit(-(1 << 63)).alias("low"), F.lit((1 << 63) - 1).alias("high"))
    again = middle(missed).select(*keys, F.col("lower").alias("l"), F.col("upper").alias("u"))
    found = first.join(again, keys, "left").withColumns({"lower": F.coalesce("l", "lower"), "upper": F.coalesce("u", "upper")})
    whole = F.lit(1_000_000.0)
    return found.select(*keys, "trip_count", round2(F.col("lower") / whole * 0.5 + F.col("upper") / whole * 0.5).alias("median_fare"))


def top_zones(summary: DataFrame, start: str, end: str, top: int = 10) -> DataFrame:
    """Busiest zones of a date range, from the summary table alone. Both ends are included."""
    low, high = (F.lit(d).cast("timestamp_ntz") for d in (start, end))
    return (summary.where(F.col("pickup_date").between(low, high)).groupBy("pickup_zone")
            .agg(F.sum("trip_count").alias("total_trips"), round2(money_sum("total_revenue")).alias("revenue"))
            .orderBy(F.desc("total_trips"), "pickup_zone").limit(top))


def daily_trip_revenue(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Per day of a closed date range. The filter is on the raw time, so it reaches the files."""
    low, high = (F.lit(d).cast("date") for d in (start, end))
    return (trips.where(F.col("pickup_time").cast("date").between(low, high))
            .groupBy("pickup_date").agg(rows().alias("trips"), round2(money_sum("clean_amount")).alias("revenue"))
            .orderBy("pickup_date"))


def hourly_speed(df: DataFrame, ts: str | Column, distance: str | Column, minutes: str | Column,
                 day: str | None = None) -> DataFrame:
    """Mean speed by hour of one day (or of all days)."""
    kept = df.where(as_col(distance).isNotNull())
    if day:
        kept = kept.where(as_col(ts).cast("date") == F.lit(day).cast("date"))
    speed = trip_efficiency(distance, minutes)
    # Summed as decimal: the mean does not depend on the order of the rows.
    exact = speed.cast("decimal(28,9)")
    return (kept.groupBy(F.hour(as_col(ts)).alias("hour"))
            .agg(round2(ratio(F.sum(exact), F.count(exact))).alias("avg_mph")).orderBy("hour"))


# --- profiles --------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "match_count") -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias(name)).where(F.col(name) > 1)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column and in all, from one pass."""
    columns = list(columns or df.columns)
    per_column = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return per_column.withColumn("total_nulls", total)


def distinct_keys(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    return df.select(F.col(key).alias(name)).distinct()


def quality_report(log: DataFrame) -> DataFrame:
    return (log.where("failing_rows > 0").groupBy("check_name", "check_type")
            .agg(rows().alias("failure_count"), F.max("run_at").alias("last_failure")))


def recon_status_totals(report: DataFrame, amount: str = "amount") -> DataFrame:
    return report.groupBy("status").agg(rows().alias("n"), money_sum(amount).alias("total"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str) -> DataFrame:
    """Last update, rows and age in hours per table. Each table is reduced to one row before the union."""
    now = F.lit(as_of).cast("timestamp_ntz")
    out = None
    for name, (df, ts) in tables.items():
        row = (df.agg(F.max(ts).cast("timestamp_ntz").alias("last_update"), rows().alias("row_count"))
               .where("row_count > 0").select(F.lit(name).alias("table_name"), "*"))
        out = row if out is None else out.unionByName(row)
    micros = F.timestamp_diff("MICROSECOND", F.col("last_update"), now)
    return out.withColumn("hours_since_update", round_to(micros.cast("double") / 3_600_000_000.0, 1))


def category_weekly_frame(items: DataFrame, products: DataFrame, category: str, on: tuple[str, str],
                          category_column: str, amount: str, ts: str, as_of=None, days: int = 90) -> DataFrame:
    """The DataFrame form of ``category_weekly``."""
    sold = (items.where(trailing_days(ts, days, as_of)).groupBy(F.col(on[0]).alias("_key"), week_of(ts).alias("week"))
            .agg(F.sum(millionths(amount)).alias("amount_parts")))
    chosen = products.where(F.col(category_column) == category).select(F.col(on[1]).alias("_key"))
    return (sold.join(chosen, "_key").groupBy("week")
            .agg((F.sum("amount_parts").cast("double") / 1_000_000.0).alias("revenue")).orderBy("week"))


