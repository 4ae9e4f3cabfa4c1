"""Aggregates, windows and dashboard reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import minute_boundaries, month_range
from ..operators import marts, windows
from ..operators.clean import fill_defaults, null_outliers
from ..operators.joins import PAYMENT_TYPES, RATE_CODES, star_join
from ..quality.rules import (ANOMALY_TEXT, FUTURE_TEXT, ORPHAN_TEXT, future_orders, orphan_orders, revenue_anomaly,
                             run_rules)
from ..session import cut_lineage
from .registry import AS_OF, TRIPS_SQL, mavg, msum, query, table, trip_columns, trips, trunc

O_DAY, O_MONTH = trunc("day", "o_orderdate"), trunc("month", "o_orderdate")
P = "o_totalprice"


# --- orders ---

@query(f"""SELECT {O_MONTH} AS month, o_orderstatus AS status, COUNT(*) AS orders, {msum(P)} AS revenue,
           {mavg(P)} AS avg_order
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1, 2 ORDER BY 1, 2""")
def monthly_status_rollup(spark, sf):
    return marts.monthly_status_rollup(table(spark, sf, "orders"), "o_orderdate", "o_orderstatus", P, "1997-01-01")


@query(f"""SELECT COUNT(*) AS orders, {msum(P)} AS revenue, {mavg(P)} AS avg_order, MIN({P}) AS min_order,
           MAX({P}) AS max_order FROM orders""")
def global_summary(spark, sf):
    return marts.global_summary(table(spark, sf, "orders"), P)


@query(f"""SELECT {O_DAY} AS date, COUNT(*) AS order_count, COUNT(DISTINCT o_custkey) AS unique_customers,
           {msum(P)} AS total_revenue, {mavg(P)} AS avg_order_value, MAX({P}) AS max_order_value
           FROM orders GROUP BY 1 ORDER BY 1 DESC""")
def daily_revenue(spark, sf):
    return marts.daily_revenue(table(spark, sf, "orders"), "o_orderdate", "o_custkey", P)


@query(f"""SELECT {O_MONTH} AS month, {msum(P)} AS revenue, COUNT(DISTINCT o_custkey) AS customers,
           {msum(P)} / COUNT(DISTINCT o_custkey) AS avg_customer_value
           FROM orders WHERE o_orderdate >= DATE '{AS_OF}' - INTERVAL 12 MONTH GROUP BY 1 ORDER BY 1""")
def monthly_customer_value(spark, sf):
    return marts.monthly_customer_value(table(spark, sf, "orders"), "o_orderdate", "o_custkey", P, as_of=AS_OF)


@query(f"""SELECT {msum(P)} AS total_revenue, COUNT(*) AS total_orders, {mavg(P)} AS avg_order_value
           FROM orders WHERE o_orderdate >= DATE '{AS_OF}' - INTERVAL 30 DAY""")
def recent_kpis(spark, sf):
    return marts.recent_kpis(table(spark, sf, "orders"), "o_orderdate", P, as_of=AS_OF)


@query(f"""SELECT {O_DAY} AS date, {msum(P)} AS revenue, COUNT(*) AS orders,
           COUNT(DISTINCT o_custkey) AS active_customers FROM orders GROUP BY 1""")
def materialised_daily(spark, sf):
    return marts.materialised_daily(table(spark, sf, "orders"), "o_orderdate", "o_custkey", P)


STATUS_SQL = f"""SELECT o_orderstatus AS status, COUNT(*) AS order_count, {msum(P)} AS total_revenue,
                 {mavg(P)} AS avg_order_value FROM orders {{}} GROUP BY 1 ORDER BY 3 DESC"""


@query(STATUS_SQL.format(""))
def status_summary(spark, sf):
    return marts.status_summary(table(spark, sf, "orders"), "o_orderstatus", P)


@query(STATUS_SQL.format(f"WHERE {P} > 100"))
def status_summary_above(spark, sf):
    return marts.status_summary(table(spark, sf, "orders"), "o_orderstatus", P, above=100)


@query(f"""SELECT {O_DAY} AS order_day, COUNT(*) AS orders, {msum(P)} AS revenue, {mavg(P)} AS avg_order
           FROM orders GROUP BY 1 ORDER BY 1 LIMIT 10""")
def daily_order_stats(spark, sf):
    return marts.daily_order_stats(table(spark, sf, "orders"), "o_orderdate", P)


@query(f"""SELECT {O_DAY} AS order_day, COUNT(*) AS orders, {msum(P)} AS revenue, {mavg(P)} AS avg_order
           FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def recent_order_stats(spark, sf):
    return marts.daily_order_stats(table(spark, sf, "orders"), "o_orderdate", P, newest=True)


@query(f"""SELECT COUNT(*) AS orders, ROUND({msum(P)}, 2) AS revenue FROM orders
           WHERE DATE_TRUNC('month', o_orderdate) = TIMESTAMP '1998-01-01'""")
def month_total(spark, sf):
    return marts.month_total(table(spark, sf, "orders"), P, month_range("o_orderdate", "1998-01"))


@query(f"""SELECT o_orderdate AS order_date, {msum(P)} AS revenue, COUNT(o_orderkey) AS order_count
           FROM orders GROUP BY 1""")
def contract_daily_revenue(spark, sf):
    return marts.contract_daily_revenue(table(spark, sf, "orders"), "o_orderdate", P, "o_orderkey")


@query(f"""SELECT o_custkey AS customer_id, {msum(P)} AS total_spent, COUNT(*) AS order_count
           FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def order_totals(spark, sf):
    return marts.order_totals(table(spark, sf, "orders"), "o_custkey", P)


@query(f"""SELECT {O_DAY} AS order_date, COUNT(*) AS orders,
           AVG(COUNT(*)) OVER (ORDER BY {O_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_7d
           FROM orders GROUP BY 1 ORDER BY 1""")
def moving_avg_7(spark, sf):
    return windows.moving_average(table(spark, sf, "orders"), "o_orderdate")


@query(f"""SELECT o_orderstatus AS status, {msum(P)} AS revenue,
           ROUND(100.0 * {msum(P)} / (SELECT {msum(P)} FROM orders), 2) AS pct
           FROM orders GROUP BY 1 ORDER BY 2 DESC""")
def share_of_total(spark, sf):
    return windows.share_of_total(table(spark, sf, "orders"), "o_orderstatus", P)


@query(f"""WITH s AS (SELECT AVG({P}) AS mean, STDDEV({P}) AS std FROM orders)
           SELECT o_orderkey AS order_id, {P} AS amount, ROUND(({P} - mean) / std, 6) AS z_score
           FROM orders, s WHERE ABS({P} - mean) > 1.5 * std""")
def zscore_outliers(spark, sf):
    # No order lies beyond 3 deviations in these tables; 1.5 gives rows to compare.
    return windows.zscore_outliers(table(spark, sf, "orders"), "o_orderkey", P, sigmas=1.5)


@query(f"""SELECT o_custkey AS product_id, {msum(P)} AS revenue FROM orders
           WHERE o_orderpriority = '2-HIGH' GROUP BY 1 ORDER BY 2 DESC""")
def product_revenue_in_region(spark, sf):
    return marts.product_revenue_in_region(table(spark, sf, "orders"), "o_orderpriority", "2-HIGH", "o_custkey", P)


@query("""SELECT o_custkey, o_orderstatus, COUNT(*) AS match_count FROM orders
          GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_keys(spark, sf):
    return marts.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query("SELECT DISTINCT o_custkey AS id FROM orders")
def distinct_keys(spark, sf):
    return marts.distinct_keys(table(spark, sf, "orders"), "o_custkey")


# --- customers ---

@query(f"""WITH c AS (
             SELECT COALESCE(NULLIF(c_mktsegment, 'FURNITURE'), 'UNKNOWN') AS country_clean,
                    COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS revenue FROM customer)
           SELECT country_clean, COUNT(*) AS customer_count, {msum("revenue")} AS total_revenue,
                  ROUND({mavg("revenue")}, 2) AS avg_revenue
           FROM c GROUP BY 1 ORDER BY 3 DESC""")
def country_summary(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("country"), F.col("c_acctbal").alias("balance"))
    bounded = null_outliers(raw, {"revenue": ("balance", 0, None)})
    return marts.country_summary(fill_defaults(bounded, {"revenue": 0.0, "country": "UNKNOWN"},
                                               {"country": "country_clean"}))


# --- order items as trips ---

@query(f"""SELECT {trunc("month", "l_shipdate")} AS month, COUNT(*) AS trips,
           ROUND({mavg("l_quantity")}, 2) AS avg_distance, ROUND({mavg("l_extendedprice")}, 2) AS avg_fare
           FROM lineitem WHERE l_quantity > 0 AND l_shipdate >= TIMESTAMP '1997-01-01'
             AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1 ORDER BY 1""")
def monthly_trip_stats(spark, sf):
    return marts.monthly_trip_stats(table(spark, sf, "lineitem"), "l_shipdate", "l_quantity", "l_extendedprice",
                                    "1997-01-01", "1998-01-01")


ZONE_SQL = f"""SELECT {{period}} AS pickup_date, pickup_zone, COUNT(*) AS trip_count,
               ROUND({msum("clean_amount")}, 2) AS total_revenue,
               ROUND(CAST(SUM(CAST(clean_distance * 100 AS BIGINT)) AS DOUBLE) / (NULLIF(COUNT(clean_distance), 0) * 100.0), 2) AS avg_distance,
               ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY clean_amount), 2) AS median_fare
               FROM ({TRIPS_SQL}) t GROUP BY 1, 2"""
MONTHLY_ZONES = ZONE_SQL.format(period=trunc("month", "pickup_date"))


@query(MONTHLY_ZONES)
def monthly_zone_summary(spark, sf):
    return marts.monthly_zone_summary(trips(spark, sf))


@query(ZONE_SQL.format(period="pickup_date"))
def daily_zone_summary(spark, sf):
    return marts.daily_zone_summary(trips(spark, sf))


@query(f"SELECT pickup_date, pickup_zone, trip_count, median_fare FROM ({MONTHLY_ZONES}) z")
def monthly_medians(spark, sf):
    """Exact medians of months from the stored sketches of days."""
    sketches = cut_lineage(marts.zone_sketches(trips(spark, sf)), "zone_sketches")
    return marts.monthly_medians(sketches, trips(spark, sf))


@query(f"""SELECT pickup_zone, CAST(SUM(trip_count) AS BIGINT) AS total_trips,
           ROUND({msum("total_revenue")}, 2) AS revenue
           FROM ({MONTHLY_ZONES}) z WHERE pickup_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_zones(spark, sf):
    return marts.top_zones(marts.monthly_zone_summary(trips(spark, sf)), "1998-01-01", "1998-12-31")


@query(f"""SELECT CAST(pickup_date AS TIMESTAMP) AS pickup_date, COUNT(*) AS trips,
           ROUND({msum("clean_amount")}, 2) AS revenue FROM ({TRIPS_SQL}) t
           WHERE pickup_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-07' GROUP BY 1 ORDER BY 1""")
def daily_trip_revenue(spark, sf):
    return marts.daily_trip_revenue(trips(spark, sf), "1998-01-01", "1998-01-07")


@query(f"""WITH z AS (
             SELECT {trunc("month", "pickup_date")} AS month, pickup_zone, COUNT(*) AS trips,
                    ROW_NUMBER() OVER (PARTITION BY {trunc("month", "pickup_date")}
                                       ORDER BY COUNT(*) DESC, pickup_zone) AS rank
             FROM ({TRIPS_SQL}) t GROUP BY 1, 2)
           SELECT month, pickup_zone, trips, CAST(rank AS INTEGER) AS rank FROM z WHERE rank <= 5 ORDER BY 1, 4""")
def top_n_per_month(spark, sf):
    return windows.top_n_per_month(trips(spark, sf), "pickup_date", "pickup_zone")


def _codes(rows: list[tuple]) -> str:
    return ", ".join(f"({i}, '{text}')" for i, text in rows)


STAR_SQL = f"""WITH r(id, d) AS (VALUES {_codes(RATE_CODES)}), p(id, d) AS (VALUES {_codes(PAYMENT_TYPES)})
               SELECT r.d AS rate_type, p.d AS payment_method, COUNT(*) AS trips,
                      ROUND({mavg("l_extendedprice")}, 2) AS avg_fare, ROUND({msum("l_extendedprice")}, 2) AS total_revenue
               FROM lineitem JOIN r ON l_linenumber = r.id JOIN p ON l_partkey % 6 + 1 = p.id
               {{where}} GROUP BY 1, 2 ORDER BY 3 DESC"""


@query(STAR_SQL.format(where="WHERE r.id IN (2, 3)"))
def star_join_codes(spark, sf):
    return star_join(table(spark, sf, "lineitem"), [2, 3], "l_linenumber", trip_columns()["payment_type"],
                     "l_extendedprice")


@query(STAR_SQL.format(where=""))
def star_join_all(spark, sf):
    return star_join(table(spark, sf, "lineitem"), None, "l_linenumber", trip_columns()["payment_type"],
                     "l_extendedprice")


# --- order items and parts ---

@query(f"""SELECT p_name AS product_name, SUM(l_quantity) AS units_sold, {msum("l_extendedprice")} AS revenue
           FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_shipdate >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""")
def top_products(spark, sf):
    return marts.top_products(table(spark, sf, "lineitem"), table(spark, sf, "part"), ("l_partkey", "p_partkey"),
                              "p_name", "l_quantity", "l_extendedprice", "l_shipdate", as_of=AS_OF)


WEEKLY_SQL = f"""SELECT {trunc("week", "l_shipdate")} AS week, {msum("l_extendedprice")} AS revenue
                 FROM lineitem JOIN part ON l_partkey = p_partkey
                 WHERE p_type = 'PROMO' AND l_shipdate >= DATE '{AS_OF}' - INTERVAL 90 DAY GROUP BY 1 ORDER BY 1"""


@query(WEEKLY_SQL)
def category_weekly(spark, sf):
    return marts.category_weekly(table(spark, sf, "lineitem"), table(spark, sf, "part"), "PROMO",
                                 ("l_partkey", "p_partkey"), "p_type", "l_extendedprice", "l_shipdate", AS_OF)


@query(WEEKLY_SQL)
def category_weekly_frame(spark, sf):
    return marts.category_weekly_frame(table(spark, sf, "lineitem"), table(spark, sf, "part"), "PROMO",
                                       ("l_partkey", "p_partkey"), "p_type", "l_extendedprice", "l_shipdate", AS_OF)


# --- events ---

E_DAY = trunc("day", "ts")


@query(f"SELECT {E_DAY} AS date, COUNT(DISTINCT user_id) AS dau, COUNT(*) AS events FROM events GROUP BY 1")
def daily_active(spark, sf):
    return marts.daily_active(table(spark, sf, "events"), "ts", "user_id")


@query("""SELECT CAST(DATE_TRUNC('week', ts) AS TIMESTAMP) AS week, COUNT(*) AS events, COUNT(DISTINCT user_id) AS exact, TRUE AS close_enough
          FROM events GROUP BY 1""")
def weekly_active_users(spark, sf):
    """Weeks from the sketches of closed days that are stored and of the open days; users are held to 5 % of the exact number."""
    events = table(spark, sf, "events")
    open_from = events.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).scalar()
    closed = cut_lineage(marts.daily_user_sketches(events.where(F.col("ts") < open_from), "ts", "user_id"), "user_sketches")
    days = closed.unionByName(marts.daily_user_sketches(events.where(F.col("ts") >= open_from), "ts", "user_id"))
    exact = events.groupBy(F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week")).agg(F.count_distinct("user_id").alias("exact"))
    weeks = marts.active_users(days, "week").join(exact, "week")
    return weeks.select("week", "events", "exact", (F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close_enough"))


@query(f"""SELECT {E_DAY} AS date, event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
           {msum("value")} AS total_amount FROM events GROUP BY 1, 2""")
def daily_event_metrics(spark, sf):
    return marts.daily_event_metrics(table(spark, sf, "events"), "ts", "event_type", "user_id", "value")


CONDITIONAL_SQL = f"""SELECT {E_DAY} AS date, COUNT(DISTINCT user_id) AS daily_active_users, COUNT(*) AS total_events,
           CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
           {msum("CASE WHEN event_type = 'purchase' THEN value ELSE 0 END")} AS revenue
           FROM events GROUP BY 1 ORDER BY 1 DESC"""


@query(CONDITIONAL_SQL)
def daily_conditional(spark, sf):
    return marts.daily_conditional(table(spark, sf, "events"), "ts", "user_id", "event_type", "value")


@query("""SELECT DAYNAME(ts) AS day_of_week, CAST(HOUR(ts) AS INTEGER) AS hour, COUNT(*) AS trips
          FROM events GROUP BY 1, 2, ISODOW(ts) ORDER BY ISODOW(ts), 2""")
def weekday_hour_demand(spark, sf):
    return marts.weekday_hour_demand(table(spark, sf, "events"), "ts")


LAG_SQL = "SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_time FROM events"


@query(f"""WITH g AS ({LAG_SQL}),
           m AS (SELECT ts, value, DATEDIFF('minute', prev_event_time, ts) AS minutes FROM g)
           SELECT CAST(HOUR(ts) AS INTEGER) AS hour,
                  ROUND(CAST(SUM(CAST(CASE WHEN minutes = 0 THEN NULL ELSE value / minutes * 60 END AS DECIMAL(28,9))) AS DOUBLE)
                        / COUNT(CASE WHEN minutes = 0 THEN NULL ELSE minutes END), 2) AS avg_mph
           FROM m GROUP BY 1 ORDER BY 1""")
def hourly_speed(spark, sf):
    lagged = windows.previous_event(table(spark, sf, "events").drop("props"), "user_id", "ts", "event_id")
    return marts.hourly_speed(lagged, "ts", "value", minute_boundaries("prev_event_time", "ts"))


@query(f"""SELECT event_id, user_id, ts, prev_event_time FROM ({LAG_SQL}) g""")
def previous_event(spark, sf):
    return windows.previous_event(table(spark, sf, "events").select("event_id", "user_id", "ts"),
                                  "user_id", "ts", "event_id")


GAPS_SQL = f"""SELECT user_id, event_id, ts, prev_event_time,
               CAST(trunc((epoch_us(ts) - epoch_us(prev_event_time)) / 1000000.0) AS BIGINT) AS session_gap_seconds
               FROM ({LAG_SQL}) g
               WHERE CAST(trunc((epoch_us(ts) - epoch_us(prev_event_time)) / 1000000.0) AS BIGINT) > 1800"""


@query(GAPS_SQL)
def session_gaps(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return windows.session_gaps(events, "user_id", "ts", "event_id")


@query(f"""SELECT user_id, COUNT(*) AS large_gap_count,
           CAST(SUM(session_gap_seconds) AS DOUBLE) / COUNT(*) AS avg_gap_seconds FROM ({GAPS_SQL}) g GROUP BY 1""")
def gap_stats(spark, sf):
    return marts.gap_stats(session_gaps(spark, sf))


# --- profiles ---

@query(f"""SELECT COUNT(*) - COUNT(pickup_zone) AS pickup_zone, COUNT(*) - COUNT(clean_distance) AS clean_distance,
           COUNT(*) - COUNT(clean_amount) AS clean_amount,
           3 * COUNT(*) - COUNT(pickup_zone) - COUNT(clean_distance) - COUNT(clean_amount) AS total_nulls
           FROM ({TRIPS_SQL}) t""")
def null_profile(spark, sf):
    return marts.null_profile(trips(spark, sf), ["pickup_zone", "clean_distance", "clean_amount"])


@query("""WITH t AS (SELECT 'orders' AS table_name, MAX(o_orderdate) AS u, COUNT(*) AS n FROM orders
                     UNION ALL SELECT 'events', MAX(ts), COUNT(*) FROM events
                     UNION ALL SELECT 'lineitem', MAX(l_shipdate), COUNT(*) FROM lineitem)
          SELECT table_name, u AS last_update, n AS row_count,
                 ROUND((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(u)) / 3600000000.0, 1) AS hours_since_update
          FROM t""")
def freshness(spark, sf):
    return marts.freshness({"orders": (table(spark, sf, "orders"), "o_orderdate"),
                            "events": (table(spark, sf, "events"), "ts"),
                            "lineitem": (table(spark, sf, "lineitem"), "l_shipdate")}, "2024-02-01")


RULES_SQL = f"""
daily AS (SELECT DATE_TRUNC('day', o_orderdate) AS day, {msum(P)} AS revenue FROM orders GROUP BY 1),
stats AS (SELECT AVG(revenue) AS mean, STDDEV(revenue) AS std FROM daily),
log AS (
  SELECT 'orphan_orders' AS check_name, 'referential_integrity' AS check_type, COUNT(*) AS failing_rows,
         '{ORPHAN_TEXT}' AS check_query
  FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
  UNION ALL SELECT 'revenue_anomaly', 'statistical_outlier', COUNT(*), '{ANOMALY_TEXT}'
  FROM daily, stats WHERE ABS(revenue - mean) > 3 * std
  UNION ALL SELECT 'future_orders', 'temporal_logic', COUNT(*), '{FUTURE_TEXT}'
  FROM orders WHERE o_orderdate > DATE '{AS_OF}')"""


def order_rules(spark, sf):
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return [orphan_orders(orders, items, "o_orderkey", "l_orderkey"), revenue_anomaly(orders, "o_orderdate", P),
            future_orders(orders, "o_orderdate", AS_OF)]


@query(f"""WITH {RULES_SQL} SELECT check_name, check_type, CAST(1 AS BIGINT) AS failure_count,
           TIMESTAMP '2001-08-01' AS last_failure FROM log WHERE failing_rows > 0""")
def quality_report(spark, sf):
    log = run_rules(order_rules(spark, sf)).withColumn("run_at", F.lit(AS_OF).cast("timestamp_ntz"))
    return marts.quality_report(log)
