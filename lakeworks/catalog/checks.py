"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money_sum
from ..operators import marts
from ..quality import contracts, metrics
from ..quality.rules import RuleLog, anomalous_days, failures, quality_scorecard, run_rules
from ..quality.schema import Rule, TableSchema
from ..session import new_folder
from .cleaning import raw_events
from .registry import AS_OF, msum, query, table
from .reports import P, RULES_SQL, order_rules

# Event types outside the list, small values and repeated (user, type) hours break this schema.
EVENTS = TableSchema({
    "event_id": Rule("bigint", unique=True),
    "user_id": Rule("bigint", ge=1, le=140),
    "minute": Rule("string", unique=True),
    "event_type": Rule("string", isin=["click", "view", "purchase"]),
    "value": Rule("double", gt=1, lt=300),
    "props": Rule("string", regex=r'^\{"k": [0-9]{2}\}$'),
})


def checked_events(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
                         "event_type", "value", "props")


CHECKED = "(SELECT *, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events) e"
CASES_SQL = f"""
  SELECT event_id, 'user_id' AS c, 'greater_than_or_equal_to(1)' AS k, user_id::VARCHAR AS v FROM {CHECKED} WHERE user_id < 1
  UNION ALL SELECT event_id, 'user_id', 'less_than_or_equal_to(140)', user_id::VARCHAR FROM {CHECKED} WHERE user_id > 140
  UNION ALL SELECT event_id, 'minute', 'unique', minute FROM {CHECKED}
    WHERE minute IN (SELECT minute FROM {CHECKED} GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT event_id, 'event_type', 'isin([''click'', ''view'', ''purchase''])', event_type FROM {CHECKED}
    WHERE event_type NOT IN ('click', 'view', 'purchase')
  UNION ALL SELECT event_id, 'value', 'greater_than(1)', value::VARCHAR FROM {CHECKED} WHERE value <= 1
  UNION ALL SELECT event_id, 'value', 'less_than(300)', value::VARCHAR FROM {CHECKED} WHERE value >= 300
  UNION ALL SELECT event_id, 'props', 'str_matches(^\\{{"k": [0-9]{{2}}\\}}$)', props FROM {CHECKED}
    WHERE NOT regexp_matches(props, '^\\{{"k": [0-9]{{2}}\\}}$')"""


UNIQUE_ORDERS = TableSchema({"o_orderkey": Rule("bigint", unique=True), "customer_day": Rule("string", unique=True),
                             "cents": Rule("bigint", unique=True)})


@query("""WITH o AS (SELECT o_orderkey, o_custkey || '-' || strftime(o_orderdate, '%Y-%m-%d') AS customer_day,
                            CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
          SELECT *, concat_ws(' ', CASE WHEN COUNT(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'o_orderkey:unique' END,
                                   CASE WHEN COUNT(*) OVER (PARTITION BY customer_day) > 1 THEN 'customer_day:unique' END,
                                   CASE WHEN COUNT(*) OVER (PARTITION BY cents) > 1 THEN 'cents:unique' END) AS reasons FROM o""")
def unique_columns(spark, sf):
    """All orders with those of three unique columns that they break."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("customer_day"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return UNIQUE_ORDERS.marked(orders).withColumn("reasons", F.concat_ws(" ", "reasons"))


@query(f"""SELECT event_id::VARCHAR AS row_key, c AS "column", k AS "check", v AS value FROM ({CASES_SQL}) x""")
def schema_failures(spark, sf):
    return EVENTS.failure_cases(checked_events(spark, sf), "event_id")


@query(f"""SELECT c AS "column", k AS "check", COUNT(*) AS rows FROM ({CASES_SQL}) x GROUP BY 1, 2""")
def schema_failure_counts(spark, sf):
    cases = EVENTS.failure_cases(checked_events(spark, sf), "event_id")
    return cases.groupBy("column", "check").agg(F.count("*").alias("rows"))


@query(f"SELECT event_id, event_type, value FROM events WHERE event_id NOT IN (SELECT event_id FROM ({CASES_SQL}) x)")
def events_valid(spark, sf):
    return EVENTS.split(checked_events(spark, sf))[0].select("event_id", "event_type", "value")


@query(f"SELECT event_id, COUNT(*) AS reasons FROM ({CASES_SQL}) x GROUP BY 1")
def events_rejected(spark, sf):
    bad = EVENTS.split(checked_events(spark, sf))[1]
    return bad.select("event_id", F.size("reasons").cast("bigint").alias("reasons"))


@query("""SELECT o_orderkey::VARCHAR AS row_key, 'priority' AS "column", 'dtype(int)' AS "check", o_orderpriority AS value
          FROM orders WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL
          UNION ALL SELECT o_orderkey::VARCHAR, 'priority', 'not_null', o_orderpriority FROM orders WHERE o_orderpriority IS NULL""")
def schema_coerce_failures(spark, sf):
    schema = TableSchema({"o_orderkey": Rule("bigint"), "priority": Rule("int")}, strict=True, coerce=True)
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return schema.failure_cases(orders, "o_orderkey")


@query(f"WITH {RULES_SQL} SELECT * FROM log")
def rule_log(spark, sf):
    return run_rules(order_rules(spark, sf))


@query(f"""WITH {RULES_SQL} SELECT check_name, failing_rows, TIMESTAMP '2001-08-01' AS run_at,
           CASE WHEN check_name IN ('orphan_orders', 'future_orders') THEN 'critical' ELSE 'warning' END AS level
           FROM log WHERE failing_rows > 0""")
def rule_failures(spark, sf):
    log = RuleLog(spark, new_folder(spark, "quality_log"))
    return failures(log.run(order_rules(spark, sf), "run-1", AS_OF))


@query(f"""WITH {RULES_SQL.split("log AS")[0].rstrip().rstrip(",")}
           SELECT CAST(day AS TIMESTAMP) AS day, revenue FROM daily, stats WHERE ABS(revenue - mean) > 3 * std""")
def anomalous_order_days(spark, sf):
    return anomalous_days(table(spark, sf, "orders"), "o_orderdate", P)


@query(f"""SELECT 'Null customer_ids' AS check_name, COUNT(*) AS failures FROM orders WHERE o_custkey IS NULL
           UNION ALL SELECT 'Negative prices', COUNT(*) FROM customer WHERE c_acctbal < 0
           UNION ALL SELECT 'Future order dates', COUNT(*) FROM orders WHERE o_orderdate > DATE '2001-07-01'""")
def quality_scorecard_table(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    late = F.lit("2001-07-01").cast("timestamp_ntz")
    return quality_scorecard({"Null customer_ids": orders.where("o_custkey IS NULL"),
                              "Negative prices": customers.where("c_acctbal < 0"),
                              "Future order dates": orders.where(F.col("o_orderdate") > late)})


@query("""WITH o AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(o_custkey) AS k FROM orders)
          SELECT 'file_exists' AS "check", TRUE AS passed, 'File exists: orders' AS detail FROM o
          UNION ALL SELECT 'row_count', n >= 1, printf('%d rows, expected at least 1', n) FROM o
          UNION ALL SELECT 'no_nulls(o_custkey)', k = 0, printf('%d nulls', k) FROM o
          UNION ALL SELECT 'no_nulls(absent)', FALSE, 'missing column: absent' FROM o""")
def dataset_checks(spark, sf):
    return contracts.dataset_checks(table(spark, sf, "orders"), "orders", ["o_custkey", "absent"])


@query(f"""SELECT CAST(o_orderdate AS TIMESTAMP) AS order_date, {msum(P)} AS revenue, COUNT(*) AS order_count
           FROM orders GROUP BY 1""")
def contract_run(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                               F.col("o_orderdate").alias("order_date"), F.col(P).alias("amount"))
    return contracts.daily_revenue_contract().run(marts.contract_daily_revenue, orders)


@query("SELECT COUNT(*) AS orders FROM orders")
def policy_run(spark, sf):
    orders = table(spark, sf, "orders")
    checked, _ = contracts.apply_policy(orders, {
        "has rows": (contracts.has_rows(), contracts.CRITICAL),
        "keys": (contracts.no_nulls("o_orderkey"), contracts.CRITICAL),
        "large orders": (contracts.none_below(P, 2_000), contracts.WARNING)})
    return checked.agg(F.count("*").alias("orders"))


@query("""SELECT 'warning' AS outcome, 'large orders' AS checks WHERE (SELECT MIN(o_totalprice) FROM orders) < 2000
          UNION ALL SELECT 'info', 'many orders' WHERE (SELECT COUNT(*) FROM orders) < 1000000000
          UNION ALL SELECT 'critical', 'positive' WHERE (SELECT MIN(o_totalprice) FROM orders) < 1000000
          UNION ALL SELECT 'crashed', 'no such column'""")
def policy_levels(spark, sf):
    """Failed checks by level; a critical one and a crashing one raise."""
    orders = table(spark, sf, "orders")
    _, issues = contracts.apply_policy(orders, {
        "has rows": (contracts.has_rows(), contracts.CRITICAL),
        "large orders": (contracts.none_below(P, 2_000), contracts.WARNING),
        "many orders": (F.count("*") >= 1_000_000_000, contracts.INFO)})
    rows = [(level, name) for level in (contracts.WARNING, contracts.INFO) for name in issues[level]]
    bad = {"critical": {"positive": (contracts.none_below(P, 1_000_000), contracts.CRITICAL)},
           "crashed": {"no such column": (contracts.has_rows() & contracts.no_nulls("absent"), contracts.INFO)}}
    for outcome, checks in bad.items():
        try:
            contracts.apply_policy(orders, checks)
        except ValueError as raised:
            rows += [(outcome, name) for name in checks if name in str(raised)]
    found = F.array(*[F.struct(F.lit(outcome).alias("outcome"), F.lit(name).alias("checks")) for outcome, name in rows])
    return spark.range(1).select(F.inline(found if rows else found.cast("array<struct<outcome:string,checks:string>>")))


@query("""SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE event_type <> 'error') AS rows_after,
          COUNT(*) FILTER (WHERE event_type <> 'error') >= COUNT(*) * 0.99 AS passed FROM events""")
def no_row_loss(spark, sf):
    events = table(spark, sf, "events")
    return contracts.no_row_loss(events, events.where("event_type <> 'error'"))


@query("""SELECT l_orderkey AS order_id, l_linenumber, ROUND(l_extendedprice * l_quantity + l_tax * 2 + 1, 2) AS total,
          ROUND(l_extendedprice * l_quantity + l_tax * 2, 2) AS calculated_total FROM lineitem WHERE l_returnflag = 'R'""")
def total_mismatch(spark, sf):
    # Each row holds two nested items; a returned one states a total that is 1 too high.
    def item(price, quantity):
        return F.struct(price.alias("price"), quantity.cast("int").alias("quantity"))

    right = F.col("l_extendedprice") * F.col("l_quantity") + F.col("l_tax") * 2
    orders = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber",
        F.array(item(F.col("l_extendedprice"), F.col("l_quantity")), item(F.col("l_tax"), F.lit(2))).alias("line_items"),
        F.when(F.col("l_returnflag") == "R", right + 1).otherwise(right).alias("total"))
    return metrics.total_mismatch(orders).select("order_id", "l_linenumber", F.round("total", 2).alias("total"),
                                                 F.round("calculated_total", 2).alias("calculated_total"))


@query("""WITH t AS (
            SELECT l_orderkey AS order_id, l_linenumber, CASE l_linenumber WHEN 3 THEN NULL ELSE l_extendedprice + 5 END AS total,
                   CASE l_linenumber WHEN 2 THEN NULL WHEN 1 THEN 5.0 ELSE l_extendedprice + 5 END AS calculated_total FROM lineitem)
          SELECT order_id, l_linenumber, ROUND(total, 2) AS total, ROUND(calculated_total, 2) AS calculated_total FROM t
          WHERE total IS NULL OR calculated_total IS NULL OR ABS(total - calculated_total) > 0.01""")
def total_mismatch_nulls(spark, sf):
    """The first line has an item without a price, the second no items, the third no total."""
    line = F.col("l_linenumber")

    def item(price):
        return F.struct(price.cast("double").alias("price"), F.lit(1).alias("quantity"))

    items = F.array(item(F.when(line != 1, F.col("l_extendedprice"))), item(F.lit(5.0)))
    orders = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", F.when(line != 2, items).alias("line_items"),
        F.when(line != 3, F.col("l_extendedprice") + 5).alias("total"))
    return metrics.total_mismatch(orders).select("order_id", "l_linenumber", F.round("total", 2).alias("total"),
                                                 F.round("calculated_total", 2).alias("calculated_total"))


@query("""SELECT o_orderstatus AS status, CAST(SUM(CAST(o_totalprice / 1000 AS DECIMAL(28, 6))) AS DOUBLE) AS total
          FROM (SELECT o_orderstatus, FLOOR(o_totalprice) AS o_totalprice FROM orders) t GROUP BY 1""")
def money_below_cents(spark, sf):
    """Amounts of three decimals add up without loss."""
    amounts = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), (F.floor("o_totalprice") / 1000).alias("x"))
    return amounts.groupBy("status").agg(money_sum("x").alias("total"))


@query("""SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) AS rows_out,
          COUNT(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS removed FROM events""")
def run_metrics(spark, sf):
    from ..operators.clean import clean_events
    from ..sources.writers import write_parquet

    seen, before = metrics.observed(raw_events(spark, sf), "in")
    kept, after = metrics.observed(clean_events(seen), "out")
    write_parquet(kept, new_folder(spark, "run_metrics"))
    m = metrics.run_metrics(before, after)
    return spark.range(1).select(*[F.lit(m[c]).cast("bigint").alias(c) for c in ("rows_in", "rows_out", "removed")])
