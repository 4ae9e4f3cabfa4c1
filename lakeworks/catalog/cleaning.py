"""Cleaning, projection, join and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, joins, marts, reconcile
from ..functions import seconds_between, strip_all
from ..session import cut_lineage, new_folder
from .registry import FEEDS_SQL, TRIPS_SQL, bank, ledger, msum, query, table, trips

SENSORS = {"temperature": "l_quantity", "pressure": "l_extendedprice", "vibration": "l_tax"}
WARNING = {"temperature": 30, "pressure": 60_000, "vibration": 0.05}
CRITICAL = {"temperature": 40, "pressure": 80_000, "vibration": 0.07}
STATUS_SQL = """CASE WHEN l_quantity > 40 OR l_extendedprice > 80000 OR l_tax > 0.07 THEN 'critical'
                     WHEN l_quantity > 30 OR l_extendedprice > 60000 OR l_tax > 0.05 THEN 'warning'
                     ELSE 'normal' END"""


def readings(spark, sf):
    """Order items in the role of sensor readings."""
    return clean.classify_status(table(spark, sf, "lineitem"), SENSORS, WARNING, CRITICAL)


@query("""SELECT o_orderkey AS order_id, lower(o_orderpriority) AS customer_email, o_orderdate AS order_date,
          o_totalprice AS revenue, o_orderstatus AS payment_status, o_orderstatus AS fulfillment_status
          FROM orders WHERE o_totalprice > 0""")
def stage_orders(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("email"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.col("o_totalprice").cast("string").alias("total_price"), F.col("o_orderstatus").alias("financial_status"),
        F.col("o_orderstatus").alias("fulfillment_status"))
    return clean.stage_orders(raw)


@query("SELECT o_orderkey, o_totalprice, o_totalprice * 0.029 AS fee FROM orders")
def add_fee(spark, sf):
    return clean.add_fee(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("""SELECT o_orderkey, o_totalprice, o_totalprice * 0.029 AS fee FROM orders
          WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 5""")
def head_of_filtered(spark, sf):
    paid = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    return clean.add_fee(paid, "o_totalprice").orderBy("o_orderkey").limit(5)


@query("""SELECT event_id, value FROM events
          WHERE value BETWEEN 10 AND 50 AND event_type IN ('click', 'view') AND props IS NOT NULL
            AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""")
def filter_predicates(spark, sf):
    from ..functions import date_range

    events = table(spark, sf, "events")
    return events.where(F.col("value").between(10, 50) & F.col("event_type").isin("click", "view")
                        & F.col("props").isNotNull() & date_range("ts", "2024-01-05", "2024-01-20")
                        ).select("event_id", "value")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
          CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN NULL ELSE l_quantity END AS clean_quantity,
          CASE WHEN l_extendedprice > 100000 THEN NULL ELSE l_extendedprice END AS clean_price FROM lineitem""")
def null_outliers(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return clean.null_outliers(items, {"clean_quantity": ("l_quantity", 5, 45),
                                       "clean_price": ("l_extendedprice", None, 100_000)})


@query(f"SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, {STATUS_SQL} AS status FROM lineitem")
def classify_status(spark, sf):
    return readings(spark, sf).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "status")


@query("""SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'MACHINERY'), 'UNKNOWN') AS segment_clean,
          COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0.0) AS balance FROM customer""")
def fill_defaults(spark, sf):
    raw = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return clean.fill_defaults(raw, {"segment": "UNKNOWN", "balance": 0.0}, {"segment": "segment_clean"}).drop("segment")


@query("""SELECT event_id, COALESCE(NULLIF(event_type, 'error'), 'unknown') AS event_type, 'none' AS referral_source
          FROM events""")
def add_column_with_default(spark, sf):
    raw = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    filled = clean.add_column_with_default(raw, "event_type", "unknown")
    return clean.add_column_with_default(filled, "referral_source", "none")


@query("""SELECT o_orderkey, o_totalprice, CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR AS price_text,
          TRY_CAST(o_orderpriority AS BIGINT) IS NULL AS not_a_number FROM orders""")
def add_column_as_new_type(spark, sf):
    raw = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    wide = clean.add_column_as_new_type(raw, "o_totalprice", "price_decimal", "decimal(18,2)")
    text = clean.add_column_as_new_type(wide, "price_decimal", "price_text", "string")
    lenient = clean.add_column_as_new_type(text, "o_orderpriority", "number", "bigint", lenient=True)
    return (lenient.withColumn("not_a_number", F.col("number").isNull())
            .drop("price_decimal", "o_orderpriority", "number"))


@query("SELECT * EXCLUDE (props) FROM events")
def drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "events"), "props")


@query("""SELECT o_orderkey, ROUND(o_totalprice * 1.07, 2) AS amount, o_orderdate AS order_date,
          trim(lower(o_orderpriority)) AS status FROM orders""")
def normalise_text_num(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") * 1.07).alias("amount"), F.col("o_orderdate").alias("order_date"),
        F.concat(F.lit(" \t"), "o_orderpriority", F.lit("\n ")).alias("status"))
    return clean.normalise_text_num(raw).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


FIRST_SQL = """SELECT event_id, ts, user_id, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM events) t WHERE rn = 1"""


@query(FIRST_SQL.format(keys="user_id, event_type", order="event_id"))
def dedup(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return clean.dedup(events, ["user_id", "event_type"], ["event_id"])


@query(FIRST_SQL.format(keys="user_id", order="ts DESC, event_id DESC"))
def keep_latest(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return clean.keep_latest(events, "user_id", "ts", "event_id")


SAMPLE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SAMPLE_SQL = f"""SELECT *, {STATUS_SQL} AS status FROM lineitem WHERE {STATUS_SQL} <> 'normal'
                 ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')), l_orderkey LIMIT 500"""


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, status FROM ({SAMPLE_SQL}) s")
def sample_rows(spark, sf):
    abnormal = readings(spark, sf).where("status <> 'normal'")
    return clean.sample_rows(abnormal, 500, SAMPLE_KEYS).select(*SAMPLE_KEYS, "status")


TEXT_COLUMNS = SENSORS | {"device_type": "l_returnflag", "sensor_id": "l_orderkey", "facility": "l_linestatus"}
TEXT_SQL = f"""l_returnflag || ' sensor ' || l_orderkey || ' at ' || l_linestatus || ': status ' || ({STATUS_SQL})
  || ', temp ' || l_quantity || '°C, pressure ' || l_extendedprice || ' PSI, vibration ' || l_tax || ' mm/s'"""


@query(f"SELECT l_orderkey, l_linenumber, {TEXT_SQL} AS searchable_text FROM lineitem")
def render_text(spark, sf):
    return clean.render_text(readings(spark, sf), TEXT_COLUMNS).select("l_orderkey", "l_linenumber", "searchable_text")


def _any(words: list[str]) -> str:
    return " OR ".join(f"contains(lower(text), '{w}')" for w in words)


@query(f"""SELECT conv_id, turn, CASE WHEN {_any(clean.SEMANTIC_WORDS)} THEN 'semantic_search'
             WHEN {_any(clean.DOCS_WORDS)} THEN 'docs' ELSE 'sql' END AS tool
           FROM conversations WHERE role = 'user'""")
def route_questions(spark, sf):
    asked = table(spark, sf, "conversations").where("role = 'user'")
    return clean.route_questions(asked, "text").select("conv_id", "turn", "tool")


@query("""SELECT conv_id, turn, regexp_replace(replace(replace(text, 'similar to', ''), 'find events like', ''),
          '^[ \\t\\r\\n\\f\\v]+|[ \\t\\r\\n\\f\\v]+$', '', 'g') AS term FROM conversations""")
def search_term(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", clean.search_term("text").alias("term"))


@query("""SELECT event_id, user_id, event_type, ts AS event_ts, value AS amount FROM events
          WHERE user_id IS NOT NULL AND event_type IN ('click', 'view', 'purchase')""")
def clean_events(spark, sf):
    return clean.clean_events(raw_events(spark, sf)).drop("timestamp")


def raw_events(spark, sf):
    """Events with their time as text, as a raw feed delivers it."""
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("string").alias("timestamp"),
        F.col("value").alias("amount"))


@query("SELECT p_partkey, p_size - 10 AS quantity FROM part WHERE p_size - 10 >= 0")
def snapshot_inventory(spark, sf):
    return clean.snapshot_inventory(table(spark, sf, "part").select("p_partkey", (F.col("p_size") - 10).alias("quantity")))


@query(f"SELECT pickup_time, pickup_zone, CAST(pickup_date AS TIMESTAMP) AS pickup_date, clean_distance, clean_amount FROM ({TRIPS_SQL}) t")
def clean_trips(spark, sf):
    return trips(spark, sf).select("pickup_time", "pickup_zone", "pickup_date", "clean_distance", "clean_amount")


@query("""SELECT event_id, ROUND((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 1000000.0, 3) AS age_seconds,
          trim(event_type) AS kind FROM events""")
def seconds_and_strip(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", seconds_between(F.lit("2024-02-01").cast("timestamp_ntz"), "ts").alias("age_seconds"),
        strip_all("event_type").alias("kind"))


# --- joins ---

@query("""SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment FROM orders
          LEFT JOIN customer ON o_custkey = c_custkey""")
def left_join_customers(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.enrich(orders, customers, "o_custkey", ["c_name", "c_mktsegment"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey
          WHERE o_orderstatus = 'F'""")
def inner_join_customers(spark, sf):
    paid = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.enrich(paid, customers, "o_custkey", ["c_name"], how="inner")


@query("""SELECT l_partkey AS product_id, l_orderkey, l_linenumber, l_extendedprice, p_name, p_retailprice
          FROM lineitem JOIN part ON l_partkey = p_partkey""")
def items_with_products(spark, sf):
    joined = marts.items_with_products(table(spark, sf, "lineitem"), table(spark, sf, "part"), ("l_partkey", "p_partkey"))
    return joined.select("product_id", "l_orderkey", "l_linenumber", "l_extendedprice", "p_name", "p_retailprice")


@query("SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def supplier_nations(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return joins.enrich(table(spark, sf, "supplier"), nations, "s_nationkey", ["n_name"], how="inner").select(
        "s_suppkey", "s_name", "n_name")


@query("""SELECT o_orderkey, o_custkey FROM orders o
          WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def orders_without_items(spark, sf):
    return joins.orphans(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey",
                         table(spark, sf, "lineitem"), "l_orderkey")


@query("""SELECT o_orderkey, o_custkey FROM orders o
          WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def orders_without_customer(spark, sf):
    return joins.orphans(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey",
                         table(spark, sf, "customer"), "c_custkey")


# --- reconciliation ---

def feeds(spark, sf):
    b, r = reconcile.prepare(bank(spark, sf)), reconcile.prepare(ledger(spark, sf))
    return b, r, reconcile.match_transactions(b, r)


@query(f"WITH {FEEDS_SQL} SELECT * FROM matches")
def match_with_tolerance(spark, sf):
    return feeds(spark, sf)[2]


@query(f"""WITH {FEEDS_SQL}, near AS (
             SELECT b.bank_id, l.ledger_id, abs(epoch_us(b.t) - epoch_us(l.t)) AS gap, b.amount, b.t AS bank_time,
                    l.t AS ledger_time,
                    CAST(trunc((epoch_us(b.t) - epoch_us(l.t)) / 1000000.0) AS BIGINT) AS time_diff_seconds
             FROM bank b JOIN ledger l ON b.c = l.c AND abs(epoch_us(b.t) - epoch_us(l.t)) <= 60000000),
           ranked AS (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY bank_id ORDER BY gap, ledger_id) AS rb,
                    ROW_NUMBER() OVER (PARTITION BY ledger_id ORDER BY gap, bank_id) AS rl FROM near)
           SELECT bank_id, ledger_id, amount, bank_time, ledger_time, time_diff_seconds
           FROM ranked WHERE rb = 1 AND rl = 1""")
def match_one_to_one(spark, sf):
    return reconcile.match_transactions(reconcile.prepare(bank(spark, sf)), reconcile.prepare(ledger(spark, sf)),
                                        strict=True)


UNMATCHED_SQL = """SELECT {id}, amount, t AS timestamp, '{status}' AS status FROM {side}
                   WHERE {id} NOT IN (SELECT {id} FROM matches)"""
UNMATCHED_BANK = f"WITH {FEEDS_SQL} " + UNMATCHED_SQL.format(id="bank_id", status="UNMATCHED_BANK", side="bank")
UNMATCHED_LEDGER = f"WITH {FEEDS_SQL} " + UNMATCHED_SQL.format(id="ledger_id", status="UNMATCHED_LEDGER", side="ledger")


@query(UNMATCHED_BANK)
def unmatched_bank(spark, sf):
    b, r, _ = feeds(spark, sf)
    return reconcile.unmatched(b, r, "UNMATCHED_BANK")


@query(UNMATCHED_LEDGER)
def unmatched_ledger(spark, sf):
    b, r, _ = feeds(spark, sf)
    return reconcile.unmatched(r, b, "UNMATCHED_LEDGER")


@query(UNMATCHED_BANK)
def unmatched_bank_by_id(spark, sf):
    b, _, matches = feeds(spark, sf)
    return reconcile.find_unmatched(b, matches, "bank_id", "UNMATCHED_BANK")


@query(f"""WITH {FEEDS_SQL}
           SELECT (SELECT CAST(SUM(b.c) AS DOUBLE) / 100.0 FROM bank b JOIN matches m ON b.bank_id = m.bank_id) AS total,
                  (SELECT CAST(SUM(b.c) AS DOUBLE) / 100.0 FROM bank b WHERE b.bank_id IN (SELECT bank_id FROM matches)) AS total_once""")
def matched_total(spark, sf):
    b, _, matches = feeds(spark, sf)
    return spark.range(1).select(reconcile.matched_total(b, matches, "bank_id").alias("total"),
                                 reconcile.matched_total(b, matches, "bank_id", distinct=True).alias("total_once"))


REPORT_SQL = f"""WITH {FEEDS_SQL}, report AS (
  SELECT bank_id, ledger_id, amount, bank_time, ledger_time, CAST(time_diff_seconds AS DOUBLE) AS time_diff_seconds,
         'MATCHED' AS status FROM matches
  UNION ALL SELECT bank_id, NULL, amount, t, NULL, NULL, 'UNMATCHED_BANK' FROM bank
    WHERE bank_id NOT IN (SELECT bank_id FROM matches)
  UNION ALL SELECT NULL, ledger_id, amount, NULL, t, NULL, 'UNMATCHED_LEDGER' FROM ledger
    WHERE ledger_id NOT IN (SELECT ledger_id FROM matches))"""


@query(REPORT_SQL + " SELECT * FROM report ORDER BY bank_time NULLS LAST, ledger_time NULLS LAST")
def recon_report(spark, sf):
    b, r, matches = feeds(spark, sf)
    return reconcile.recon_report(b, r, cut_lineage(matches, "matches"))


RULE_ROWS_SQL = f"""WITH {FEEDS_SQL},
  t AS (SELECT (SELECT CAST(SUM(b.c) AS DOUBLE) / 100.0 FROM bank b JOIN matches m ON b.bank_id = m.bank_id) AS b,
               (SELECT CAST(SUM(l.c) AS DOUBLE) / 100.0 FROM ledger l JOIN matches m ON l.ledger_id = m.ledger_id) AS l),
  d AS (SELECT COUNT(*) AS d FROM (SELECT bank_id FROM matches GROUP BY 1 HAVING COUNT(*) > 1) x),
  k AS (SELECT (SELECT COUNT(*) FROM matches) AS m, (SELECT COUNT(*) FROM bank) AS n,
               (SELECT MAX(ABS(time_diff_seconds)) FROM matches) AS w)
  SELECT 'Matched totals equal' AS rule, ABS(b - l) < 0.01 AS passed,
         printf('Bank: $%.2f | Ledger: $%.2f', b, l) AS message FROM t
  UNION ALL SELECT 'No duplicate bank matches', d = 0, CASE WHEN d = 0 THEN 'OK' ELSE printf('Found %d duplicates', d) END FROM d
  UNION ALL SELECT 'Match rate >= 80%', m / n >= 0.8, printf('%.1f%% (%d/%d)', 100.0 * m / n, m, n) FROM k
  UNION ALL SELECT 'Time differences <= 5min', w <= 300, printf('Max: %ds', w) FROM k"""


@query(RULE_ROWS_SQL)
def recon_rules(spark, sf):
    b, r, _ = feeds(spark, sf)
    return reconcile.recon_rules(reconcile.measure_feeds(b, r))


@query(RULE_ROWS_SQL)
def recon_rules_of_matches(spark, sf):
    b, r, matches = feeds(spark, sf)
    return reconcile.recon_rules(reconcile.measure_matches(b, r, cut_lineage(matches, "matches")))


RUNS_SQL = f"""WITH {FEEDS_SQL},
  bs AS (SELECT d, c, s, COUNT(*) AS rows FROM bank GROUP BY 1, 2, 3), ls AS (SELECT d, c, s, COUNT(*) AS rows FROM ledger GROUP BY 1, 2, 3),
  runs AS (
    SELECT 'bank' AS side, x.d, x.c, x.s, x.rows, CAST(COALESCE(SUM(y.rows), 0) AS BIGINT) AS partners, MIN(y.s) AS first_second, MAX(y.s) AS last_second
    FROM bs x LEFT JOIN ls y ON x.d = y.d AND x.c = y.c AND abs(x.s - y.s) <= 60 GROUP BY 1, 2, 3, 4, 5
    UNION ALL
    SELECT 'ledger', x.d, x.c, x.s, x.rows, CAST(COALESCE(SUM(y.rows), 0) AS BIGINT), MIN(y.s), MAX(y.s)
    FROM ls x LEFT JOIN bs y ON x.d = y.d AND x.c = y.c AND abs(x.s - y.s) <= 60 GROUP BY 1, 2, 3, 4, 5)"""


def runs_of(spark, sf):
    b, r = reconcile.prepare(bank(spark, sf)), reconcile.prepare(ledger(spark, sf))
    return b, r, reconcile.match_runs(b, r)


@query(RUNS_SQL + """ SELECT side, d AS date, c AS amount_cents, CAST(s AS INTEGER) AS time_seconds, rows, partners,
                      CAST(first_second AS INTEGER) AS first_second, CAST(last_second AS INTEGER) AS last_second FROM runs""")
def match_runs(spark, sf):
    """Matches as one row per side, date, amount and second."""
    runs = runs_of(spark, sf)[2]
    return runs.select("side", "date", "amount_cents", *(F.col(c).cast("int").alias(c) for c in ("time_seconds",)), "rows", "partners",
                       *(F.col(c).cast("int").alias(c) for c in ("first_second", "last_second")))


@query(f"WITH {FEEDS_SQL} SELECT * FROM matches")
def match_runs_expanded(spark, sf):
    b, r, runs = runs_of(spark, sf)
    return reconcile.expand_runs(runs, b, r)


@query(f"""WITH {FEEDS_SQL},
  bm AS (SELECT bank_id AS id, COUNT(*) AS n, MIN(hour(ledger_time) * 3600 + minute(ledger_time) * 60 + second(ledger_time)) AS f,
                MAX(hour(ledger_time) * 3600 + minute(ledger_time) * 60 + second(ledger_time)) AS l FROM matches GROUP BY 1),
  lm AS (SELECT ledger_id AS id, COUNT(*) AS n, MIN(hour(bank_time) * 3600 + minute(bank_time) * 60 + second(bank_time)) AS f,
                MAX(hour(bank_time) * 3600 + minute(bank_time) * 60 + second(bank_time)) AS l FROM matches GROUP BY 1)
  SELECT 'bank' AS side, bank_id AS id, amount, t AS time, CASE WHEN n > 0 THEN 'MATCHED' ELSE 'UNMATCHED_BANK' END AS status,
         COALESCE(n, 0) AS partners, CAST(f AS INTEGER) AS first_second, CAST(l AS INTEGER) AS last_second FROM bank LEFT JOIN bm ON bank_id = id
  UNION ALL
  SELECT 'ledger', ledger_id, amount, t, CASE WHEN n > 0 THEN 'MATCHED' ELSE 'UNMATCHED_LEDGER' END, COALESCE(n, 0),
         CAST(f AS INTEGER), CAST(l AS INTEGER) FROM ledger LEFT JOIN lm ON ledger_id = id""")
def run_report(spark, sf):
    found = reconcile.run_report(*runs_of(spark, sf))
    return found.withColumns({c: F.col(c).cast("int") for c in ("first_second", "last_second")})


@query(RULE_ROWS_SQL)
def recon_rules_of_runs(spark, sf):
    b, _, runs = runs_of(spark, sf)
    return reconcile.recon_rules(reconcile.measure_runs(b, runs))


@query(REPORT_SQL + f" SELECT status, COUNT(*) AS n, {msum('amount')} AS total FROM report GROUP BY 1")
def recon_status_totals(spark, sf):
    b, r, _ = feeds(spark, sf)
    return marts.recon_status_totals(reconcile.match_by_month(b, r, new_folder(spark, "recon")))
