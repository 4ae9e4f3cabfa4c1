"""Warehouse views, materialisation, pipelines and dataset versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts
from ..plans import versions
from ..plans.pipelines import event_run, multi_source_run, quality_pipeline, reconcile
from ..plans.warehouse import materialise, materialise_cached, materialise_if_stale, register_views
from ..quality.rules import RuleLog
from ..session import new_folder
from ..sources.writers import write_csv
from .cleaning import raw_events
from .registry import TRIPS_SQL, bank, ledger, msum, query, table, trip_columns, trips, trunc
from .reports import MONTHLY_ZONES, P


@query(f"""SELECT pickup_zone, COUNT(*) AS trips, ROUND({msum("clean_amount")}, 2) AS revenue,
           (SELECT COUNT(*) FROM lineitem) AS all_trips FROM ({TRIPS_SQL}) t GROUP BY 1""")
def warehouse_views(spark, sf):
    register_views(spark, f"{sf}/lineitem.parquet", columns=trip_columns(), distance_max=45, amount_max=100_000)
    return spark.sql("""
        SELECT pickup_zone, count(*) AS trips, (SELECT count(*) FROM trips) AS all_trips,
               floor(CAST(sum(CAST(rint(clean_amount * 100) AS BIGINT)) AS DOUBLE) + 0.5D) / 100.0D AS revenue
        FROM clean_trips GROUP BY pickup_zone""")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount * 60 END AS speed
          FROM lineitem""")
def trip_efficiency(spark, sf):
    register_views(spark, f"{sf}/lineitem.parquet", columns=trip_columns())
    return spark.sql("SELECT l_orderkey, l_linenumber, trip_efficiency(l_quantity, l_discount) AS speed FROM trips")


ZONES_1998 = f"""SELECT pickup_zone, CAST(SUM(trip_count) AS BIGINT) AS total_trips, ROUND({msum("total_revenue")}, 2) AS revenue
                 FROM ({MONTHLY_ZONES}) z WHERE pickup_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
                 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


@query(ZONES_1998)
def top_zones_materialised(spark, sf):
    store = versions.VersionStore(spark, new_folder(spark, "store"))
    summary = materialise(store, "monthly_summary", marts.monthly_zone_summary(trips(spark, sf)))
    return marts.top_zones(summary, "1998-01-01", "1998-12-31")


@query("""SELECT o_orderkey, 'changed' AS change FROM orders
          WHERE o_orderpriority = '1-URGENT'""")
def version_diff_nulls(spark, sf):
    """A value that moves from one column to another, NULL in the first, is a change."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"),
                                               "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    moved = orders.withColumns({"a": F.when(~urgent, F.col("a")), "b": F.when(urgent, F.col("a"))})
    return versions.diff(orders, moved, ["o_orderkey"])


@query("SELECT COUNT(*) AS row_count, FALSE AS same_hash FROM orders")
def version_rename(spark, sf):
    """Renamed columns make another content."""
    orders = table(spark, sf, "orders")
    swapped = {"o_custkey": "o_orderkey", "o_orderkey": "o_custkey"}
    renamed = orders.toDF(*[swapped.get(c, c) for c in orders.columns])
    other = versions.fingerprint(renamed).select("content_hash").scalar()
    return versions.fingerprint(orders).select("row_count", (F.col("content_hash") == other).alias("same_hash"))


@query("SELECT TRUE AS first_built, FALSE AS second_built, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def materialised_if_stale(spark, sf):
    target = new_folder(spark, "daily")

    def build():
        return marts.materialised_daily(table(spark, sf, "orders"), "o_orderdate", "o_custkey", P)

    _, first = materialise_if_stale(spark, target, [f"{sf}/orders.parquet"], build)
    result, second = materialise_if_stale(spark, target, [f"{sf}/orders.parquet"], build)
    return result.agg(F.lit(first).alias("first_built"), F.lit(second).alias("second_built"), F.count("*").alias("days"))


@query("""SELECT o_orderkey, 'changed' AS change FROM orders
          WHERE o_orderpriority = '1-URGENT'""")
def version_diff_nulls(spark, sf):
    """A value that moves from one column to another, NULL in the first, is a change."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"),
                                               "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    moved = orders.withColumns({"a": F.when(~urgent, F.col("a")), "b": F.when(urgent, F.col("a"))})
    return versions.diff(orders, moved, ["o_orderkey"])


@query("SELECT COUNT(*) AS row_count, FALSE AS same_hash FROM orders")
def version_rename(spark, sf):
    """Renamed columns make another content."""
    orders = table(spark, sf, "orders")
    swapped = {"o_custkey": "o_orderkey", "o_orderkey": "o_custkey"}
    renamed = orders.toDF(*[swapped.get(c, c) for c in orders.columns])
    other = versions.fingerprint(renamed).select("content_hash").scalar()
    return versions.fingerprint(orders).select("row_count", (F.col("content_hash") == other).alias("same_hash"))


@query("SELECT TRUE AS first_built, FALSE AS second_built, TRUE AS new_code_built, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def materialised_cached(spark, sf):
    store, inputs = versions.VersionStore(spark, new_folder(spark, "store")), [f"{sf}/orders.parquet"]

    def build():
        return marts.materialised_daily(table(spark, sf, "orders"), "o_orderdate", "o_custkey", P)

    _, first = materialise_cached(store, "daily", inputs, build)
    _, second = materialise_cached(store, "daily", inputs, build)
    result, third = materialise_cached(store, "daily", inputs, build, code_version="2")
    return result.agg(F.lit(first).alias("first_built"), F.lit(second).alias("second_built"),
                      F.lit(third).alias("new_code_built"), F.count("*").alias("days"))


@query(f"""SELECT {trunc("day", "o_orderdate")} AS date, COUNT(*) AS order_count, COUNT(DISTINCT o_custkey) AS unique_customers,
           {msum(P)} AS total_revenue FROM orders GROUP BY 1""")
def multi_source_revenue(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    # Two deliveries of every customer: the later one must win.
    stamped = [customers.select((F.col("id") + 1).alias("customer_id"),
                                F.format_string("c%d@example.com", "id").alias("email"), "name",
                                F.lit(day).cast("timestamp_ntz").alias("updated_at"))
               for day in ("2024-01-01", "2024-01-02")]
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") + 1).alias("customer_id"), F.col(P).alias("total"),
        F.col("o_orderdate").alias("order_date"),
        F.array(F.struct(F.col(P).alias("price"), F.lit(1).alias("quantity"))).alias("line_items"))
    stock = table(spark, sf, "part").select("p_partkey", (F.col("p_size") - 10).alias("quantity"))
    target = new_folder(spark, "multi_source")
    multi_source_run(stamped[0].unionByName(stamped[1]), orders, stock, target)
    return spark.read.parquet(f"{target}/daily_revenue").select("date", "order_count", "unique_customers", "total_revenue")


@query(f"""SELECT {trunc("day", "ts")} AS date, event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
           {msum("value")} AS total_amount FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2""")
def event_run_metrics(spark, sf):
    # User ids start at 0 here and the event schema asks for 1 or more.
    raw = raw_events(spark, sf).drop("event_id").withColumn("user_id", F.col("user_id") + 1)
    return event_run(raw, new_folder(spark, "event_run"))


@query("""SELECT 4 AS rules, (SELECT COUNT(*) FROM events) AS bank_rows""")
def reconcile_run(spark, sf):
    report, rules = reconcile(bank(spark, sf), ledger(spark, sf), new_folder(spark, "report"),
                              new_folder(spark, "rules"), run_timestamp="2024-02-01 00:00:00")
    return report.agg(rules.agg(F.count("*").cast("int")).scalar().alias("rules"),
                      F.count_distinct("bank_id").alias("bank_rows"))


@query("""SELECT o_orderkey::VARCHAR AS order_id, o_custkey AS customer_id, ROUND(o_totalprice, 2) AS amount,
          CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'pending' ELSE 'shipped' END AS status FROM orders""")
def quality_pipeline_run(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "P", "pending").otherwise("shipped")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"), F.col(P).alias("amount"),
        F.lit(1).alias("quantity"), status.alias("status"))
    source = new_folder(spark, "orders_csv")
    write_csv(orders, source)
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    done = quality_pipeline(spark, source, new_folder(spark, "orders_checked"), customers,
                            RuleLog(spark, new_folder(spark, "quality_log")), as_of="2024-01-01")
    return done.select("order_id", "customer_id", "amount", "status")


# --- versions ---

@query(f"SELECT o_orderstatus AS status, COUNT(*) AS orders, {msum(P)} AS revenue FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def version_checkout(spark, sf):
    store, orders = versions.VersionStore(spark, new_folder(spark, "store")), table(spark, sf, "orders")
    store.commit(orders.where("o_orderstatus <> 'P'"), "orders", "without pending", {"pipeline": "ingest_v1"})
    store.tag("orders", "v1")
    store.commit(orders, "orders", "all", {"pipeline": "ingest_v2"})
    old = store.checkout("orders", "v1")
    return old.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("orders"), marts.money_sum(P).alias("revenue"))


@query("SELECT COUNT(*) AS row_count, TRUE AS same_hash FROM orders")
def version_fingerprint(spark, sf):
    orders = table(spark, sf, "orders")
    shuffled = orders.repartition(7, "o_custkey").select(*reversed(orders.columns))
    other = versions.fingerprint(shuffled).select("content_hash").scalar()
    return versions.fingerprint(orders).select("row_count", (F.col("content_hash") == other).alias("same_hash"))


@query("SELECT FALSE AS bad_published, TRUE AS good_published, COUNT(*) AS main_rows FROM orders")
def version_publish(spark, sf):
    store, orders = versions.VersionStore(spark, new_folder(spark, "store")), table(spark, sf, "orders")
    checks = {"rows": F.count("*") > 0, "positive": F.min(P) >= 0}
    store.write_audit_publish(orders, "orders", checks)
    good = store.checkout("orders").count()
    try:
        store.write_audit_publish(orders.withColumn(P, -F.col(P)), "orders", checks)
        bad = True
    except ValueError:
        bad = False
    return store.checkout("orders").agg(F.lit(bad).alias("bad_published"), F.lit(good > 0).alias("good_published"),
                                        F.count_if(F.col(P) >= 0).alias("main_rows"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'added' WHEN o_orderstatus = 'P' THEN 'removed' ELSE 'changed' END AS change
          FROM orders WHERE (o_orderpriority = '5-LOW' AND o_orderstatus <> 'P') OR (o_orderpriority <> '5-LOW' AND o_orderstatus = 'P')
             OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')""")
def version_diff(spark, sf):
    orders = table(spark, sf, "orders")
    old = orders.where("o_orderpriority <> '5-LOW'")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col(P) + 1).otherwise(F.col(P))
    return versions.diff(old, orders.where("o_orderstatus <> 'P'").withColumn(P, urgent), ["o_orderkey"])


@query("""SELECT o_orderkey, 'changed' AS change FROM orders
          WHERE o_orderpriority = '1-URGENT'""")
def version_diff_nulls(spark, sf):
    """A value that moves from one column to another, NULL in the first, is a change."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"),
                                               "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    moved = orders.withColumns({"a": F.when(~urgent, F.col("a")), "b": F.when(urgent, F.col("a"))})
    return versions.diff(orders, moved, ["o_orderkey"])


@query("SELECT COUNT(*) AS row_count, FALSE AS same_hash FROM orders")
def version_rename(spark, sf):
    """Renamed columns make another content."""
    orders = table(spark, sf, "orders")
    swapped = {"o_custkey": "o_orderkey", "o_orderkey": "o_custkey"}
    renamed = orders.toDF(*[swapped.get(c, c) for c in orders.columns])
    other = versions.fingerprint(renamed).select("content_hash").scalar()
    return versions.fingerprint(orders).select("row_count", (F.col("content_hash") == other).alias("same_hash"))


@query("SELECT TRUE AS first_built, FALSE AS second_built, TRUE AS changed_built, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def stage_lock(spark, sf):
    store, orders = versions.VersionStore(spark, new_folder(spark, "store")), table(spark, sf, "orders")

    def build(orders):
        return marts.materialised_daily(orders, "o_orderdate", "o_custkey", P)

    _, first = store.run_stage("daily", {"orders": orders}, build)
    _, second = store.run_stage("daily", {"orders": orders.repartition(5)}, build)
    result, third = store.run_stage("daily", {"orders": orders.withColumn(P, F.col(P) + 1)}, build)
    return result.agg(F.lit(first).alias("first_built"), F.lit(second).alias("second_built"),
                      F.lit(third).alias("changed_built"), F.count("*").alias("days"))


@query("SELECT COUNT(*) AS days, CAST(SUM(n) AS BIGINT) AS rows, TRUE AS first_built, FALSE AS second_built, TRUE AS added_built, TRUE AS only_new_files_read, TRUE AS same_hash "
       "FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1) t")
def stage_lock_files(spark, sf):
    """A stage over files that come in two drops: what is rebuilt, and that the second drop's digests are all that is added."""
    store, orders, drops = versions.VersionStore(spark, new_folder(spark, "store")), table(spark, sf, "orders"), new_folder(spark, "drops")

    def build(orders):
        return orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("n"))

    second_drop = F.pmod(F.xxhash64("o_orderkey"), F.lit(4)) == 0
    orders.where(~second_drop).write.parquet(drops)
    _, first = store.run_stage_on_files("daily", {"orders": drops}, build)
    _, second = store.run_stage_on_files("daily", {"orders": drops}, build)
    orders.where(second_drop).write.mode("append").parquet(drops)
    result, third = store.run_stage_on_files("daily", {"orders": drops}, build)
    digests = spark.read.parquet(f"{store.root}/digests")
    hashed = digests.agg(F.sum("row_count")).scalar()  # a file that was hashed twice would count twice
    whole = versions.fingerprint(orders).select("content_hash").scalar()
    return result.agg(F.count("*").alias("days"), F.sum("n").alias("rows"), F.lit(first).alias("first_built"), F.lit(second).alias("second_built"),
                      F.lit(third).alias("added_built"), (hashed == F.sum("n")).alias("only_new_files_read"),
                      (F.lit(store.folder_hash(drops)) == whole).alias("same_hash"))
