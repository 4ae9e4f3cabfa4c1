"""Scans, sinks and layouts: each query writes the table in one form and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import money_sum, month_range
from ..operators import marts
from ..plans.pipelines import ingest_sales, raw_to_curated
from ..session import new_folder
from ..sources import layout, readers, writers
from .registry import mavg, msum, query, table, trunc

P = "o_totalprice"
BY_STATUS = f"SELECT o_orderstatus AS status, COUNT(*) AS orders, {msum(P)} AS revenue FROM orders GROUP BY 1"
ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def by_status(df):
    return df.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("orders"), money_sum(P).alias("revenue"))


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def scan_parquet(spark, sf):
    items = readers.scan_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_quantity"])
    return items.where("l_quantity > 45")


@query("""SELECT event_id, user_id, props, NULL::VARCHAR AS event_type FROM events WHERE event_type = 'click'
          UNION ALL SELECT event_id, user_id, NULL, event_type FROM events WHERE event_type <> 'click'""")
def scan_merged(spark, sf):
    root, events = new_folder(spark, "merged"), table(spark, sf, "events")
    writers.write_parquet(events.where("event_type = 'click'").select("event_id", "user_id", "props"), f"{root}/jan")
    writers.write_parquet(events.where("event_type <> 'click'").select("event_id", "user_id", "event_type"), f"{root}/feb")
    return readers.scan_merged(spark, f"{root}/jan", f"{root}/feb")


@query("""SELECT event_id, user_id, props, NULL::VARCHAR AS event_type FROM events WHERE event_type = 'click'
          UNION ALL SELECT event_id, user_id, NULL, event_type FROM events WHERE event_type <> 'click'""")
def union_by_name(spark, sf):
    events = table(spark, sf, "events")
    return readers.union_by_name([events.where("event_type = 'click'").select("event_id", "user_id", "props"),
                                  events.where("event_type <> 'click'").select("event_id", "user_id", "event_type")])


@query(BY_STATUS)
def csv_round_trip(spark, sf):
    path = new_folder(spark, "csv")
    writers.write_csv(table(spark, sf, "orders"), path, delimiter="|")
    return by_status(readers.scan_csv(spark, path, schema=ORDERS_DDL, delimiter="|"))


@query(BY_STATUS)
def csv_gz_latest_landing(spark, sf):
    # An older drop holds only part of the orders and must not be read.
    root, orders = new_folder(spark, "landing"), table(spark, sf, "orders")
    writers.land_raw(orders.where("o_orderstatus = 'F'"), root, "20240114T000000")
    writers.land_raw(orders, root, "20240115T000000")
    drops = readers.scan_csv_gz(spark, root, schema=ORDERS_DDL + ", ingest_ts string")
    return by_status(readers.latest_landing(drops, root))


@query(BY_STATUS)
def json_round_trip(spark, sf):
    path = new_folder(spark, "json")
    writers.write_json(table(spark, sf, "orders"), path, gzip=True)
    return by_status(readers.scan_json_array(spark, path, schema=ORDERS_DDL, lines=True))


def _one_document(rows, wrap, path):
    """The rows as one JSON document in one file."""
    items = F.collect_list(F.struct(*rows.columns))
    (rows.agg(F.to_json(F.struct(items.alias(wrap)) if wrap else items).alias("value"))
     .coalesce(1).write.mode("append").text(path))


NATION = "n_nationkey int, n_name string, n_regionkey int"


@query("SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey FROM nation")
def json_array(spark, sf):
    """One file that is a JSON array."""
    path = new_folder(spark, "json_array")
    _one_document(table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"), None, path)
    return readers.scan_json_array(spark, path, schema=NATION)


@query("SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey FROM nation")
def json_pages(spark, sf):
    """Two pages of a response, each wrapping its rows in a field."""
    path, nations = new_folder(spark, "json_pages"), table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for page in (nations.where("n_regionkey < 2"), nations.where("n_regionkey >= 2")):
        _one_document(page, "items", path)
    return readers.scan_json_pages(spark, path, field="items", item_schema=StructType.fromDDL(NATION))


@query("SELECT TRUE AS filter_pushed, TRUE AS two_columns, COUNT(*) AS orders FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'")
def explain_pushdown(spark, sf):
    """What the plan says about the scan, beside its result."""
    wanted = table(spark, sf, "orders").where(month_range("o_orderdate", "1998-01")).select("o_orderdate", "o_orderkey")
    text = layout.plan_text(wanted)
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    return wanted.agg(F.lit("GreaterThanOrEqual(o_orderdate" in text).alias("filter_pushed"),
                      F.lit(read.count(":") == 2).alias("two_columns"), F.count("*").alias("orders"))


@query(f"""SELECT 'csv' AS format, COUNT(*) AS row_count, {msum(P)} AS total FROM orders
           UNION ALL SELECT 'parquet', COUNT(*), {msum(P)} FROM orders""")
def convert_csv_to_parquet(spark, sf):
    source, target = new_folder(spark, "csv"), new_folder(spark, "parquet")
    writers.write_csv(table(spark, sf, "orders"), source)
    return writers.convert_csv_to_parquet(spark, source, target, ORDERS_DDL, P)


@query(f"SELECT o_orderstatus AS status, COUNT(*) AS orders, {msum(P)} AS revenue FROM orders WHERE o_totalprice > 250000 GROUP BY 1")
def ingest_sales_csv(spark, sf):
    source, target = new_folder(spark, "sales"), new_folder(spark, "sales_parquet")
    writers.write_csv(table(spark, sf, "orders"), source)
    ingest_sales(spark, source, target, ORDERS_DDL, P, 250_000)
    return by_status(spark.read.parquet(target))


@query(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           COUNT(*) AS orders, {msum(P)} AS revenue FROM orders GROUP BY 1, 2""")
def write_by_date(spark, sf):
    path = new_folder(spark, "by_date")
    layout.write_by_date(table(spark, sf, "orders"), path, "o_orderdate")
    return readers.scan_partitioned(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("orders"), money_sum(P).alias("revenue"))


@query(f"SELECT COUNT(*) AS orders, ROUND({msum(P)}, 2) AS revenue FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 1")
def month_total_partition(spark, sf):
    path = new_folder(spark, "by_date")
    layout.write_by_date(table(spark, sf, "orders"), path, "o_orderdate")
    return marts.month_total(readers.scan_partitioned(spark, path), P,
                             (F.col("year") == 1998) & (F.col("month") == 1))


@query(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY 1, 2, 3""")
def write_by_date_and_category(spark, sf):
    path = new_folder(spark, "by_category")
    layout.write_by_date_and_category(table(spark, sf, "orders"), path, "o_orderdate", "o_orderpriority")
    return readers.scan_partitioned(spark, path).groupBy("year", "month", "o_orderpriority").agg(
        F.count("*").alias("orders"))


@query(f"""SELECT {trunc("month", "l_shipdate")} AS pickup_month, COUNT(*) AS trips FROM lineitem
           WHERE year(l_shipdate) = 1998 GROUP BY 1""")
def write_by_month_date(spark, sf):
    path = new_folder(spark, "by_month")
    layout.write_by_month_date(table(spark, sf, "lineitem"), path, "l_shipdate", 1998)
    months = readers.scan_partitioned(spark, path).groupBy("pickup_month").agg(F.count("*").alias("trips"))
    return months.withColumn("pickup_month", F.col("pickup_month").cast("timestamp_ntz"))


@query("SELECT o_custkey, COUNT(*) AS orders, CAST(1 AS BIGINT) AS buckets FROM orders GROUP BY 1")
def write_hash_buckets(spark, sf):
    path = new_folder(spark, "buckets")
    layout.write_hash_buckets(table(spark, sf, "orders"), path, "o_custkey")
    return readers.scan_partitioned(spark, path).groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.count_distinct("bucket").alias("buckets"))


@query("SELECT o_custkey, COUNT(*) AS orders, 1 AS buckets FROM orders GROUP BY o_custkey")
def rebucket(spark, sf):
    """Sixteen buckets, then eight in the same folder: no row of the first layout is left."""
    path = new_folder(spark, "rebucket")
    for buckets in (16, 8):
        layout.write_hash_buckets(table(spark, sf, "orders"), path, "o_custkey", buckets)
    return readers.scan_partitioned(spark, path).groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.count_distinct("bucket").cast("int").alias("buckets"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def write_single(spark, sf):
    path = new_folder(spark, "single")
    layout.write_single(table(spark, sf, "nation"), path)
    return spark.read.parquet(path)


@query(f"SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def sorted_write(spark, sf):
    path = new_folder(spark, "sorted")
    layout.sorted_write(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", P), path, ["o_orderdate"])
    return spark.read.parquet(path)


@query(BY_STATUS)
def compact(spark, sf):
    root, target = new_folder(spark, "pages"), new_folder(spark, "compact")
    table(spark, sf, "orders").repartition(12).write.parquet(root)
    writers.compact(spark, [root], target)
    return by_status(spark.read.parquet(target))


@query(f"SELECT 'orders' AS name, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'nation', COUNT(*) FROM nation")
def export_tables(spark, sf):
    target = new_folder(spark, "export")
    names = {"orders": "export_orders", "nation": "export_nation"}
    for name, view in names.items():
        table(spark, sf, name).createOrReplaceTempView(view)
    writers.export_tables(spark, [*names.values(), "export_absent"], target)
    parts = [spark.read.parquet(f"{target}/{view}").agg(F.lit(name).alias("name"), F.count("*").alias("row_count"))
             for name, view in names.items()]
    return parts[0].unionByName(parts[1])


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
          'small' AS verdict FROM orders""")
def partition_report(spark, sf):
    path = new_folder(spark, "by_date")
    layout.write_by_date(table(spark, sf, "orders"), path, "o_orderdate")
    part = [F.regexp_extract("path", rf"{k}=(\d+)", 1).cast("int").alias(k) for k in ("year", "month")]
    return layout.partition_report(spark, path).select(*part, "verdict").distinct()


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, COUNT(*) AS num_rows, TRUE AS shrunk FROM {t}" for t in TABLES))
def footer_report(spark, sf):
    """A row a table, whether it is one file or a folder of them."""
    report = layout.footer_report(spark, *(f"{sf}/{t}.parquet" for t in TABLES))
    return report.groupBy(F.regexp_extract("path", r"([a-z]+)\.parquet", 1).alias("name")).agg(
        F.sum("num_rows").alias("num_rows"), F.every(F.col("compressed_bytes") <= F.col("file_bytes")).alias("shrunk"))


@query("SELECT COUNT(*) AS num_rows FROM orders")
def footer_rows(spark, sf):
    path = new_folder(spark, "by_date")
    layout.write_by_date(table(spark, sf, "orders"), path, "o_orderdate")
    return layout.footer_totals(spark, path).select("num_rows")


@query(f"""SELECT {trunc("day", "o_orderdate")} AS order_day, COUNT(*) AS orders, {msum(P)} AS revenue,
           {mavg(P)} AS avg_order FROM orders WHERE o_totalprice > 0 GROUP BY 1 ORDER BY 1 LIMIT 10""")
def raw_to_curated_run(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("email"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created_at"), F.col(P).alias("total_price"),
        F.col("o_orderstatus").alias("financial_status"), F.col("o_orderstatus").alias("fulfillment_status"))
    return raw_to_curated(raw, new_folder(spark, "staging"), new_folder(spark, "curated"))


@query(BY_STATUS)
def bucketed_table(spark, sf):
    name = "lakeworks_orders_bucketed"
    buckets = layout.bucket_count(spark, f"{sf}/orders.parquet")
    layout.save_bucketed(table(spark, sf, "orders"), name, "o_custkey", buckets, path=new_folder(spark, "bucketed"))
    return by_status(spark.table(name))


@query("""SELECT o_orderstatus AS status, COUNT(*) AS orders, SUM(items) AS items, SUM(quantity) AS quantity
          FROM (SELECT o_orderkey, o_orderstatus, COUNT(*) AS items, CAST(SUM(l_quantity) AS BIGINT) AS quantity
                FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) t GROUP BY 1""")
def bucketed_join(spark, sf):
    """Orders and their items, stored in equal buckets of the order: neither the join nor the grouping by order shuffles a row."""
    names = {t: f"lakeworks_{t}_by_order" for t in ("orders", "lineitem")}
    buckets = layout.bucket_count(spark, f"{sf}/lineitem.parquet")  # those of the larger table
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        layout.save_bucketed(table(spark, sf, t), names[t], key, buckets, path=new_folder(spark, f"bucketed_{t}"))
    # A table that fits in memory would be broadcast; the layout is for those that do not.
    items = spark.table(names["lineitem"]).select("l_orderkey", "l_quantity")
    both = spark.table(names["orders"]).select("o_orderkey", "o_orderstatus").hint("merge").join(items, F.col("l_orderkey") == F.col("o_orderkey"))
    each = both.groupBy("o_orderkey", "o_orderstatus").agg(F.count("*").alias("items"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    return each.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("orders"), F.sum("items").alias("items"), F.sum("quantity").alias("quantity"))


@query(f"""SELECT STRFTIME(o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS orders, {msum('o_totalprice')} AS revenue
           FROM orders WHERE QUARTER(o_orderdate) = 4 AND YEAR(o_orderdate) >= 1999 GROUP BY 1""")
def quarter_total(spark, sf):
    """Fourth-quarter months of a fact kept by month: the months come from a calendar table, so files are picked while the job runs."""
    fact, calendar = new_folder(spark, "orders_by_month"), new_folder(spark, "calendar")
    orders = table(spark, sf, "orders")
    layout.write_by_month(orders.select("o_orderkey", "o_orderdate", "o_totalprice"), fact, "o_orderdate", "order_month")
    months = orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("first_day")).distinct()
    months.select(F.date_format("first_day", "yyyy-MM").alias("calendar_month"), F.quarter("first_day").alias("quarter"), F.year("first_day").alias("year")).write.parquet(calendar)
    wanted = spark.read.parquet(calendar).where("quarter = 4 AND year >= 1999")
    kept = spark.read.schema("o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double, order_month string").parquet(fact)
    return kept.join(wanted, F.col("order_month") == F.col("calendar_month")).groupBy("order_month").agg(
        F.count("*").alias("orders"), money_sum("o_totalprice").alias("revenue"))
