"""Registry of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_trips

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Report date of the time-boxed reports on orders and order items.
AS_OF = "2001-08-01"


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name. Without SQL only its rows are checked."""

    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- SQL fragments ---

def msum(x: str) -> str:
    parts = f"SUM(CAST(ROUND((({x}) - FLOOR({x})) * 1000000) AS BIGINT))"
    return (f"(CAST(SUM(CAST(FLOOR({x}) AS BIGINT)) + {parts} // 1000000 AS DOUBLE)"
            f" + CAST({parts} % 1000000 AS DOUBLE) / 1000000.0)")


def mavg(x: str) -> str:
    return f"({msum(x)} / COUNT({x}))"


def trunc(part: str, x: str) -> str:
    return f"CAST(DATE_TRUNC('{part}', {x}) AS TIMESTAMP)"


# --- derived inputs ---

TRIP_COLUMNS = {
    "pickup_time": "l_shipdate", "dropoff_time": "l_shipdate", "passenger_count": "l_linenumber",
    "trip_distance": "l_quantity", "pickup_zone": "l_suppkey", "dropoff_zone": "l_partkey",
    "rate_code": "l_linenumber", "fare_amount": "l_extendedprice",
    "tip_amount": "l_tax", "total_amount": "l_extendedprice"}

TRIPS_SQL = """
SELECT l_shipdate AS pickup_time, l_suppkey AS pickup_zone, DATE_TRUNC('day', l_shipdate) AS pickup_date,
       CASE WHEN l_quantity <= 0 OR l_quantity > 45 THEN NULL ELSE l_quantity END AS clean_distance,
       CASE WHEN l_extendedprice < 0 OR l_extendedprice > 100000 THEN NULL ELSE l_extendedprice END AS clean_amount
FROM lineitem WHERE l_linenumber > 0 AND l_extendedprice >= 0"""


def trip_columns() -> dict:
    payment = (F.col("l_partkey") % 6 + 1).cast("int")
    return TRIP_COLUMNS | {"payment_type": payment}


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Order items in the role of trips."""
    return clean_trips(table(spark, sf, "lineitem"), trip_columns(), distance_max=45, amount_max=100_000)


def bank(spark: SparkSession, sf: str) -> DataFrame:
    """All events as bank transactions."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("B"), F.col("event_id").cast("string")).alias("bank_id"), F.col("value").alias("amount"),
        F.col("ts").alias("timestamp"))


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The same events booked 0 to 118 seconds later: twice the second of their minute."""
    later = F.timestamp_add("SECOND", F.second("ts") * 2, F.col("ts"))
    return table(spark, sf, "events").select(
        F.concat(F.lit("L"), F.col("event_id").cast("string")).alias("ledger_id"), F.col("value").alias("amount"),
        later.alias("timestamp"))


FEEDS_SQL = r"""
bank AS (
  SELECT 'B' || event_id AS bank_id, value AS amount, ts AS t, CAST(ROUND(value * 100) AS BIGINT) AS c,
         CAST(ts AS DATE) AS d, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS s
  FROM events),
ledger AS (
  SELECT ledger_id, amount, t, CAST(ROUND(amount * 100) AS BIGINT) AS c, CAST(t AS DATE) AS d,
         hour(t) * 3600 + minute(t) * 60 + second(t) AS s
  FROM (SELECT 'L' || event_id AS ledger_id, value AS amount,
               ts + to_seconds(2 * CAST(second(ts) AS INTEGER)) AS t FROM events)),
matches AS (
  SELECT b.bank_id, l.ledger_id, b.amount, b.t AS bank_time, l.t AS ledger_time,
         CAST(trunc((epoch_us(b.t) - epoch_us(l.t)) / 1000000.0) AS BIGINT) AS time_diff_seconds
  FROM bank b JOIN ledger l ON b.d = l.d AND b.c = l.c AND abs(b.s - l.s) <= 60)"""


