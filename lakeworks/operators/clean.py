"""Projections, filters and cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions import as_col, day_of, null_outside, round2, strip_all

# Sensor thresholds (strictly above), question keywords, allowed event types.
WARNING_ABOVE = {"temperature": 85, "pressure": 145, "vibration": 10}
CRITICAL_ABOVE = {"temperature": 92, "pressure": 152, "vibration": 12}
SEMANTIC_WORDS = ["similar", "like", "find events"]
DOCS_WORDS = ["what is", "what does", "define", "explain", "mean", "how is"]
EVENT_TYPES = ["click", "view", "purchase"]


def stage_orders(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Raw shop export -> typed staging rows: e-mail lowered, time parsed, test orders dropped."""
    source = {"id": "id", "email": "email", "created_at": "created_at", "total_price": "total_price",
              "financial_status": "financial_status", "fulfillment_status": "fulfillment_status"}
    source |= names or {}
    c = {k: F.col(v) for k, v in source.items()}
    return df.select(
        c["id"].cast("bigint").alias("order_id"),
        F.lower(c["email"]).alias("customer_email"),
        F.to_timestamp_ntz(c["created_at"], F.lit("yyyy-MM-dd HH:mm:ss")).alias("order_date"),
        c["total_price"].cast("double").alias("revenue"),
        c["financial_status"].alias("payment_status"),
        c["fulfillment_status"].alias("fulfillment_status"),
    ).where("revenue > 0")


def add_fee(df: DataFrame, amount: str = "amount", rate: float = 0.029, name: str = "fee") -> DataFrame:
    return df.withColumn(name, F.col(amount) * rate)


def null_outliers(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """``{new column: (column, low, high)}``: NULL outside the range, raw column kept."""
    return df.withColumns({new: null_outside(c, lo, hi) for new, (c, lo, hi) in bounds.items()})


def _any_above(limits: Mapping[str, float], columns: Mapping[str, str]) -> Column:
    first, *rest = [F.col(columns.get(k, k)) > v for k, v in limits.items()]
    for term in rest:
        first = first | term
    return first


def classify_status(df: DataFrame, columns: Mapping[str, str] | None = None,
                    warning: Mapping[str, float] = WARNING_ABOVE,
                    critical: Mapping[str, float] = CRITICAL_ABOVE, name: str = "status") -> DataFrame:
    """normal / warning / critical from strict thresholds; critical wins."""
    columns = columns or {}
    return df.withColumn(name, F.when(_any_above(critical, columns), "critical")
                         .when(_any_above(warning, columns), "warning").otherwise("normal"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object],
                  into: Mapping[str, str] | None = None) -> DataFrame:
    """Replace NULLs by defaults, in place or (``into``) in a new column."""
    into = into or {}
    return df.withColumns({into.get(c, c): F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def clean_customers(df: DataFrame) -> DataFrame:
    lowered = df.withColumn("email_clean", F.lower("email"))
    return fill_defaults(lowered, {"revenue": 0.0, "country": "UNKNOWN"}, {"country": "country_clean"})


def add_column_with_default(df: DataFrame, column: str, default) -> DataFrame:
    """Create the column if absent, otherwise fill its NULLs."""
    value = F.coalesce(F.col(column), F.lit(default)) if column in df.columns else F.lit(default)
    return df.withColumn(column, value)


def add_column_as_new_type(df: DataFrame, source: str, new: str, to: str | DataType,
                           lenient: bool = False) -> DataFrame:
    """A retyped copy beside the old column. The old name may not be reused."""
    if new == source or new in df.columns:
        raise ValueError(f"column {new} exists: a type is changed by adding a column, not in place")
    return df.withColumn(new, F.col(source).try_cast(to) if lenient else F.col(source).cast(to))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def normalise_text_num(df: DataFrame, amount: str = "amount", date: str = "order_date",
                       text: str = "status") -> DataFrame:
    return df.withColumns({amount: round2(amount), date: F.col(date).cast("date"),
                           text: strip_all(F.lower(text))})


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` plans as a group limit before the shuffle, so every task
    sends at most one row per key and a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key; which one is fixed by ``order`` (all columns if not given)."""
    return keep_first(df, keys, order or [c for c in df.columns if c not in keys] or list(keys))


def keep_latest(df: DataFrame, key: str, ts: str, tie_break: str | None = None) -> DataFrame:
    order = [F.desc_nulls_last(ts)] + ([F.desc_nulls_last(tie_break)] if tie_break else [])
    return keep_first(df, [key], order)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a hash of ``keys`` and the seed.

    The same rows come out for any partitioning, and each task keeps at most ``n``.
    Filter before sampling.
    """
    tag = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(tag, *keys).limit(n)


def sensor_text(columns: Mapping[str, str] | None = None) -> Column:
    """One descriptive sentence per reading. The wording is a fixed format."""
    names = ["device_type", "sensor_id", "facility", "status", "temperature", "pressure", "vibration"]
    c = {n: F.col((columns or {}).get(n, n)).cast("string") for n in names}
    return F.concat(c["device_type"], F.lit(" sensor "), c["sensor_id"], F.lit(" at "), c["facility"],
                    F.lit(": status "), c["status"], F.lit(", temp "), c["temperature"],
                    F.lit("°C, pressure "), c["pressure"], F.lit(" PSI, vibration "), c["vibration"],
                    F.lit(" mm/s"))


def render_text(df: DataFrame, columns: Mapping[str, str] | None = None,
                name: str = "searchable_text") -> DataFrame:
    return df.withColumn(name, sensor_text(columns))


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def route_questions(df: DataFrame, question: str, name: str = "tool") -> DataFrame:
    """Choose the tool for a question by keyword. Keywords match inside words ("mean")."""
    lowered = F.lower(question)
    return df.withColumn(name, F.when(_contains_any(lowered, SEMANTIC_WORDS), "semantic_search")
                         .when(_contains_any(lowered, DOCS_WORDS), "docs").otherwise("sql"))


def search_term(question: str | Column) -> Column:
    """The question without its search phrase."""
    q = as_col(question)
    for phrase in ("similar to", "find events like"):
        q = F.replace(q, F.lit(phrase), F.lit(""))
    return strip_all(q)


def clean_events(df: DataFrame, user: str = "user_id", kind: str = "event_type", ts: str = "timestamp",
                 amount: str = "amount", allowed: Sequence[str] = tuple(EVENT_TYPES)) -> DataFrame:
    """Known users and event types only; time parsed, amount as double with 0 for NULL."""
    kept = df.where(F.col(user).isNotNull() & F.col(kind).isin(*allowed))
    return kept.withColumns({"event_ts": F.col(ts).try_cast("timestamp_ntz"),
                             amount: F.coalesce(F.col(amount).cast("double"), F.lit(0.0))})


def snapshot_inventory(df: DataFrame, quantity: str = "quantity") -> DataFrame:
    return df.where(F.col(quantity) >= 0)


def clean_trips(df: DataFrame, columns: Mapping[str, str | Column],
                distance_max: float = 100, amount_max: float = 500) -> DataFrame:
    """Reporting view over raw trips.

    ``columns`` maps pickup_time, dropoff_time, passenger_count, trip_distance,
    pickup_zone, dropoff_zone, rate_code, payment_type, fare_amount, tip_amount and
    total_amount to the source. Distances of 0 or less and values above the limits
    become NULL beside the raw value.
    """
    names = ["pickup_time", "dropoff_time", "passenger_count", "trip_distance", "pickup_zone",
             "dropoff_zone", "rate_code", "payment_type", "fare_amount", "tip_amount", "total_amount"]
    c = {n: as_col(columns.get(n, n)) for n in names}
    return (df.where((c["passenger_count"] > 0) & (c["fare_amount"] >= 0))
            .select(*[c[n].alias(n) for n in names],
                    day_of(c["pickup_time"]).alias("pickup_date"),
                    null_outside(c["trip_distance"], 0, distance_max, low_inclusive=False).alias("clean_distance"),
                    null_outside(c["total_amount"], 0, amount_max).alias("clean_amount")))


# Columns of the raw trip files under the names clean_trips gives them.
TAXI_COLUMNS = {"pickup_time": "tpep_pickup_datetime", "dropoff_time": "tpep_dropoff_datetime",
                "pickup_zone": "PULocationID", "dropoff_zone": "DOLocationID", "rate_code": "RatecodeID"}
