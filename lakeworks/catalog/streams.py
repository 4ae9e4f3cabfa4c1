"""Streaming jobs: each drains the event files once and the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.marts import daily_conditional
from ..quality.schema import Rule, TableSchema
from ..session import new_folder
from ..streaming import jobs
from .checks import CASES_SQL, EVENTS
from .registry import query, table
from .reports import CONDITIONAL_SQL


def stream(spark, sf):
    return jobs.file_stream(spark, sf, table(spark, sf, "events").schema, pattern="events.parquet")


def raw_stream(spark, sf):
    return stream(spark, sf).select("event_id", "user_id", "event_type", F.col("ts").cast("string").alias("timestamp"),
                                    F.col("value").alias("amount"))


@query("""SELECT event_id, user_id, event_type, ts AS event_ts, value AS amount FROM events
          WHERE user_id IS NOT NULL AND event_type IN ('click', 'view', 'purchase')""")
def stream_stage(spark, sf):
    root = new_folder(spark, "stream_stage")
    jobs.incremental_stage(raw_stream(spark, sf), f"{root}/staged", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/staged").drop("timestamp")


@query(f"SELECT date, total_events, purchases, revenue, TRUE AS users_close FROM ({CONDITIONAL_SQL}) d")
def stream_daily_metrics(spark, sf):
    """All days. The users of a day are a sketch, which is held to a tenth of the exact number (at least two)."""
    root = new_folder(spark, "stream_daily")
    jobs.incremental_daily_metrics(stream(spark, sf), f"{root}/daily", f"{root}/checkpoint", ts="ts", amount="value")
    events = table(spark, sf, "events")
    days = jobs.all_days(spark.read.parquet(f"{root}/daily"), events, ts="ts", amount="value")
    exact = daily_conditional(events, "ts", "user_id", "event_type", "value").select("date", F.col("daily_active_users").alias("exact"))
    off = F.abs(F.col("daily_active_users") - F.col("exact"))
    return days.join(exact, "date").select("date", "total_events", "purchases", "revenue",
                                           (off <= F.greatest(F.lit(2.0), 0.1 * F.col("exact"))).alias("users_close"))


@query(CONDITIONAL_SQL)
def stream_recompute_days(spark, sf):
    root = new_folder(spark, "stream_days")
    jobs.recompute_days(stream(spark, sf), f"{root}/staged", f"{root}/daily", f"{root}/checkpoint",
                        lambda df: daily_conditional(df, "ts", "user_id", "event_type", "value"), ts="ts")
    return spark.read.parquet(f"{root}/daily").drop("day")


@query("""WITH g AS (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
          n AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts > p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM g),
          x AS (SELECT user_id, s, MIN(ts) AS session_start, MAX(ts) AS session_last, COUNT(*) AS events FROM n GROUP BY 1, 2)
          SELECT user_id, session_start, session_last, events FROM x""")
def stream_sessions(spark, sf):
    root = new_folder(spark, "stream_sessions")
    jobs.stream_sessions(stream(spark, sf), f"{root}/sessions", f"{root}/checkpoint")
    return jobs.all_sessions(spark.read.parquet(f"{root}/sessions"), table(spark, sf, "events"))


@query("""SELECT 'valid' AS part, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS keys FROM events
          UNION ALL SELECT 'rejected', COUNT(*), COUNT(DISTINCT event_id) FROM events WHERE event_type = 'click'
          UNION ALL SELECT 'clean', COUNT(*), COUNT(DISTINCT event_id) FROM events
          UNION ALL SELECT 'clean_rejected', 0, 0""")
def stream_gate_batches(spark, sf):
    """Every event once in a first drop, the clicks again in a second; a drop a run. And a feed with nothing to reject."""
    root = new_folder(spark, "stream_gate")
    ids = TableSchema({"event_id": Rule("bigint", unique=True)})
    events = table(spark, sf, "events").select("event_id", "event_type")
    parts = []
    for feed, drops in (("", [events, events.where("event_type = 'click'")]), ("clean_", [events])):
        for rows in drops:
            rows.select("event_id").write.mode("append").parquet(f"{root}/{feed}feed")
            source = jobs.file_stream(spark, f"{root}/{feed}feed", "event_id bigint")
            jobs.stream_quality_gate(source, ids, f"{root}/{feed}valid", f"{root}/{feed}rejected", f"{root}/{feed}checkpoint", order=["event_id"])
        halves = jobs.gate_result(spark, ids, f"{root}/{feed}valid", f"{root}/{feed}rejected", order=["event_id"])
        for part, found in zip(("valid", "rejected"), halves):
            name = (feed + part).removesuffix("_valid") if feed else part
            parts.append(found.agg(F.lit(name).alias("part"), F.count("*").alias("rows"), F.count_distinct("event_id").alias("keys")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


GATE_FEED = """feed AS (SELECT event_id, ts, event_type, user_id FROM events
    UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, event_type, user_id FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, ts - INTERVAL 1 HOUR, event_type, user_id FROM events WHERE event_type = 'view')"""


def gate_rows(spark, sf, max_files):
    """Events in drops by the day: as they are, the clicks again an hour later, the views again an hour earlier; who is first owns the id."""
    root = new_folder(spark, "stream_gate")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id")
    hour = F.expr("INTERVAL 1 HOUR")
    drops = [events, events.where("event_type = 'click'").withColumn("ts", F.col("ts") + hour),
             events.where("event_type = 'view'").withColumn("ts", F.col("ts") - hour)]
    ids = TableSchema({"event_id": Rule("bigint", unique=True)})
    for rows in drops:
        rows.write.mode("append").parquet(f"{root}/feed")
    source = jobs.file_stream(spark, f"{root}/feed", events.schema, max_files=max_files)
    jobs.stream_quality_gate(source, ids, f"{root}/valid", f"{root}/rejected", f"{root}/checkpoint", order=["ts"])
    good, bad = jobs.gate_result(spark, ids, f"{root}/valid", f"{root}/rejected", order=["ts"])
    return good.select("event_id", "ts", F.lit("valid").alias("part")).unionByName(bad.select("event_id", "ts", F.lit("rejected").alias("part")))


GATE_SQL = f"""WITH {GATE_FEED} SELECT event_id, ts, CASE WHEN ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) = 1
               THEN 'valid' ELSE 'rejected' END AS part FROM feed"""


@query(GATE_SQL)
def stream_gate_by_file(spark, sf):
    """A file a batch."""
    return gate_rows(spark, sf, 1)


@query(GATE_SQL)
def stream_gate_at_once(spark, sf):
    """All files in one batch: the same rows."""
    return gate_rows(spark, sf, 1000)


@query(f"""SELECT CASE WHEN event_id IN (SELECT event_id FROM ({CASES_SQL}) x) THEN 'rejected' ELSE 'valid' END AS part,
           COUNT(*) AS rows FROM events GROUP BY 1""")
def stream_quality_gate(spark, sf):
    root = new_folder(spark, "stream_gate")
    checked = stream(spark, sf).select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
                                       "event_type", "value", "props")
    jobs.stream_quality_gate(checked, EVENTS, f"{root}/valid", f"{root}/rejected", f"{root}/checkpoint")
    good, bad = jobs.gate_result(spark, EVENTS, f"{root}/valid", f"{root}/rejected")
    parts = [rows.groupBy(F.lit(p).alias("part")).agg(F.count("*").alias("rows")) for p, rows in (("valid", good), ("rejected", bad))]
    return parts[0].unionByName(parts[1])  # a part without rows has no group, as in SQL
