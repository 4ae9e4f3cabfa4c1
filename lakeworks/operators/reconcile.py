"""Reconciliation of two transaction feeds within a time tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cents, elapsed_seconds, seconds_of_day
from ..session import cut_lineage

# Labels of the report and names of the rules are stated where they are used below.
MATCH_KEYS = ["date", "amount_cents", "time_seconds"]


def prepare(df: DataFrame, amount: str = "amount", ts: str = "timestamp") -> DataFrame:
    """Add the match keys: whole cents, calendar date and second of the day."""
    return df.withColumns({"amount_cents": cents(amount), "date": F.col(ts).cast("date"),
                           "time_seconds": seconds_of_day(ts)})


def _slots(t: Column, tolerance: int) -> Column:
    """The one or two slots a time may meet; slots are as wide as the whole search range."""
    width = 2 * tolerance + 1
    first, last = (F.floor((t + d) / F.lit(width)).cast("int") for d in (-tolerance, tolerance))
    return F.explode(F.sequence(first, last))


def _slot(t: Column, tolerance: int) -> Column:
    return F.floor(t / F.lit(2 * tolerance + 1)).cast("int")


def match_transactions(bank: DataFrame, ledger: DataFrame, tolerance: int = 60,
                       strict: bool = False) -> DataFrame:
    """Pairs of equal date and cents whose second of day differs by at most ``tolerance``.

    A time slot joins the equality keys: a bank row has one slot, a ledger row at
    most two, so every pair is found once and rows are only compared with near
    ones even if one amount fills a day. ``strict`` compares full timestamps (also
    across midnight) and keeps pairs that are each other's nearest.
    """
    if strict:
        return _mutual_nearest(bank, ledger, tolerance)
    left = bank.select("bank_id", "amount", F.col("timestamp").alias("bank_time"), "date", "amount_cents",
                       "time_seconds", _slot(F.col("time_seconds"), tolerance).alias("slot"))
    right = ledger.select("ledger_id", F.col("timestamp").alias("ledger_time"), "date", "amount_cents",
                          F.col("time_seconds").alias("ledger_seconds"),
                          _slots(F.col("time_seconds"), tolerance).alias("slot"))
    near = F.abs(F.col("time_seconds") - F.col("ledger_seconds")) <= tolerance
    return (left.join(right, ["date", "amount_cents", "slot"]).where(near)
            .select("bank_id", "ledger_id", "amount", "bank_time", "ledger_time",
                    elapsed_seconds("bank_time", "ledger_time").alias("time_diff_seconds")))


def _nearest(df: DataFrame, other: DataFrame, own: str, far: str, tolerance: int) -> DataFrame:
    """For each row of ``df`` the nearest id of ``other`` (smallest id on ties).

    Both sides are sorted together by amount and time slot; a running last value gives
    the nearest time before, and after in the other direction. A slot is as wide as the
    tolerance, so beyond it only the last time of the slot before and the first of the
    slot after can count. The work is that of sorting, however many rows share an amount.
    """
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    reach = tolerance * 1_000_000
    slot = F.expr(f"(t - pmod(t, {reach + 1})) div {reach + 1}").alias("slot")
    # One representative per distinct time is enough to find the nearest.
    seen = (other.groupBy("amount_cents", micros.alias("t")).agg(F.min(far).alias("far"))
            .where("t IS NOT NULL AND amount_cents IS NOT NULL").select("amount_cents", "t", "far", slot))
    rows = df.select(F.col(own).alias("own"), "amount_cents", micros.alias("t"))
    rows = rows.where("t IS NOT NULL AND amount_cents IS NOT NULL").select("own", "amount_cents", "t", slot)
    both = rows.withColumn("side", F.lit(1)).unionByName(seen.withColumn("side", F.lit(0)), allowMissingColumns=True)
    place = F.when(F.col("side") == 0, F.struct("t", "far"))

    def running(*order) -> Column:
        return F.last(place, ignorenulls=True).over(
            Window.partitionBy("amount_cents", "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))

    inside = both.withColumn("before", running("t", "side")).withColumn("after", running(F.desc("t"), "side")).where("side = 1")
    ends = seen.groupBy("amount_cents", "slot").agg(F.min(F.struct("t", "far")).alias("first"), F.max(F.struct("t", "far")).alias("last"))
    earlier = ends.select("amount_cents", (F.col("slot") + 1).alias("slot"), F.col("last").alias("earlier"))
    later = ends.select("amount_cents", (F.col("slot") - 1).alias("slot"), F.col("first").alias("later"))
    met = inside.join(earlier, ["amount_cents", "slot"], "left").join(later, ["amount_cents", "slot"], "left")
    gaps = [F.when(F.abs(F.col(f"{c}.t") - F.col("t")) <= reach,
                   F.struct(F.abs(F.col(f"{c}.t") - F.col("t")).alias("gap"), F.col(f"{c}.far").alias("far")))
            for c in ("before", "after", "earlier", "later")]
    return (met.select(F.col("own").alias(own), F.array_min(F.array_compact(F.array(*gaps))).alias("best"))
            .where("best IS NOT NULL").groupBy(own).agg(F.min("best").alias("best")).select(own, F.col("best.far").alias(far)))


def _mutual_nearest(bank: DataFrame, ledger: DataFrame, tolerance: int) -> DataFrame:
    forward = _nearest(bank, ledger, "bank_id", "ledger_id", tolerance)
    back = _nearest(ledger, bank, "ledger_id", "bank_id", tolerance)
    pairs = forward.join(back, ["bank_id", "ledger_id"])
    b = bank.select("bank_id", "amount", F.col("timestamp").alias("bank_time"))
    r = ledger.select("ledger_id", F.col("timestamp").alias("ledger_time"))
    return (pairs.join(b, "bank_id").join(r, "ledger_id")
            .select("bank_id", "ledger_id", "amount", "bank_time", "ledger_time",
                    elapsed_seconds("bank_time", "ledger_time").alias("time_diff_seconds")))


def find_unmatched(df: DataFrame, matches: DataFrame, id_col: str, status: str) -> DataFrame:
    """Rows whose id is in no match, without the match keys, labelled with ``status``."""
    found = matches.select(id_col).distinct()
    return df.join(found, id_col, "left_anti").drop(*MATCH_KEYS).withColumn("status", F.lit(status))


def unmatched(df: DataFrame, other: DataFrame, status: str, tolerance: int = 60) -> DataFrame:
    """The same straight from the feeds, without forming any pair (ids must be unique).

    The other side is reduced to its distinct seconds per date and amount, so a row
    is compared with at most two slots of seconds, however many transactions share them.
    """
    seconds = other.select(*MATCH_KEYS).distinct().select(
        F.col("date").alias("_d"), F.col("amount_cents").alias("_a"), F.col("time_seconds").alias("_s"),
        _slots(F.col("time_seconds"), tolerance).alias("_slot"))
    near = ((F.col("date") == F.col("_d")) & (F.col("amount_cents") == F.col("_a"))
            & (_slot(F.col("time_seconds"), tolerance) == F.col("_slot"))
            & (F.abs(F.col("time_seconds") - F.col("_s")) <= tolerance))
    return df.join(seconds, near, "left_anti").drop(*MATCH_KEYS).withColumn("status", F.lit(status))


def _exact(amount: str) -> Column:
    """Amounts to a millionth, so that sub-cent differences between the sides still count."""
    return F.col(amount).cast("decimal(28,6)")


def matched_total(df: DataFrame, matches: DataFrame, id_col: str, amount: str = "amount",
                  distinct: bool = False) -> Column:
    """Total of one side's own amounts over the matched ids, as a scalar subquery.

    A row in several matches counts once per match, or once with ``distinct``.
    """
    times = matches.groupBy(id_col).agg(F.count("*").cast("decimal(18,0)").alias("_times"))
    weight = F.lit(1).cast("decimal(18,0)") if distinct else F.col("_times")
    total = F.coalesce(F.sum(_exact(amount) * weight).cast("double"), F.lit(0.0))
    return df.join(times, id_col).agg(total).scalar()


def recon_report(bank: DataFrame, ledger: DataFrame, matches: DataFrame) -> DataFrame:
    """Matched pairs and the unmatched rows of both sides in one table, nulls last."""
    columns = ["bank_id", "ledger_id", "amount", "bank_time", "ledger_time", "time_diff_seconds", "status"]

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in columns if c in df.columns])

    matched = shaped(matches.withColumns({"status": F.lit("MATCHED"), "amount": F.col("amount").cast("double"),
                                          "time_diff_seconds": F.col("time_diff_seconds").cast("double")}))
    left = shaped(find_unmatched(bank, matches, "bank_id", "UNMATCHED_BANK")
                  .withColumnRenamed("timestamp", "bank_time"))
    right = shaped(find_unmatched(ledger, matches, "ledger_id", "UNMATCHED_LEDGER")
                   .withColumnRenamed("timestamp", "ledger_time"))
    union = (matched.unionByName(left, allowMissingColumns=True)
             .unionByName(right, allowMissingColumns=True))
    return union.select(*columns).orderBy(F.asc_nulls_last("bank_time"), F.asc_nulls_last("ledger_time"))


def measure_matches(bank: DataFrame, ledger: DataFrame, matches: DataFrame) -> DataFrame:
    """What the rules need, in one row, from given matches."""
    dups = matches.groupBy("bank_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1)).scalar()
    return matches.agg(
        matched_total(bank, matches, "bank_id").alias("bank_total"),
        matched_total(ledger, matches, "ledger_id").alias("ledger_total"), dups.alias("duplicates"),
        F.count("*").alias("pairs"), bank.agg(F.count("*")).scalar().alias("bank_rows"),
        F.coalesce(F.max(F.abs("time_diff_seconds")), F.lit(0)).cast("bigint").alias("max_seconds"))


def _per_second(df: DataFrame, side: str) -> DataFrame:
    return df.groupBy(*MATCH_KEYS).agg(
        F.count("*").alias(f"{side}_n"), F.sum(_exact("amount")).alias(f"{side}_total"),
        F.min("timestamp").alias(f"{side}_min"), F.max("timestamp").alias(f"{side}_max"))


def measure_feeds(bank: DataFrame, ledger: DataFrame, tolerance: int = 60) -> DataFrame:
    """The same row straight from the feeds, counting pairs instead of forming them.

    Both sides are first reduced to one row per date, amount and second. A second
    meets at most ``2 * tolerance + 1`` others, so the work is linear in the number
    of seconds even if one amount or one minute holds a third of all rows.
    """
    left = _per_second(bank, "b").withColumn("slot", _slot(F.col("time_seconds"), tolerance))
    right = (_per_second(ledger, "l").withColumn("slot", _slots(F.col("time_seconds"), tolerance))
             .withColumnRenamed("time_seconds", "l_seconds"))
    met = (left.join(right, ["date", "amount_cents", "slot"])
           .where(F.abs(F.col("time_seconds") - F.col("l_seconds")) <= tolerance))
    widest = F.greatest(F.abs(elapsed_seconds("b_max", "l_min")), F.abs(elapsed_seconds("l_max", "b_min")))

    def times(total: Column, n: Column) -> Column:
        return total * n.cast("decimal(18,0)")

    per = met.groupBy("date", "amount_cents", "time_seconds").agg(
        F.max("b_n").alias("b_n"), F.max("b_total").alias("b_total"), F.sum("l_n").alias("m"),
        F.sum("l_total").alias("l_total"), F.max(widest).alias("w"))
    return per.agg(
        F.coalesce(F.sum(times(F.col("b_total"), F.col("m"))).cast("double"), F.lit(0.0)).alias("bank_total"),
        F.coalesce(F.sum(times(F.col("l_total"), F.col("b_n"))).cast("double"), F.lit(0.0)).alias("ledger_total"),
        F.coalesce(F.sum(F.when(F.col("m") > 1, F.col("b_n"))), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.col("b_n") * F.col("m")), F.lit(0)).alias("pairs"),
        bank.agg(F.count("*")).scalar().alias("bank_rows"),
        F.coalesce(F.max("w"), F.lit(0)).cast("bigint").alias("max_seconds"))


def match_runs(bank: DataFrame, ledger: DataFrame, tolerance: int = 60) -> DataFrame:
    """The same matches as runs, without forming a pair: a row per side, date, amount and second.

    (side, *keys, rows, partners, first_second, last_second, ...): every one of ``rows`` rows of this second
    matches all ``partners`` rows of the other side between the first and the last second. Both feeds are reduced to their seconds and
    sorted together; a range frame of the tolerance sweeps over them. A date and amount has at most 86,400 seconds, so
    the frame's partitions are bounded however many rows share an amount.
    """
    seconds = _per_second(bank, "b").unionByName(_per_second(ledger, "l"), allowMissingColumns=True)
    seconds = seconds.where(F.col("date").isNotNull() & F.col("amount_cents").isNotNull())
    reach = Window.partitionBy("date", "amount_cents").orderBy("time_seconds").rangeBetween(-tolerance, tolerance)
    swept = seconds.select("*", *(
        f.over(reach).alias(f"{side}_{name}") for side in "bl" for name, f in (
            ("all", F.sum(f"{side}_n")), ("sum", F.sum(f"{side}_total")), ("low", F.min(f"{side}_min")), ("high", F.max(f"{side}_max")),
            ("first", F.min(F.when(F.col(f"{side}_n").isNotNull(), F.col("time_seconds")))),
            ("last", F.max(F.when(F.col(f"{side}_n").isNotNull(), F.col("time_seconds")))))))

    def half(own: str, other: str, name: str) -> DataFrame:
        widest = F.greatest(F.abs(elapsed_seconds(f"{own}_max", f"{other}_low")), F.abs(elapsed_seconds(f"{other}_high", f"{own}_min")))
        return swept.where(F.col(f"{own}_n").isNotNull()).select(
            F.lit(name).alias("side"), *MATCH_KEYS, F.col(f"{own}_n").alias("rows"), F.coalesce(f"{other}_all", F.lit(0)).alias("partners"),
            F.col(f"{other}_first").alias("first_second"), F.col(f"{other}_last").alias("last_second"),
            F.col(f"{own}_total").alias("total"), F.col(f"{other}_sum").alias("partner_total"), widest.alias("widest"))

    return half("b", "l", "bank").unionByName(half("l", "b", "ledger"))


def expand_runs(runs: DataFrame, bank: DataFrame, ledger: DataFrame) -> DataFrame:
    """The pairs of the runs, as ``match_transactions`` lists them. Only this step is as large as the number of pairs."""
    reached = runs.where("side = 'bank' AND partners > 0").select(
        *MATCH_KEYS, F.explode(F.sequence("first_second", "last_second")).alias("ledger_seconds"))
    left = bank.select("bank_id", "amount", F.col("timestamp").alias("bank_time"), *MATCH_KEYS)
    right = ledger.select("ledger_id", F.col("timestamp").alias("ledger_time"), "date", "amount_cents", F.col("time_seconds").alias("ledger_seconds"))
    return (reached.join(right, ["date", "amount_cents", "ledger_seconds"]).join(left, MATCH_KEYS)
            .select("bank_id", "ledger_id", "amount", "bank_time", "ledger_time",
                    elapsed_seconds("bank_time", "ledger_time").alias("time_diff_seconds")))


def run_report(bank: DataFrame, ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """One line per transaction of either feed: its status, and for matched ones how many partners stand between which seconds.

    Grouped by transaction, ``recon_report`` says the same; this has as many lines as the feeds, however many pairs there are.
    """
    def half(df: DataFrame, side: str, lost: str) -> DataFrame:
        own = runs.where(F.col("side") == side).select(*MATCH_KEYS, "partners", "first_second", "last_second")
        status = F.when(F.col("partners") > 0, F.lit("MATCHED")).otherwise(F.lit(lost))
        return df.join(own, MATCH_KEYS, "left").select(
            F.lit(side).alias("side"), F.col(f"{side}_id").alias("id"), F.col("amount").cast("double").alias("amount"), F.col("timestamp").alias("time"),
            status.alias("status"), F.coalesce("partners", F.lit(0)).alias("partners"), "first_second", "last_second")

    return half(bank, "bank", "UNMATCHED_BANK").unionByName(half(ledger, "ledger", "UNMATCHED_LEDGER"))


def measure_runs(bank: DataFrame, runs: DataFrame) -> DataFrame:
    """What the rules need, in one row, from runs."""
    met = runs.where("side = 'bank' AND partners > 0")

    def total(amount: str, n: str) -> Column:
        return F.coalesce(F.sum(F.col(amount) * F.col(n).cast("decimal(18,0)")).cast("double"), F.lit(0.0))

    return met.agg(
        total("total", "partners").alias("bank_total"), total("partner_total", "rows").alias("ledger_total"),
        F.coalesce(F.sum(F.when(F.col("partners") > 1, F.col("rows"))), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.col("rows") * F.col("partners")), F.lit(0)).alias("pairs"),
        bank.agg(F.count("*")).scalar().alias("bank_rows"), F.coalesce(F.max("widest"), F.lit(0)).cast("bigint").alias("max_seconds"))


def recon_rules(measured: DataFrame, max_total_diff: float = 0.01, min_rate: float = 0.80,
                max_seconds: int = 300, run_timestamp=None) -> DataFrame:
    """(rule, passed, message) for the four acceptance rules, from one row of measures."""
    rate = F.coalesce(F.try_divide(F.col("pairs").cast("double"), F.col("bank_rows").cast("double")), F.lit(0.0))

    def rule(name: str, passed: Column, message: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), passed.alias("passed"), message.alias("message"))

    once = F.col("duplicates") == 0
    rules = measured.select(F.inline(F.array(
        rule("Matched totals equal", F.abs(F.col("bank_total") - F.col("ledger_total")) < max_total_diff,
             F.format_string("Bank: $%.2f | Ledger: $%.2f", "bank_total", "ledger_total")),
        rule("No duplicate bank matches", once,
             F.when(once, "OK").otherwise(F.format_string("Found %d duplicates", "duplicates"))),
        rule(f"Match rate >= {min_rate:.0%}", rate >= min_rate,
             F.format_string("%.1f%% (%d/%d)", rate * 100, "pairs", "bank_rows")),
        rule(f"Time differences <= {max_seconds // 60}min", F.col("max_seconds") <= max_seconds,
             F.format_string("Max: %ds", "max_seconds")))))
    return rules if run_timestamp is None else rules.withColumn(
        "run_timestamp", F.lit(run_timestamp).cast("timestamp_ntz"))


def match_by_month(bank: DataFrame, ledger: DataFrame, path: str, tolerance: int = 60) -> DataFrame:
    """The full report written as one directory per month, then read back.

    The match keys already contain the date, so no loop over months is needed:
    Spark bounds memory by partition. Matches are stored once and read by all parts of the report. A run
    replaces the whole report, so months that no longer have rows go.
    """
    matches = cut_lineage(match_transactions(bank, ledger, tolerance), "matches")
    report = recon_report(bank, ledger, matches)
    month = F.date_format(F.coalesce("bank_time", "ledger_time"), "yyyy-MM")
    (report.withColumn("month", month).hint("rebalance", "month").sortWithinPartitions("month", "bank_time")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(path))
    return bank.sparkSession.read.schema(report.schema.add("month", "string")).parquet(path)
