"""Declared table schemas: every violation of every row found in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW = "_raw"  # prefix of the columns that keep values as they were before a cast
FILTER_WORDS = 1 << 16  # 64-bit words of the filter of repeated keys: half a MiB at any size of the table


class SchemaError(ValueError):
    """Raised by ``validate``; ``failure_cases`` is the DataFrame of all violations."""

    def __init__(self, message: str, failure_cases: DataFrame | None = None):
        super().__init__(message)
        self.failure_cases = failure_cases


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy. ``dtype`` is a Spark type name such as 'bigint'."""

    dtype: str
    nullable: bool = False
    unique: bool = False
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    isin: Sequence | None = None
    regex: str | None = None

    def violations(self, c: Column) -> list[tuple[str, Column]]:
        """(check name, is violated) pairs; a NULL value violates only ``not_null``."""
        checks = [] if self.nullable else [("not_null", c.isNull())]
        if self.gt is not None:
            checks.append((f"greater_than({self.gt})", ~(c > self.gt)))
        if self.ge is not None:
            checks.append((f"greater_than_or_equal_to({self.ge})", ~(c >= self.ge)))
        if self.lt is not None:
            checks.append((f"less_than({self.lt})", ~(c < self.lt)))
        if self.le is not None:
            checks.append((f"less_than_or_equal_to({self.le})", ~(c <= self.le)))
        if self.isin is not None:
            checks.append((f"isin({list(self.isin)})", ~c.isin(*self.isin)))
        if self.regex is not None:
            checks.append((f"str_matches({self.regex})", ~c.rlike(self.regex)))
        return [(name, F.coalesce(bad, F.lit(False))) for name, bad in checks]


@dataclass(frozen=True)
class TableSchema:
    columns: dict[str, Rule]
    strict: bool = False
    coerce: bool = False

    def structure(self, df: DataFrame) -> list[str]:
        """Problems visible in the DataFrame's type alone: absent, unknown or mistyped columns."""
        types = dict(df.dtypes)
        problems = [f"column {c} missing" for c in self.columns if c not in types]
        if self.strict:
            problems += [f"column {c} not in schema" for c in types if c not in self.columns]
        if not self.coerce:
            problems += [f"column {c} is {types[c]}, expected {r.dtype}"
                         for c, r in self.columns.items() if c in types and types[c] != r.dtype]
        return problems

    def coerced(self, df: DataFrame) -> DataFrame:
        """Columns cast to the declared types; a value that cannot be cast becomes NULL."""
        if not self.coerce:
            return df
        return df.withColumns({c: F.col(c).try_cast(r.dtype) for c, r in self.columns.items() if c in df.columns})

    def _checked(self, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str, Column]], dict[str, Column]]:
        """Coerced rows, the (column, check, is violated) conditions over them, and the raw values.

        Row checks need no shuffle, and unique columns move only the rows that ``_with_repeated`` suspects.
        """
        problems = self.structure(df)
        if problems:
            raise SchemaError("; ".join(problems))
        raw = {c: F.col(f"{RAW}_{c}" if self.coerce else c) for c in self.columns}
        kept = df.withColumns({f"{RAW}_{c}": F.col(c) for c in self.columns}) if self.coerce else df
        out = self.coerced(kept)
        found: list[tuple[str, str, Column]] = []
        for c, rule in self.columns.items():
            if self.coerce:
                found.append((c, f"dtype({rule.dtype})", F.col(c).isNull() & raw[c].isNotNull()))
            for check, bad in rule.violations(F.col(c)):
                found.append((c, check, raw[c].isNull() if check == "not_null" else bad))
            if rule.unique:
                found.append((c, "unique", F.col(f"_k_{c}").isNotNull()))
        return self._with_repeated(out, [c for c, rule in self.columns.items() if rule.unique]), found, raw

    @staticmethod
    def _with_repeated(df: DataFrame, unique: Sequence[str]) -> DataFrame:
        """Adds ``_k_<column>`` per unique column: the value where other rows have it too, else NULL.

        The hashes of all unique columns are counted in one aggregation, combined on the map side. Those that repeat set the
        bits of a filter of fixed size. Rows that it lets through are the only ones that are shuffled; their values are
        counted exactly. A filter that fills up lets more rows through and changes no result. The rows are read once for
        the hashes and again for each part, so ``df`` has to give the same rows each time.
        """
        if not unique:
            return df
        spark, bits = df.sparkSession, 64 * FILTER_WORDS

        def hashed(c: str) -> Column:
            return F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c)))

        hashes = df.select(F.explode(F.array(*[hashed(c) for c in unique])).alias("_h")).where("_h IS NOT NULL")
        slots = hashes.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select(F.pmod("_h", F.lit(bits)).alias("_s"))
        one = F.lit(1).cast("bigint")
        words = slots.groupBy(F.floor(F.col("_s") / 64).alias("_w")).agg(
            F.bit_or(F.call_function("shiftleft", one, (F.col("_s") % 64).cast("int"))).alias("_bits"))
        dense = spark.range(0, FILTER_WORDS, 1, 1).join(words, F.col("id") == F.col("_w"), "left")
        listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0)).alias("_bits"))))
        repeated = dense.agg(listed.getField("_bits").alias("_bits")).scalar()

        def passes(c: str) -> Column:
            slot = F.pmod(hashed(c), F.lit(bits))
            word = F.get(repeated, F.floor(slot / 64).cast("int"))
            return F.coalesce(F.call_function("shiftright", word, (slot % 64).cast("int")).bitwiseAND(one) == 1, F.lit(False))

        suspect = passes(unique[0])
        for c in unique[1:]:
            suspect = suspect | passes(c)
        suspects, clear = df.where(suspect), df.where(~suspect)
        for c in unique:
            keys = df.where(passes(c)).groupBy(F.col(c).alias(f"_k_{c}")).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
            suspects = suspects.join(keys, F.col(c) == F.col(f"_k_{c}"), "left")
        return suspects.unionByName(clear.withColumns({f"_k_{c}": F.lit(None).cast(clear.schema[c].dataType) for c in unique}))

    @staticmethod
    def _any(found: list[tuple[str, str, Column]]) -> Column:
        bad = F.lit(False)
        for _, _, condition in found:
            bad = bad | condition
        return bad

    @staticmethod
    def _listed(found: list[tuple[str, str, Column]], raw: dict[str, Column]) -> Column:
        """Array of the violated checks. Built for failing rows only."""
        cases = [F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(check).alias("check"),
                                      raw[c].cast("string").alias("value"))) for c, check, bad in found]
        return F.filter(F.array(*cases), lambda x: x.isNotNull())

    def failure_cases(self, df: DataFrame, row_key: str) -> DataFrame:
        """All violations: (row_key, column, check, value)."""
        out, found, raw = self._checked(df)
        key = raw.get(row_key, F.col(row_key)).cast("string").alias("row_key")
        return out.where(self._any(found)).select(key, F.inline(self._listed(found, raw)))

    def marked(self, df: DataFrame) -> DataFrame:
        """All rows with a ``reasons`` array, NULL for valid ones. Coerced rows keep what was read beside them."""
        out, found, raw = self._checked(df)
        reasons = F.transform(self._listed(found, raw), lambda x: F.concat_ws(":", x["column"], x["check"]))
        kept = [*df.columns, *(f"{RAW}_{c}" for c in self.columns if self.coerce)]
        return out.select(*kept, F.when(self._any(found), reasons).alias("reasons"))

    def parts(self, marked: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Valid and rejected rows of a marked table."""
        as_read = [F.col(f"{RAW}_{c}").alias(c) if self.coerce and c in self.columns else F.col(c) for c in columns]
        bad = F.col("reasons").isNotNull()  # a value that did not cast is kept among the rejected
        return marked.where(~bad).select(*columns), marked.where(bad).select(*as_read, "reasons")

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(valid rows, rejected rows with a ``reasons`` array). Together they are the input."""
        return self.parts(self.marked(df), df.columns)

    def validate(self, df: DataFrame, row_key: str) -> DataFrame:
        """The coerced frame, or ``SchemaError`` with counts per check and all failure cases."""
        cases = self.failure_cases(df, row_key)
        counts = cases.groupBy("column", "check").count().orderBy("column", "check").collect()
        if counts:
            text = ", ".join(f"{r['column']} {r['check']}: {r['count']}" for r in counts)
            raise SchemaError(f"schema validation failed: {text}", cases)
        return self.coerced(df)


# The tables the reports expect.
ORDERS = TableSchema({
    "order_id": Rule("string", unique=True),
    "customer_id": Rule("bigint"),
    "order_date": Rule("date"),
    "amount": Rule("double", gt=0, lt=1_000_000),
    "quantity": Rule("int", ge=1, le=100),
    "status": Rule("string", isin=["pending", "shipped", "delivered", "cancelled"]),
})

CLEANED_EVENTS = TableSchema({
    "user_id": Rule("bigint", ge=1),
    "event_type": Rule("string", isin=["click", "view", "purchase"]),
    "event_ts": Rule("timestamp_ntz"),
    "amount": Rule("double", ge=0.0),
}, strict=True, coerce=True)

CUSTOMERS = TableSchema({
    "customer_id": Rule("bigint", unique=True, ge=1),
    "email": Rule("string", regex=r"^[\w\.-]+@[\w\.-]+\.\w+$"),
    "name": Rule("string"),
    "updated_at": Rule("timestamp_ntz"),
})

SHOP_ORDERS = TableSchema({
    "order_id": Rule("bigint", unique=True, ge=1),
    "customer_id": Rule("bigint", ge=1),
    "total": Rule("double", ge=0.0),
    "order_date": Rule("timestamp_ntz"),
})
