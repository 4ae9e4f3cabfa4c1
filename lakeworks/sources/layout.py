"""Partitioned layouts, and reports on the files they leave.

Writers use the ``rebalance`` hint: rows meet by partition key so that each
directory gets few files, while AQE splits a key that holds far more than its
share (one hot month or category) over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_range
from .readers import file_listing


def _write_partitioned(df: DataFrame, path: str, keys: Sequence[str], sort: Sequence[str],
                       codec: str, mode: str, only_touched: bool = False) -> None:
    """An overwrite replaces the whole folder, whatever the session's setting is, or
    with ``only_touched`` just the partitions that get rows."""
    laid_out = df.hint("rebalance", *keys).sortWithinPartitions(*keys, *sort)
    (laid_out.write.mode(mode).option("compression", codec)
     .option("partitionOverwriteMode", "dynamic" if only_touched else "static").partitionBy(*keys).parquet(path))


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def write_by_date(df: DataFrame, path: str, ts: str, codec: str = "zstd",
                  mode: str = "overwrite") -> None:
    """year=/month= tree, sorted by time inside each file for tight statistics."""
    _write_partitioned(with_date_parts(df, ts), path, ["year", "month"], [ts], codec, mode)


def write_by_date_and_category(df: DataFrame, path: str, ts: str, category: str,
                               codec: str = "zstd", mode: str = "overwrite") -> None:
    parts = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    _write_partitioned(parts, path, ["year", "month", category], [ts], codec, mode)


def write_by_month_date(df: DataFrame, path: str, ts: str, year: int, key: str = "pickup_month",
                        codec: str = "zstd", mode: str = "overwrite") -> None:
    """One DATE-valued directory per month of the expected year; stray years are left out."""
    kept = df.where(date_range(ts, f"{year}-01-01", f"{year + 1}-01-01"))
    keyed = kept.withColumn(key, F.trunc(F.col(ts).cast("date"), "month"))
    _write_partitioned(keyed, path, [key], [ts], codec, mode)


def write_by_month(df: DataFrame, path: str, ts: str, key: str = "month", codec: str = "zstd", mode: str = "overwrite") -> None:
    """One directory per month, named yyyy-MM, so that a calendar table can pick the months of a query."""
    _write_partitioned(df.withColumn(key, F.date_format(ts, "yyyy-MM")), path, [key], [ts], codec, mode)


def write_hash_buckets(df: DataFrame, path: str, key: str, buckets: int = 16,
                       codec: str = "zstd", mode: str = "overwrite") -> None:
    """hash(key) modulo ``buckets`` directories for a key of many values."""
    keyed = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    _write_partitioned(keyed, path, ["bucket"], [key], codec, mode)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite", path: str | None = None) -> None:
    """Catalog table bucketed on ``key``: later joins and groupings on it need no shuffle. A bucket is one task's and one file."""
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucket_count(spark: SparkSession, *roots: str, least: int = 8, bucket_bytes: int = 16 << 20) -> int:
    """Buckets for a table stored under ``roots``: as many as keep a bucket about the same size, however large the table."""
    total = file_listing(spark, *roots).agg(F.sum("length")).first()[0] or 0
    return max(least, -(-total // bucket_bytes))


def write_single(df: DataFrame, path: str, codec: str = "zstd", mode: str = "overwrite") -> None:
    """One file for a small dimension.

    Partitions are merged by size while the job runs, so a table that turns out large
    is written as several files of the session's advisory size by several tasks.
    """
    df.hint("rebalance").write.mode(mode).option("compression", codec).parquet(path)


def sorted_write(df: DataFrame, path: str, sort: Sequence[str], codec: str = "zstd",
                 mode: str = "overwrite") -> None:
    """Range-partition and sort, so files hold disjoint ranges of the sort columns.

    A hash of the row is the last range key: rows that share one sort value may
    spread over several files instead of filling one.
    """
    plain = [c for c, t in df.dtypes if not t.startswith("map")]
    laid_out = df.repartitionByRange(*sort, F.xxhash64(*plain)).sortWithinPartitions(*sort)
    laid_out.write.mode(mode).option("compression", codec).parquet(path)


def partition_report(spark: SparkSession, root: str, low_mb: float = 100, high_mb: float = 500) -> DataFrame:
    """Size of every file, largest first, judged against the target range."""
    size = F.col("length") / F.lit(1_000_000.0)
    return (file_listing(spark, root).where(F.col("path").endswith(".parquet"))
            .select(F.element_at(F.split("path", f"{root.rstrip('/')}/"), -1).alias("path"),
                    F.round(size, 2).alias("size_mb"),
                    F.when(size < low_mb, "small").when(size > high_mb, "large")
                    .otherwise("ok").alias("verdict"))
            .orderBy(F.desc("size_mb"), "path"))


_FOOTER = ("path string, num_rows bigint, row_groups int, file_bytes bigint, "
           "compressed_bytes bigint, uncompressed_bytes bigint")


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        rows = []
        for path, length in zip(batch["path"], batch["length"]):
            plain = path.replace("file:///", "/").replace("file:/", "/").replace("s3a://", "s3://")
            store, inner = fs.FileSystem.from_uri(plain)
            meta = pq.read_metadata(inner, filesystem=store)
            columns = [meta.row_group(g).column(c) for g in range(meta.num_row_groups)
                       for c in range(meta.num_columns)]
            rows.append((path, meta.num_rows, meta.num_row_groups, length,
                         sum(c.total_compressed_size for c in columns),
                         sum(c.total_uncompressed_size for c in columns)))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FOOTER.split(", ")])


def footer_report(spark: SparkSession, *roots: str) -> DataFrame:
    """Rows, row groups and sizes per Parquet file, from footers read on the executors."""
    files = file_listing(spark, *roots).where(F.col("path").endswith(".parquet"))
    spread = files.select("path", "length").repartition("path")
    return (spread.mapInPandas(_read_footers, _FOOTER)
            .withColumn("ratio", F.try_divide(F.col("uncompressed_bytes").cast("double"),
                                              F.col("compressed_bytes").cast("double"))))


def footer_totals(spark: SparkSession, *roots: str) -> DataFrame:
    return footer_report(spark, *roots).agg(
        F.count("*").alias("files"), F.sum("num_rows").alias("num_rows"),
        F.sum("row_groups").alias("row_groups"),
        F.sum("compressed_bytes").alias("compressed_bytes"),
        F.sum("uncompressed_bytes").alias("uncompressed_bytes"))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, for checks on pushed filters and join kinds."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()
