"""Sinks: Parquet, CSV, JSON, raw landing, compaction, export."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import scan_csv, scan_parquet


def write_parquet(df: DataFrame, path: str, codec: str = "zstd", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", gzip: bool = False,
              mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode).option("header", True).option("sep", delimiter)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_json(df: DataFrame, path: str, gzip: bool = False, mode: str = "errorifexists") -> None:
    """One object per line, the form Spark can split on reading."""
    writer = df.write.mode(mode)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.json(path)


def land_raw(df: DataFrame, root: str, ingest_ts: str, fmt: str = "csv") -> str:
    """Write one immutable drop to ``root/ingest_ts=...``; an existing drop is never replaced."""
    path = f"{root}/ingest_ts={ingest_ts}"
    {"csv": lambda: write_csv(df, path, gzip=True),
     "json": lambda: write_json(df, path, gzip=True),
     "parquet": lambda: write_parquet(df, path)}[fmt]()
    return path


def convert_csv_to_parquet(spark: SparkSession, source: str, target: str, schema: str,
                           amount: str | Column) -> DataFrame:
    """Convert once, then report row count and amount total of both copies side by side."""
    write_parquet(scan_csv(spark, source, schema=schema), target)
    return compare_copies({"csv": scan_csv(spark, source, schema=schema),
                           "parquet": scan_parquet(spark, target)}, amount)


def compare_copies(copies: Mapping[str, DataFrame], amount: str) -> DataFrame:
    from ..functions import money_sum

    rows = [df.agg(F.lit(name).alias("format"), F.count("*").alias("row_count"),
                   money_sum(amount).alias("total")) for name, df in copies.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def compact(spark: SparkSession, paths: Iterable[str], target: str, codec: str = "zstd") -> None:
    """Merge many small files. AQE sizes the output files, so no count has to be guessed."""
    write_parquet(spark.read.parquet(*paths).hint("rebalance"), target, codec)


def export_tables(spark: SparkSession, tables: Iterable[str], target: str, fmt: str = "parquet",
                  jdbc: Mapping[str, str] | None = None) -> list[str]:
    """Copy the named catalog tables or views to a folder (or a JDBC store); skip missing ones."""
    done = []
    for name in tables:
        if not spark.catalog.tableExists(name):
            continue
        df, leaf = spark.table(name), name.split(".")[-1]
        if jdbc:
            df.write.format("jdbc").options(**jdbc).option("dbtable", leaf).mode("overwrite").save()
        elif fmt == "csv":
            write_csv(df, f"{target}/{leaf}", mode="overwrite")
        else:
            write_parquet(df, f"{target}/{leaf}", mode="overwrite")
        done.append(name)
    return done
