"""Views, SQL functions and materialised summaries over Parquet.

Definitions live here as code: any session calls ``register_views`` and has the
warehouse, while all data stays in Parquet.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import TAXI_COLUMNS, clean_trips
from ..session import path_exists
from ..sources.readers import file_listing, scan_partitioned
from .versions import VersionStore


def register_functions(spark: SparkSession) -> None:
    """SQL functions of the warehouse; Catalyst inlines their bodies."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION trip_efficiency(distance DOUBLE, minutes DOUBLE)
                 RETURNS DOUBLE RETURN try_divide(distance, minutes) * 60""")


def register_views(spark: SparkSession, trips_root: str, summary: str | None = None,
                   columns: Mapping[str, str | Column] = TAXI_COLUMNS, **limits) -> list[str]:
    """Views trips, clean_trips and, if its files are there, daily_summary; plus the SQL functions."""
    trips = scan_partitioned(spark, trips_root)
    trips.createOrReplaceTempView("trips")
    clean_trips(trips, columns, **limits).createOrReplaceTempView("clean_trips")
    made = ["trips", "clean_trips"]
    if summary and path_exists(spark, summary):
        spark.read.parquet(summary).createOrReplaceTempView("daily_summary")
        made.append("daily_summary")
    register_functions(spark)
    return made


def materialise(store: VersionStore, name: str, df: DataFrame, message: str = "") -> DataFrame:
    """Create or replace a summary table and read it back.

    Readers keep the old version until the new one is complete.
    """
    store.commit(df, name, message)
    return store.checkout(name)


def save_table(df: DataFrame, table: str) -> DataFrame:
    """The same as a managed catalog table."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def newest_change(spark: SparkSession, paths: Sequence[str]):
    return file_listing(spark, *paths).agg(F.max("modificationTime")).first()[0]


def materialise_if_stale(spark: SparkSession, target: str, inputs: Sequence[str],
                         build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """Rebuild ``target`` only if an input file is newer; (result, was it rebuilt)."""
    if path_exists(spark, target):
        made, changed = newest_change(spark, [target]), newest_change(spark, inputs)
        if made is not None and changed is not None and made >= changed:
            return spark.read.parquet(target), False
    build().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
    return spark.read.parquet(target), True


def files_key(spark: SparkSession, paths: Sequence[str], code_version: str = "") -> str:
    """Key of the inputs' files (name, size, change time) and the code; contents are not read."""
    files = file_listing(spark, *paths)
    total = files.agg(F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")),
                                 F.lit(0)).cast("string")).first()[0]
    return hashlib.sha256(f"{total}|{code_version}".encode()).hexdigest()


def materialise_cached(store: VersionStore, name: str, inputs: Sequence[str], build: Callable[[], DataFrame],
                       ttl_seconds: float = 24 * 3600, code_version: str = "") -> tuple[DataFrame, bool]:
    """Reuse the last result if it was made from the same files and code within the time limit."""
    key = files_key(store.spark, inputs, code_version)
    oldest = time.time_ns() - int(ttl_seconds * 1e9)
    hit = (store.manifest(name).where((F.col("inputs")["key"] == key) & (F.col("seq") >= oldest))
           .orderBy(F.desc("seq")).first())
    if hit:
        return store.checkout(name, hit["snapshot"]), False
    snapshot = store.commit(build(), name, inputs={"key": key})
    return store.checkout(name, snapshot), True
