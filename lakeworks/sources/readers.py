"""Scans: Parquet, partitioned trees, merged schemas, CSV, JSON, inline dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def scan_parquet(spark: SparkSession, *paths: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet files, globs or a list of them; unread columns never leave storage."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def scan_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """A ``key=value`` directory tree; the keys become columns and prune directories."""
    return spark.read.parquet(root)


def scan_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files written with different columns, united by name; absent columns are NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """The same for frames that are already read."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_csv(spark: SparkSession, *paths: str, schema: StructType | str, delimiter: str = ",",
             timestamp_format: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header line and a declared schema (no inference pass over the data)."""
    reader = spark.read.schema(schema).option("header", True).option("sep", delimiter).option("mode", mode)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(list(paths))


def scan_csv_gz(spark: SparkSession, *paths: str, schema: StructType | str,
                spread: int | None = None, **options) -> DataFrame:
    """Gzip CSV. One file is one task, so ``spread`` redistributes the rows of few big files."""
    df = scan_csv(spark, *paths, schema=schema, **options)
    return df.repartition(spread) if spread else df


def scan_json_array(spark: SparkSession, *paths: str, schema: StructType | str,
                    lines: bool = False) -> DataFrame:
    """JSON array documents; ``lines=True`` for one object per line, which Spark can split."""
    return (spark.read.schema(schema).option("multiLine", not lines)
            .option("mode", "FAILFAST").json(list(paths)))


def scan_json_pages(spark: SparkSession, *paths: str, field: str, item_schema: StructType) -> DataFrame:
    """Pages of a paged response, each wrapping its rows in ``field``; one output row per item."""
    wrapper = StructType().add(field, ArrayType(item_schema))
    pages = spark.read.schema(wrapper).option("multiLine", True).option("mode", "FAILFAST").json(list(paths))
    return pages.select(F.inline(field))


def inline_dim(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A dimension stated in code. It plans as a literal relation of known size."""
    fields = StructType.fromDDL(schema).fields
    args = {f"v{i}_{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    lines = ", ".join("(" + ", ".join(f":v{i}_{j}" for j in range(len(fields))) + ")" for i in range(len(rows)))
    values = spark.sql(f"SELECT * FROM VALUES {lines}", args=args)
    return values.toDF(*[f.name for f in fields]).select(
        *[F.col(f.name).cast(f.dataType) for f in fields])


def file_listing(spark: SparkSession, *roots: str) -> DataFrame:
    """(path, length, modificationTime) of every data file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(roots))
    return files.select("path", "length", "modificationTime")


def latest_landing(df: DataFrame, root: str, column: str = "ingest_ts") -> DataFrame:
    """Only the newest drop under ``root``.

    The newest name comes from the file listing, and the comparison is on the
    partition column, so older drops are pruned and never read.
    """
    newest = (file_listing(df.sparkSession, root)
              .select(F.max(F.regexp_extract("path", rf"/{column}=([^/]+)/", 1))).scalar())
    return df.where(F.col(column).cast("string") == newest)


def object_store_options(endpoint: str, access_key: str, secret_key: str,
                         tls: bool = False) -> Mapping[str, str]:
    """Session settings for an S3-compatible store; then scan ``s3a://`` paths as usual."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def scan_object_store(spark: SparkSession, uri: str, columns: Sequence[str] | None = None) -> DataFrame:
    if not uri.startswith("s3a://"):
        raise ValueError(f"expected an s3a:// address, got {uri}")
    return scan_parquet(spark, uri, columns=columns)
