"""Dataset versions: immutable snapshots, references, diffs.

A store is a folder of plain Parquet. A snapshot is written first; the row that
makes it visible is appended last, so a job that dies half-way publishes nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

MANIFEST = ("name string, snapshot string, message string, metadata map<string,string>, "
            "inputs map<string,string>, row_count bigint, content_hash string, schema string, seq bigint")
REFS = "name string, ref string, snapshot string, seq bigint"
DIGESTS = "name string, path string, length bigint, modified timestamp, high bigint, middle bigint, low bigint, row_count bigint"


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of a row. The hash function skips NULLs, so each column goes in with its name and whether it is NULL."""
    return F.xxhash64(*[part for c in sorted(columns) for part in (F.lit(c), F.col(c).isNull(), F.col(c))])


def hash_pieces(columns: Sequence[str]) -> list[Column]:
    """The 64 bits of the row hash in three pieces. A sum of one is a bigint that cannot overflow below 2^41 rows."""
    h = row_hash(columns)
    low = F.lit((1 << 21) - 1).cast("bigint")
    return [F.shiftright(h, 42), F.shiftright(h, 21).bitwiseAND(low), h.bitwiseAND(low)]


def content_hash(columns: Sequence[str]) -> Column:
    """Order-independent hash of all rows: sums of its pieces, so partitioning does not matter and generated code does it."""
    pieces = hash_pieces(columns)
    return F.concat_ws("-", *[F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in pieces])


def fingerprint(df: DataFrame) -> DataFrame:
    """(row_count, content_hash) in one pass."""
    return df.agg(F.count("*").alias("row_count"), content_hash(df.columns).alias("content_hash"))


def diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed from ``a`` to ``b``.

    Both sides are tagged, united and grouped once by key. Rows are compared by
    hash, repeated keys by count and sum of hashes.
    """
    keys = list(keys)
    columns = sorted(set(a.columns) | set(b.columns))
    same = [c for c in columns if c in a.columns and c in b.columns]
    if len(same) < len(columns):
        a, b = (d.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in d.columns])
                for d in (a, b))

    def side(df: DataFrame, in_b: int) -> DataFrame:
        return df.select(*keys, F.lit(in_b).alias("_b"), row_hash(columns).alias("_h"))

    both = side(a, 0).unionByName(side(b, 1))
    of_a, of_b = F.col("_b") == 0, F.col("_b") == 1
    # The hash is summed in halves with opposite signs for the two sides: equal contents give 0.
    sign = F.when(of_a, 1).otherwise(-1)
    high, low = F.shiftright("_h", 32), F.col("_h").bitwiseAND(F.lit((1 << 32) - 1).cast("bigint"))
    grouped = both.groupBy(*keys).agg(
        F.count_if(of_a).alias("na"), F.count_if(of_b).alias("nb"),
        F.sum(sign * high).alias("high"), F.sum(sign * low).alias("low"))
    change = (F.when(F.col("na") == 0, "added").when(F.col("nb") == 0, "removed")
              .when((F.col("na") != F.col("nb")) | (F.col("high") != 0) | (F.col("low") != 0), "changed"))
    return grouped.select(*keys, change.alias("change")).where("change IS NOT NULL")


class VersionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- tables of the store ---

    def _append(self, table: str, schema: str, row: tuple) -> None:
        (self.spark.createDataFrame([row], schema).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/{table}"))

    def _read(self, table: str, schema: str) -> DataFrame:
        path = f"{self.root}/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def manifest(self, name: str | None = None) -> DataFrame:
        rows = self._read("manifest", MANIFEST)
        return rows if name is None else rows.where(F.col("name") == name)

    def refs(self, name: str) -> DataFrame:
        """The current snapshot of each branch and tag."""
        return (self._read("refs", REFS).where(F.col("name") == name).groupBy("ref")
                .agg(F.max_by("snapshot", "seq").alias("snapshot")))

    def path(self, name: str, snapshot: str) -> str:
        return f"{self.root}/data/{name}/snapshot={snapshot}"

    # --- commands ---

    def commit(self, df: DataFrame, name: str, message: str = "", metadata: Mapping[str, str] | None = None,
               branch: str | None = "main", inputs: Mapping[str, str] | None = None) -> str:
        """Store an immutable snapshot; count and hash are taken while it is written."""
        snapshot = uuid.uuid4().hex
        watch = Observation(f"commit-{snapshot}")
        (df.observe(watch, F.count("*").alias("row_count"), content_hash(df.columns).alias("content_hash"))
         .write.mode("errorifexists").parquet(self.path(name, snapshot)))
        seen = watch.get
        self._append("manifest", MANIFEST, (
            name, snapshot, message, dict(metadata or {}), dict(inputs or {}), seen["row_count"],
            seen["content_hash"], df.schema.json(), time.time_ns()))
        if branch:
            self.point(name, branch, snapshot)
        return snapshot

    def point(self, name: str, ref: str, snapshot: str) -> None:
        """Move a branch, or set a tag, to a snapshot."""
        self._append("refs", REFS, (name, ref, snapshot, time.time_ns()))

    def tag(self, name: str, tag: str, ref: str = "main") -> None:
        self.point(name, tag, self.resolve(name, ref))

    def branch(self, name: str, new: str, source: str = "main") -> None:
        self.point(name, new, self.resolve(name, source))

    def resolve(self, name: str, ref: str) -> str:
        """Snapshot id of a branch, tag or id."""
        row = self.refs(name).where(F.col("ref") == ref).first()
        if row:
            return row["snapshot"]
        if self.manifest(name).where(F.col("snapshot") == ref).limit(1).count():
            return ref
        raise KeyError(f"{name} has no version {ref}")

    def checkout(self, name: str, ref: str = "main") -> DataFrame:
        """The rows of exactly this version."""
        return self.spark.read.parquet(self.path(name, self.resolve(name, ref)))

    def merge(self, name: str, branch: str, into: str = "main") -> str:
        snapshot = self.resolve(name, branch)
        self.point(name, into, snapshot)
        return snapshot

    def write_audit_publish(self, df: DataFrame, name: str, checks: Mapping[str, Column], branch: str = "staged",
                            message: str = "", metadata: Mapping[str, str] | None = None) -> str:
        """Commit to a branch, check the stored rows, then move main. A failed check leaves main as it was."""
        snapshot = self.commit(df, name, message, metadata, branch=branch)
        names = list(checks)
        row = self.checkout(name, snapshot).agg(
            *[F.coalesce(checks[c], F.lit(False)).alias(f"c{i}") for i, c in enumerate(names)]).first()
        failed = [c for i, c in enumerate(names) if not row[f"c{i}"]]
        if failed:
            raise ValueError(f"{name}: {branch} not merged, failed checks: {failed}")
        return self.merge(name, branch)

    # --- stage locks ---

    def input_hashes(self, inputs: Mapping[str, DataFrame]) -> dict[str, str]:
        return {n: fingerprint(df).first()["content_hash"] for n, df in inputs.items()}

    def file_digests(self, folder: str) -> DataFrame:
        """``path, length, modified, high, middle, low, row_count`` of every Parquet file below a folder.

        Digests are stored per file. A file whose length and time are those of its stored digest is not read; the others are
        hashed in one job, grouped by file, and their digests stored for the next run. Files that are gone drop out. A file
        without rows has sums of zero.
        """
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
        listed = listed.select("path", "length", F.col("modificationTime").alias("modified"))
        known = self._read("digests", DIGESTS).where(F.col("name") == folder).drop("name")
        same = ["path", "length", "modified"]
        changed = [r["path"] for r in listed.join(known, same, "left_anti").select("path").collect()]  # names of new files only
        if changed:
            rows = self.spark.read.parquet(*changed)
            sums = {n: F.sum(p).alias(n) for n, p in zip(("high", "middle", "low"), hash_pieces(rows.columns))}
            hashed = rows.groupBy(F.col("_metadata.file_path").alias("_path")).agg(*sums.values(), F.count("*").alias("row_count"))
            new = listed.where(F.col("path").isin(changed)).join(hashed, F.col("path") == F.regexp_replace("_path", "^file:/+", "file:/"), "left")
            counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("high", "middle", "low", "row_count")]
            new.select(F.lit(folder).alias("name"), *same, *counts).write.mode("append").parquet(f"{self.root}/digests")
            known = self._read("digests", DIGESTS).where(F.col("name") == folder).drop("name")
        return known.join(listed, same, "left_semi").dropDuplicates(same)

    def folder_hash(self, folder: str) -> str:
        """The ``content_hash`` of all rows below a folder, from the digests of its files; only changed files are read."""
        row = self.file_digests(folder).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("high", "middle", "low")]).first()
        return "-".join(str(x) for x in row)

    def run_stage_on_files(self, stage: str, folders: Mapping[str, str], build, code_version: str = "") -> tuple[DataFrame, bool]:
        """``run_stage`` for inputs that are folders of Parquet files: unchanged files are not read to find that out."""
        now = {n: self.folder_hash(f) for n, f in folders.items()} | {"code": code_version}
        return self._rebuilt(stage, now, lambda: build(**{n: self.spark.read.parquet(f) for n, f in folders.items()}))

    def run_stage(self, stage: str, inputs: Mapping[str, DataFrame], build, code_version: str = "") -> tuple[DataFrame, bool]:
        """Rebuild ``stage`` only if an input's contents or the code changed; (result, was it rebuilt)."""
        now = self.input_hashes(inputs) | {"code": code_version}
        return self._rebuilt(stage, now, lambda: build(**inputs))

    def _rebuilt(self, stage: str, now: dict[str, str], build) -> tuple[DataFrame, bool]:
        last = self.manifest(stage).orderBy(F.desc("seq")).first()
        if last and last["inputs"] == now:
            return self.checkout(stage, last["snapshot"]), False
        snapshot = self.commit(build(), stage, inputs=now)
        return self.checkout(stage, snapshot), True
