"""Intermediate tables and free column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: read often, made once, kept if executors go."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path  # noqa: SLF001  (for ``discard``)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    spark, path = df.sparkSession, df._stored_at  # noqa: SLF001
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but these: what an operator keeps beside the columns it makes itself."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]
