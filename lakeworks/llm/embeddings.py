"""Near-duplicate vectors by a pivot-permutation index.

``PIVOTS`` reference points are spread out: vectors of a sample of the data (the least
hashes) no two of which have a cosine over ``SPREAD``, and seeded random directions where
the data has too few of them. So a group of near copies, however many rows it has, holds
one pivot, and its vectors do not rank by their noise a crowd of pivots among them.

A vector is described by the ``NEAREST`` pivots closest to it, in order. All vectors with
the same nearest pivot, a cell, are compared with each other. Two vectors of different
cells meet in inverted lists, which are kept by pairs of pivots: they meet exactly when
they share at least two of their nearest pivots; a pair that shares more meets in several
lists and counts in the first one. Pairs that meet are verified by their cosine in double
precision.

Equal vectors are one entry of the index. Large cells and long lists are cut into blocks,
and every two blocks are compared in a task of their own; the many rows that a list has of
one cell are blocks of their own that do not meet each other again. What leaves a task is
one row per linked vector (how many it is linked with, and one vector it hangs together
with), never the pairs.

Within a cell nothing is lost. Between cells recall depends on ``PIVOTS`` and ``NEAREST``:
for random pairs of 64 dimensions right at a cosine of 0.9 it is 0.999 with the values
here (see the tests). More pivots shorten the lists of larger collections.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing and are their own component; vectors of different length
never link; the smallest id of a component does not count null ids; equal rows get
equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored
from .graph import components

PIVOTS = 128
NEAREST = 8
# Pivots are chosen among so many vectors, and no two chosen ones have a higher cosine than this.
SAMPLE = 2048
SPREAD = 0.5
# Rows of a block of a list, and of a cell; a task compares two blocks.
BLOCK = 512
CELL_BLOCK = 2048


def usable(vector: str) -> Column:
    """Vectors that can have a cosine."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows ** 2).sum(1, keepdims=True))


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The k pivots with the highest cosine to each row, nearest first; rows and pivots have unit length."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :k]


def _fit(pivots: np.ndarray, size: int) -> np.ndarray:
    """Pivots for vectors of another length: cut, or filled with zeros."""
    out = np.zeros((len(pivots), size))
    out[:, :min(size, pivots.shape[1])] = pivots[:, :size]
    return out


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """n points of unit length: rows of the sample in order, each apart from those before it, then random directions."""
    chosen = np.zeros((n, sample.shape[1]))
    k = 0
    for row in sample:
        if k == n:
            break
        if (chosen[:k] @ row <= SPREAD).all():
            chosen[k] = row
            k += 1
    if k < n:
        chosen[k:] = unit(np.random.default_rng(0).normal(size=(n - k, sample.shape[1])))
    return chosen


def describe(classes: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """``id, copies, size, vector, lists, cell``: the vector in bytes, the lists (pairs of pivots) it is in and its nearest pivot."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)  # at most PIVOTS vectors
    kind = np.float32 if classes.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                values = flat[(ends[rows] - size)[:, None] + np.arange(size)]
                points = _fit(shared.value, size)
                ranked = nearest_pivots(unit(values), points, k)
                near = np.sort(ranked, axis=1)
                lists = np.stack([near[:, i] * len(points) + near[:, j] for i, j in combinations(range(near.shape[1]), 2)], 1) \
                    if near.shape[1] > 1 else np.zeros((len(rows), 1), np.int64)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(rows), size, np.int32)),
                     pa.array([v.tobytes() for v in values], pa.binary()), pa.array(lists.tolist(), pa.list_(pa.int32())),
                     pa.array(ranked[:, 0].astype(np.int32))],
                    ["id", "copies", "size", "vector", "lists", "cell"])

    return classes.select("id", "copies", "embedding").mapInArrow(run, "id long, copies long, size int, vector binary, lists array<int>, cell int"), kind


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least list two rows have in common; rows of lists are sorted."""
    same = a[:, :, None] == b[:, None, :]
    return np.where(same.any(2), a, np.iinfo(np.int32).max).min(1)


def compare(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, block: np.ndarray, i: int, j: int, threshold: float,
            own: int = -1, lists: np.ndarray | None = None, cells: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked rows of a block or two, how many vectors each is linked with here, and a row it hangs together with.

    Of two blocks only pairs between them count. In a list only pairs of different cells
    count, and each in its first list only.
    """
    points = unit(vectors)
    a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
    near = points[a] @ points[b].T >= threshold
    if i == j:
        near = np.triu(near, 1)
    if lists is not None:
        near &= cells[a][:, None] != cells[b][None, :]
        left, right = np.nonzero(near)
        for start in range(0, len(left), 50_000):
            part = slice(start, start + 50_000)
            near[left[part], right[part]] = _first_shared(lists[a[left[part]]], lists[b[right[part]]]) == own
    left, right = np.nonzero(near)
    left, right = a[left], b[right]
    n = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
    root = np.arange(len(ids))
    while len(left):  # the least index spreads until it stands still
        least = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if (root == before).all():
            break
    linked = np.flatnonzero(n)
    return ids[linked], n[linked].astype(np.int64), ids[root[linked]]


def links(classes: DataFrame, threshold: float, pivots: int = PIVOTS, nearest: int = NEAREST) -> DataFrame:
    """``id, other, n``: parts of how many vectors an entry is linked with, and entries it hangs together with."""
    sample = [r["embedding"] for r in classes.orderBy(F.xxhash64("embedding")).limit(max(pivots, SAMPLE)).collect()]
    size = max(map(len, sample), default=1)
    points = np.concatenate([_fit(unit(np.array([s])), size) for s in sample]) if sample else np.zeros((0, size))
    rows, kind = describe(classes, spread_pivots(points, pivots), nearest)
    rows = stored(rows, "described")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], []]
            for r in range(batch.num_rows):
                size, own, i, j = (batch.column(c)[r].as_py() for c in range(4))
                held = batch.column(4)[r].values
                vectors = np.frombuffer(b"".join(held.field("vector").to_pylist()), kind).reshape(len(held), size)
                names = [f.name for f in held.type]
                more = (own, np.array(held.field("lists").to_pylist(), np.int32), held.field("cell").to_numpy()) if "lists" in names else ()
                out = compare(held.field("id").to_numpy(), held.field("copies").to_numpy(), vectors, held.field("block").to_numpy(), i, j,
                              threshold, *more)
                for k in range(3):
                    found[k].append(out[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(f) if f else np.zeros(0, np.int64)) for f in found], ["id", "n", "other"])

    def compared(dealt: DataFrame, key: str, *kept: str) -> DataFrame:
        pairs = dealt.groupBy("size", key, F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")).agg(
            F.collect_list(F.struct("id", "copies", "block", "vector", *kept)).alias("rows"))
        return pairs.where(F.size("rows") > 1).mapInArrow(run, "id long, n long, other long")

    return compared(_cells(rows), "cell").unionByName(compared(_lists(rows), "list", "lists", "cell"))


def _block(start: Column, blocks: Column) -> Column:
    return (start + F.pmod(F.xxhash64("id"), blocks)).cast("int")


def _cells(rows: DataFrame) -> DataFrame:
    """Rows with their block of the cell, once for every block they are compared ``with``."""
    large = (rows.groupBy("size", "cell").agg(F.count("*").alias("m")).where(F.col("m") > CELL_BLOCK)
             .select("size", "cell", F.ceil(F.col("m") / CELL_BLOCK).cast("int").alias("blocks")))
    rows = rows.drop("lists").join(large, ["size", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", _block(F.lit(0), F.col("blocks")))
    return rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def _lists(rows: DataFrame) -> DataFrame:
    """The same for the lists a row is in. Many rows of one cell are blocks of their own, which are not compared among themselves."""
    rows = rows.select("*", F.explode("lists").alias("list"))
    m, whole = F.col("m"), Window.partitionBy("size", "list")
    many = m > BLOCK
    parts = rows.groupBy("size", "list", "cell").agg(F.count("*").alias("m"))
    parts = parts.withColumn("total", F.sum(m).over(whole)).where(F.col("total") > BLOCK)
    parts = (parts.withColumn("own", F.when(many, F.ceil(m / BLOCK)).otherwise(0))
             .withColumn("shared", F.ceil(F.coalesce(F.sum(F.when(~many, m)).over(whole), F.lit(0)) / BLOCK))
             .withColumn("until", F.sum("own").over(whole.orderBy("cell"))).withColumn("all", F.sum("own").over(whole) + F.col("shared")))
    parts = parts.select("size", "list", "cell", F.when(many, F.col("shared") + F.col("until") - F.col("own")).otherwise(0).cast("int").alias("start"),
                         F.when(many, F.col("own")).otherwise(F.col("shared")).cast("int").alias("blocks"), many.alias("apart"),
                         F.col("all").cast("int").alias("all"))
    start, blocks = F.coalesce("start", F.lit(0)), F.coalesce("blocks", F.lit(1))
    met = F.filter(F.sequence(F.lit(0), F.coalesce("all", F.lit(1)) - 1),
                   lambda x: ~F.coalesce("apart", F.lit(False)) | (x < start) | (x >= start + blocks))
    rows = rows.join(parts, ["size", "list", "cell"], "left").withColumn("block", _block(start, blocks))
    return rows.withColumn("with", F.explode(met))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                    pivots: int = PIVOTS, nearest: int = NEAREST) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    grouped = rows.where(usable("embedding")).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stored(grouped.select(F.monotonically_increasing_id().alias("id"), "*"), "vectors")
    found = stored(links(classes, threshold, pivots, nearest), "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.select("id", "other"), "id", "other").select(F.col("node").alias("id"), "component")
    named = classes.select("id", "least", "copies").join(groups, "id", "left").join(counts, "id", "left").select(
        "id", "least", F.coalesce("component", "id").alias("component"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("id", "n_links", "component_id").join(classes.select("id", "embedding"), "id").drop("id")
    keyed = rows.withColumn("key", F.when(usable("embedding"), F.col("embedding"))).select("vec_id", "key")
    # Vectors that link with nothing have no key; they stay out of the join.
    linked = keyed.where("key IS NOT NULL").join(named.withColumnRenamed("embedding", "key"), "key").select("vec_id", "n_links", "component_id")
    alone = keyed.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
