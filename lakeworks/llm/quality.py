"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

Score: sigmoid(w0 + sum w_i x_i + pairwise), where every pair of features interacts
through the product of their low-rank factors; the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
makes it linear in the number of features. Features: each distinct word of the whole
text (hashed), and twelve statistics of the text's form with the stated length as
metadata, each cut at quantiles of the training rows.

Training uses at most ``TRAIN_ROWS`` labelled rows, the ones with the least hashes of
their ids, and runs on the driver; scoring is one map over all documents.

Defined cases: a null or empty text is scored by its statistics alone; a missing length
counts as zero; without labelled rows of both classes every score is the share of class
1 among the labelled rows, or 0.5 if there are none. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .frames import unused, without
from .text import SPACES, Words, row_slices

HASHED = 1 << 16
RANK = 8
CUTS = 11
TRAIN_ROWS = 6000
EPOCHS = 12
RATE, DECAY = 0.05, 1e-5
THRESHOLD = 0.7

STATISTICS = ("words", "mean_word", "upper", "digits", "marks", "other", "distinct", "repeats", "marked_ends",
              "lines", "long_words", "bars", "stated_length")


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[at[1:]] - total[at[:-1]]).astype(float)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Features:
    """Sparse features of some texts: distinct hashed words per row, and a matrix of statistics."""

    def __init__(self, texts: list[bytes], stated: np.ndarray):
        words = Words(texts, SPACES, lower=False)
        raw, n = words.bytes, words.counts.astype(float)
        some = np.maximum(n, 1)
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        size = np.maximum(np.diff(at) - 1, 1).astype(float)
        lengths = words.ends - words.starts
        last = raw[words.ends - 1] if len(words) else raw[:0]
        hashes = words.hashes()
        bucket = (hashes & np.uint64(HASHED - 1)).astype(np.int64)
        row = words.row()
        keys = np.unique(row * HASHED + bucket)
        self.row, self.column = keys // HASHED, keys % HASHED
        same = np.zeros(len(words), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        per_row = np.bincount(self.row, minlength=len(texts)).astype(float)
        letters = _LETTER[raw]
        upper = (raw >= 65) & (raw <= 90)
        digits = (raw >= 48) & (raw <= 57)
        marks = (raw > 32) & (raw < 127) & ~letters & ~digits
        of_words = lambda x: _sums(x, words.first) / some
        self.statistics = np.stack([
            np.log1p(n), of_words(lengths), _sums(upper, at) / size, _sums(digits, at) / size, _sums(marks, at) / size,
            _sums(raw >= 128, at) / size, per_row / some, of_words(same), of_words(~_LETTER[last]),
            (_sums(raw == 10, at) - 1) / size, of_words(lengths > 20), _sums(raw == 124, at) / size, np.log1p(stated)], 1)


class Machine:
    """A factorisation machine and the cuts of its statistics."""

    def __init__(self, cuts: np.ndarray, bias: float):
        self.cuts, self.bias = cuts, bias
        self.size = HASHED + len(STATISTICS) * (CUTS + 1)
        draw = np.random.default_rng(7)
        self.linear = np.zeros(self.size)
        self.factors = draw.normal(0, 0.01, (self.size, RANK))

    def sparse(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of features as (index, value, first, row): each row's statistics, then its words at equal weight."""
        n, k = f.statistics.shape
        index = np.stack([np.searchsorted(self.cuts[j], f.statistics[:, j], "right") + j * (CUTS + 1) + HASHED for j in range(k)], 1)
        per_row = np.bincount(f.row, minlength=n)
        row = np.concatenate([np.repeat(np.arange(n), k), f.row])
        order = np.argsort(row, kind="stable")
        columns = np.concatenate([index.ravel(), f.column])[order]
        values = np.concatenate([np.full(n * k, 1 / np.sqrt(k)), 1 / np.sqrt(np.maximum(per_row[f.row], 1))])[order]
        first = np.concatenate([[0], np.cumsum(per_row + k)])
        return columns, values, first, row[order]

    def margin(self, index: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the factor sums. No row is empty: the statistics are always there."""
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, first[:-1], axis=0)
        squares = np.add.reduceat((scaled ** 2).sum(1), first[:-1])
        return self.bias + np.add.reduceat(self.linear[index] * value, first[:-1]) + 0.5 * ((sums ** 2).sum(1) - squares), sums

    def fit(self, f: Features, label: np.ndarray) -> None:
        """Logistic loss by adaptive gradient steps over mini-batches, in an order drawn once."""
        index, value, first, _ = self.sparse(f)
        g_linear, g_factors, g_bias = np.full(self.size, 1e-4), np.full((self.size, RANK), 1e-4), 1e-4
        draw = np.random.default_rng(11)
        for _ in range(EPOCHS):
            for batch in np.array_split(draw.permutation(len(label)), max(1, len(label) // 64)):
                spans = [np.arange(first[b], first[b + 1]) for b in batch]
                own, starts = np.concatenate(spans), np.cumsum([0] + [len(s) for s in spans])
                i, x = index[own], value[own]
                z, sums = self.margin(i, x, starts)
                wrong = (1 / (1 + np.exp(-z)) - label[batch])
                each = np.repeat(np.arange(len(batch)), np.diff(starts))
                err = wrong[each] * x
                cells, where = np.unique(i, return_inverse=True)
                d_linear = np.bincount(where, err, len(cells)) + DECAY * self.linear[cells]
                step = err[:, None] * (sums[each] - self.factors[i] * x[:, None])
                d_factors = np.stack([np.bincount(where, step[:, r], len(cells)) for r in range(RANK)], 1) + DECAY * self.factors[cells]
                g_linear[cells] += d_linear ** 2
                g_factors[cells] += d_factors ** 2
                g_bias += wrong.sum() ** 2
                self.linear[cells] -= RATE * 4 * d_linear / np.sqrt(g_linear[cells])
                self.factors[cells] -= RATE * d_factors / np.sqrt(g_factors[cells])
                self.bias -= RATE * wrong.sum() / np.sqrt(g_bias)

    def score(self, texts: list[bytes], stated: np.ndarray) -> np.ndarray:
        index, value, first, _ = self.sparse(Features(texts, stated))
        return 1 / (1 + np.exp(-np.clip(self.margin(index, value, first)[0], -40, 40)))


def _lengths(column: pa.Array) -> np.ndarray:
    return np.nan_to_num(np.maximum(column.to_numpy(zero_copy_only=False).astype(float), 0))


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, stated: str | None, label: str,
          most: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``most`` labelled rows that are not held out."""
    named = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
    chosen = (named.where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(most))
    # At most ``most`` pairs of numbers are broadcast.
    length = F.coalesce(F.col(stated).cast("double"), F.lit(0.0)) if stated else F.lit(0.0)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("t"), length.alias("n")).join(F.broadcast(chosen), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = _lengths(batch.column(2))
            for first, texts in row_slices(batch.column(1)):
                f = Features(texts, lengths[first:first + len(texts)])
                ends = np.append(0, np.cumsum(np.bincount(f.row, minlength=len(texts)))).astype(np.int32)
                k = len(STATISTICS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(3).slice(first, len(texts)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(f.column.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * k), pa.array(f.statistics.ravel()))],
                    ["id", "y", "columns", "statistics"])

    kind = docs.schema[doc_id].dataType.simpleString()
    sparse = rows.select("_id", "t", "n", "_y").mapInArrow(run, f"id {kind}, y int, columns array<int>, statistics array<double>")
    # Of rows that share an id one is used; features of ``most`` rows come to the driver.
    found = sparse.groupBy("id").agg(F.min(F.struct("y", "columns", "statistics")).alias("f")).select("id", "f.*").orderBy("id").toArrow()
    y = found["y"].to_numpy().astype(float)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    if len(set(y)) < 2:
        model = Machine(np.zeros((len(STATISTICS), CUTS)), float(np.log(share / (1 - share))))
        model.factors[:] = 0
        return model
    features = Features.__new__(Features)
    columns, statistics = found["columns"].combine_chunks(), found["statistics"].combine_chunks()
    features.row = np.repeat(np.arange(len(y)), pc.list_value_length(columns).to_numpy())
    features.column = columns.flatten().to_numpy().astype(np.int64)
    features.statistics = statistics.flatten().to_numpy().reshape(len(y), len(STATISTICS))
    cuts = np.quantile(features.statistics, np.linspace(0, 1, CUTS + 2)[1:-1], axis=0).T
    model = Machine(cuts, float(np.log(share / (1 - share))))
    model.fit(features, y)
    return model


def add_score(docs: DataFrame, model: Machine, text: str, stated: str | None, threshold: float = THRESHOLD,
              score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the score of each whole text and whether it reaches the threshold; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    columns = without(docs, score, predicted)
    schema = StructType([*(docs.schema[c] for c in columns), StructField(score, DoubleType()), StructField(predicted, IntegerType())])
    length = F.coalesce(F.col(stated).cast("double"), F.lit(0.0)) if stated else F.lit(0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(columns)
            lengths = _lengths(batch.column(n + 1))
            out = [shared.value.score(texts, lengths[first:first + len(texts)]) for first, texts in row_slices(batch.column(n))]
            values = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(values), pa.array((values >= threshold).astype(np.int32))],
                                             schema.names)

    return docs.select(*columns, F.col(text).alias(unused(docs, "_text")), length.alias(unused(docs, "_stated"))).mapInArrow(run, schema)
