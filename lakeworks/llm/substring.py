"""Removal of repeated word windows, found by level-wise doubling.

Windows of a short length are counted first; only where one is repeated can a window of
twice the length be, so only those are extended and counted at the next length, and so
on up to the asked window or until no candidates survive. At each lower length L not all
windows are counted but the one with the least hash in every run of ``window`` words: it
depends on the words of the run alone, so two equal runs count the same one, and a run
whose counted window occurs once cannot be repeated. What is repeated goes into a bitmap
of fixed size; other hashes that fall on its bits only cost time.

At the asked length, candidate windows in a row with the same counted part travel as one
chunk. The earliest occurrence of every distinct chunk is an aggregate; only where one
part occurs in several distinct chunks are single windows compared. What comes out are
the first occurrences. They go back to their documents, where each candidate window that
is not one of them covers words to remove: a candidate's content has just one first
occurrence, whether or not it is repeated.

A window is compared by 128 bits of hash: 64 of its counted part and 64 of its own.

Defined cases: a null or empty text has no words; documents are ordered by id, a null id
first, then by a hash of the text; rows equal in id and text are one document, and each
gets its result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .frames import stored, unused, without
from .text import BASES, SPACES, Words, grams, row_slices, window_argmin

# Bits of each level's bitmap as a power of two: 16 MiB, whatever the input.
BITMAP = 27


def levels(window: int, base: int) -> list[int]:
    """Lengths below the window, each half of the next; none under ``base``."""
    out = []
    while window // 2 >= base:
        window = -(-window // 2)
        out.insert(0, window)
    return out


def _inside(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64((1 << BITMAP) - 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


class Candidates:
    """Windows of some texts that all bitmaps so far let through.

    ``starts``: word indexes where such windows begin; ``parts``: for each, the word index
    of the counted window of ``lengths[len(bitmaps) - 1]`` words (of the first length
    without bitmaps); ``part_hash``: the hashes of counted windows by word index.
    """

    def __init__(self, texts: list[bytes], window: int, lengths: list[int], bitmaps: list[np.ndarray], count: bool):
        self.words = Words(texts, SPACES, lower=False)
        hashes = self.words.hashes()
        self.starts = np.flatnonzero(self.words.left() >= window)
        self.parts, self.part_hash = self.starts, hashes
        for i, length in enumerate(lengths[:len(bitmaps) + count]):
            if not len(self.starts):
                break
            self.part_hash = grams(hashes, length)
            self.parts = window_argmin(self.part_hash, window - length + 1)[self.starts]
            if i < len(bitmaps):
                alive = _inside(bitmaps[i], self.part_hash[self.parts])
                self.starts, self.parts = self.starts[alive], self.parts[alive]


def _level_counts(docs: DataFrame, text: str, window: int, lengths: list[int], bitmaps: list[Broadcast]) -> DataFrame:
    """Hashes that are repeated at the level after ``bitmaps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.value for b in bitmaps]
        for batch in batches:
            for _, texts in row_slices(batch.column(0)):
                found = Candidates(texts, window, lengths, held, True)
                values, n = np.unique(found.part_hash[np.unique(found.parts)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["hash", "n"])

    counted = docs.select(text).mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return counted.where("n > 1").select("hash")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the hashes; at most 2**BITMAP bits come to the driver, in pieces of 4 KiB."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << BITMAP) - 1)) + 1
    parts = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros((1 << BITMAP) // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _chunks(docs: DataFrame, window: int, lengths: list[int], bitmaps: list[Broadcast]) -> DataFrame:
    """Runs of candidate windows with one counted part: ``id, tag, at, part, chunk, windows``; docs: ``id, tag, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.value for b in bitmaps]
        for batch in batches:
            for first, texts in row_slices(batch.column(2)):
                found = Candidates(texts, window, lengths, held, False)
                if not len(found.starts):
                    continue
                own = grams(found.words.hashes(BASES[1]), window, BASES[1])[found.starts]
                fresh = np.append(True, (np.diff(found.starts) != 1) | (np.diff(found.parts) != 0))
                begins = np.flatnonzero(fresh)
                place = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
                chunk = np.add.reduceat((own ^ (place.astype(np.uint64) << np.uint64(56))) * np.uint64(BASES[0]), begins)
                row, position = found.words.row(), found.words.position()
                at = found.starts[begins]
                rows = pa.array(first + row[at])
                offsets = pa.array(np.append(begins, len(own)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(position[at].astype(np.int32)),
                     pa.array(found.part_hash[found.parts[begins]].view(np.int64)), pa.array(chunk.view(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(own.view(np.int64)))],
                    ["id", "tag", "at", "part", "chunk", "windows"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, tag long, at int, part long, chunk long, windows array<long>")


def first_occurrences(docs: DataFrame, window: int, lengths: list[int], bitmaps: list[Broadcast]) -> DataFrame:
    """``id, tag, firsts``: by document, runs ``(at, n)`` of candidate windows that start nowhere earlier."""
    earliest = F.min(F.struct("id", "tag", "at", "windows")).alias("f")
    chunks = stored(_chunks(docs, window, lengths, bitmaps).groupBy("part", "chunk").agg(earliest).select("part", "f.*"), "chunks")
    several = chunks.groupBy("part").agg(F.count("*").alias("n")).where("n > 1").select("part", F.lit(True).alias("several"))
    marked = chunks.join(several, "part", "left")
    alone = marked.where(F.col("several").isNull()).select("id", "tag", "at", F.size("windows").alias("n"))
    single = marked.where("several").select("part", "id", "tag", "at", F.posexplode("windows").alias("o", "w"))
    single = single.groupBy("part", "w").agg(F.min(F.struct("id", "tag", (F.col("at") + F.col("o")).alias("at"))).alias("f"))
    runs = alone.unionByName(single.select("f.*", F.lit(1).alias("n")))
    return runs.groupBy("id", "tag").agg(F.collect_list(F.struct("at", "n")).alias("firsts"))


def _covered(found: Candidates, texts: int, firsts: list, window: int) -> np.ndarray:
    """Words under candidate windows that are no first occurrence."""
    words = found.words
    later = np.zeros(len(words) + 1, bool)
    later[found.starts] = True
    for r in range(texts):
        if firsts[r]:
            base = words.first[r]
            for run in firsts[r]:
                later[base + run["at"]:base + run["at"] + run["n"]] = False
    starts = np.flatnonzero(later)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:-1] > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, base: int = 5,
                   kept: str | None = None, digest: bool = True) -> DataFrame:
    """``docs`` without the text column, with ``n_words``, ``n_removed`` and the digest of the kept words.

    A word is removed if it lies under a window that starts earlier too (smaller id, or
    earlier in the same document), judged on the input. ``kept`` names a column for the
    kept words joined by one space. Columns with the names of results are left out.
    """
    spark = docs.sparkSession
    lengths, bitmaps = levels(window, base), []
    for _ in lengths:
        bits = _bitmap(_level_counts(docs, text, window, lengths, bitmaps))
        bitmaps.append(spark.sparkContext.broadcast(bits))
        if not bits.any():
            break  # no candidates are left; later levels have none either
    lengths = lengths[:len(bitmaps)]
    keyed = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))
    firsts = first_occurrences(keyed, window, lengths, bitmaps)

    columns = without(docs, text, "n_words", "n_removed", *(["kept_sha256"] if digest else []), *([kept] if kept else []))
    fields = [StructField("n_words", LongType()), StructField("n_removed", LongType())]
    fields += ([StructField("kept_sha256", StringType())] if digest else []) + ([StructField(kept, StringType())] if kept else [])
    schema = StructType([*(docs.schema[c] for c in columns), *fields])
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.value for b in bitmaps]
        for batch in batches:
            for first, texts in row_slices(batch.column(n)):
                found = Candidates(texts, window, lengths, held, False)
                words = found.words
                gone = _covered(found, len(texts), batch.column(n + 1).slice(first, len(texts)).to_pylist(), window)
                removed = np.concatenate([[0], np.cumsum(gone)])
                left = []
                for r in range(len(texts)):
                    own = texts[r].split()
                    if removed[words.first[r + 1]] > removed[words.first[r]]:
                        own = [own[i] for i in np.flatnonzero(~gone[words.first[r]:words.first[r + 1]]).tolist()]
                    left.append(b" ".join(own))
                made = [pa.array(words.counts.astype(np.int64)), pa.array(removed[words.first[1:]] - removed[words.first[:-1]])]
                made += [pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string())] if digest else []
                made += [pa.array([t.decode() for t in left], pa.string())] if kept else []
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(texts)) for c in batch.columns[:n]), *made], schema.names)

    key, tag, whole, runs = (unused(docs, c) for c in ("_id", "_tag", "_text", "_firsts"))
    rows = docs.select(*columns, F.col(text).alias(whole), F.col(doc_id).alias(key), F.xxhash64(F.col(text)).alias(tag))
    firsts = firsts.select(F.col("id").alias(f"{key}f"), F.col("tag").alias(f"{tag}f"), F.col("firsts").alias(runs))
    joined = rows.join(firsts, F.col(key).eqNullSafe(F.col(f"{key}f")) & (F.col(tag) == F.col(f"{tag}f")), "left")
    return joined.select(*columns, whole, runs).mapInArrow(run, schema)
