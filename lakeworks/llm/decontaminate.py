"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item; a shorter item is one
window. Of the k-word hashes inside each window only the least is kept (the last of
equal ones). Which one that is depends on the window's words alone, so two texts that
share a window keep the same hash at the same place in it: no shared window is missed.
The kept hashes of documents and items are joined; a hit is compared word by word and
extended to both sides, and a run of equal words at least a window long covers words of
the document.

The items' hashes also make a bitmap of fixed size that is broadcast; document hashes
that are not in it never leave the scan. It only spares work: the join decides.

Defined cases: a null text has no words; an item without words is never found; a null
item id counts as an item with an empty name; items with equal ids are one item; rows
that share a document id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stored, without
from .text import NOT_ALNUM, Words, grams, mix, row_slices, window_argmin

GRAM = 5
# Bits of the bitmap as a power of two: 2 MiB, whatever the input.
BITMAP = 24

_HIT = pa.struct([("at", pa.int32()), ("kind", pa.int32()), ("hash", pa.int64()), ("gram", pa.list_(pa.string())),
                  ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])
_HIT_SQL = "array<struct<at:int,kind:int,hash:bigint,gram:array<string>,before:array<string>,after:array<string>>>"


def _kept(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Word indexes and hashes that winnowing keeps for windows of ``length`` words, and the words per hash."""
    k = min(GRAM, length)
    # The window length goes into the hash: short items have windows of their own.
    values = mix(grams(hashes, k) ^ np.uint64(length))
    least = window_argmin(values, length - k + 1)
    at = np.unique(least[words.left()[:len(least)] >= length])
    return at, values[at], k


def _hit(words: Words, i: int, first: int, last: int, k: int, length: int, value: int) -> dict:
    """One kept hash with the words around it that can lie in a window with it; ``before`` runs backwards."""
    text = [words.word(j).decode() for j in range(max(first, i + k - length), min(last, i + length))]
    lead = i - max(first, i + k - length)
    return {"at": i - first, "kind": length, "hash": value, "gram": text[lead:lead + k], "before": text[:lead][::-1],
            "after": text[lead + k:]}


def _fingerprints(texts: list[bytes], lengths: list[int], bitmap: np.ndarray | None, own: int | None) -> tuple[np.ndarray, list[list[dict]]]:
    """Word counts, and the kept hashes of every text.

    With ``own`` a text is an item: only the window length that fits it counts (``own``,
    or all its words if it has fewer). With ``bitmap`` only hashes in it are returned.
    """
    words = Words(texts, NOT_ALNUM, lower=True)
    out: list[list[dict]] = [[] for _ in texts]
    if not len(words):
        return words.counts, out
    hashes, row = words.hashes(), words.row()
    fits = np.minimum(words.counts, own) if own else None
    for length in lengths if fits is None else sorted(set(fits[fits > 0].tolist())):
        at, values, k = _kept(words, hashes, length)
        if bitmap is not None:
            found = bitmap[(values & np.uint64((1 << BITMAP) - 1)).astype(np.int64)]
            at, values = at[found], values[found]
        if fits is not None:
            found = fits[row[at]] == length
            at, values = at[found], values[found]
        for i, value in zip(at.tolist(), values.view(np.int64).tolist()):
            r = row[i]
            out[r].append(_hit(words, i, int(words.first[r]), int(words.first[r + 1]), k, length, value))
    return words.counts, out


def _mapped(df: DataFrame, text: str, lengths: list[int], bitmap: Broadcast | None, own: int | None) -> DataFrame:
    """``df`` without its text, with ``n_words`` and the kept hashes ``hits``."""
    kept = [c for c in df.columns if c != text]
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(bitmap.value, bitorder="little").view(bool) if bitmap else None
        for batch in batches:
            for first, texts in row_slices(batch.column(len(kept))):
                counts, hits = _fingerprints(texts, lengths, bits, own)
                columns = [c.slice(first, len(texts)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.astype(np.int64)), pa.array(hits, pa.list_(_HIT))],
                                                 [*kept, "n_words", "hits"])

    return df.select(*kept, text).mapInArrow(run, f"{fields}, n_words bigint, hits {_HIT_SQL}")


def _bitmap(items: DataFrame) -> np.ndarray:
    """The bitmap of the items' hashes: at most 512 rows of 4 KiB come to the driver."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << BITMAP) - 1)) + 1
    parts = items.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros((1 << BITMAP) // 8, np.uint8)
    for r in parts.collect():
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _equal_lead(a: str, b: str) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def _covered(spans: str) -> Column:
    """Words covered by sorted, possibly overlapping ``(s, e)`` spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.greatest(F.lit(0), x["e"] - F.greatest(acc["to"], x["s"]))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["to"], x["e"]).alias("to"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13) -> DataFrame:
    """``docs`` without the text column, with ``n_words``, ``n_hit``, ``item_ids`` (sorted strings) and ``spans`` (word ranges that are hit).

    A column of ``docs`` with the name of a result column (or ``_row``, ``hits``) is
    left out. Equal fingerprints with equal surroundings are one row of the item side, so copies
    of an item do not multiply the join.
    """
    spark = docs.sparkSession
    item_rows = stored(_mapped(items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("_text")),
                               "_text", [], None, window).where("n_words > 0"), "items")
    prints = item_rows.select("item", F.explode("hits").alias("h")).select(
        F.col("h.kind").alias("kind"), F.col("h.hash").alias("hash"), F.col("h.gram").alias("gram"),
        F.col("h.before").alias("i_before"), F.col("h.after").alias("i_after"), "item")
    prints = prints.groupBy("kind", "hash", "gram", "i_before", "i_after").agg(F.collect_set("item").alias("items"))
    # Window lengths in use: at most ``window`` different ones.
    lengths = [r[0] for r in item_rows.select(F.least("n_words", F.lit(window)).cast("int")).distinct().collect()]
    bitmap = spark.sparkContext.broadcast(_bitmap(item_rows.select(F.explode("hits.hash").alias("hash"))))
    kept = without(docs, text, "_row", "hits", "n_words", "n_hit", "item_ids", "spans")
    marked = stored(_mapped(docs.select(F.monotonically_increasing_id().alias("_row"), *kept, text), text, lengths, bitmap, None),
                    "winnowed")
    hits = marked.select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    left, right = _equal_lead("before", "i_before"), _equal_lead("after", "i_after")
    runs = (hits.join(prints, ["kind", "hash", "gram"]).select("_row", "at", "kind", "gram", "items", left.alias("l"), right.alias("r"))
            .where(F.col("l") + F.size("gram") + F.col("r") >= F.col("kind")))
    span = F.struct((F.col("at") - F.col("l")).alias("s"), (F.col("at") + F.size("gram") + F.col("r")).alias("e"))
    found = runs.groupBy("_row").agg(F.collect_set(span).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    joined = marked.drop("hits").join(found, "_row", "left")
    return joined.select(
        *kept, "n_words", F.coalesce(_covered("spans"), F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<s:int,e:int>>")).alias("spans"))


def is_contaminated() -> Column:
    """A hit word, and at least one hit word in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
