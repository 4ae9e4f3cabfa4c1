"""Near-duplicate groups by SimHash: fingerprints that differ in few bits.

The search uses the general pigeonhole principle. The 64 bits are grouped into parts,
correlated bits together, and part i gets its own threshold t_i with sum(t_i + 1) =
limit + 1. Two fingerprints within the limit then differ by at most t_i bits in some
part i, so looking up every part's value with up to t_i bits changed finds every pair.
How many parts there are and how the thresholds fall is decided by dynamic programming
on the estimated number of lookups and candidates. The estimate comes from a bounded
sample; the answer does not depend on it, only the cost does.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; equal rows get equal results; the id of a group is the smallest
id that is not null in it, or null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .frames import stored, unused
from .graph import components
from .text import row_slices

BITS = 64
SEED = 42
# Fingerprints looked at to estimate costs. More only makes the estimate finer.
SAMPLE = 2000
# A bucket with more rows is dealt out again by the bits outside its part.
HOT_BUCKET = 2000
# Cost of a stored or looked up key against that of checking a candidate pair.
KEY_COST = 2.0


def _fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    digests, counts = [], []
    for text in texts:
        words = text.lower().split()
        if len(words) > shingle:
            parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        else:
            parts = [b" ".join(words)] if words else []
        found = [xxhash.xxh64_digest(p, SEED) for p in parts]
        counts.append(len(found))
        digests.append(b"".join(found))
    counts = np.array(counts)
    out = np.zeros(len(texts), np.uint64)
    used = np.flatnonzero(counts)
    if len(used):
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        firsts = np.concatenate([[0], np.cumsum(counts[used])[:-1]])
        ones = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        packed = np.packbits((2 * ones > counts[used][:, None]).astype(np.uint8), axis=1)
        out[used] = packed.view(">u8").ravel()
    return out.view(np.int64)


def add_fingerprint(df: DataFrame, text: str, out: str, shingle: int = 3) -> DataFrame:
    """``df`` without its text, with the 64-bit fingerprint of the text as a long.

    ASCII letters are lower-cased; words are runs of anything but ASCII white space;
    a bit is 1 if more than half of the XXH64 values of all word shingles have it.
    """
    rest = [c for c in df.columns if c != text]
    schema = StructType([df.schema[c] for c in rest] + [StructField(out, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_fingerprints(texts, shingle) for _, texts in row_slices(batch.column(len(rest)))]
            column = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*rest, out])

    return df.select(*rest, text).mapInArrow(run, schema)


# --- which parts, which thresholds ---

def correlated_parts(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each group takes the free bits most correlated with it."""
    ones = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    centred = ones - ones.mean(0)
    norm = np.sqrt((centred ** 2).sum(0)) + 1e-9
    linked = np.abs(centred.T @ centred / np.outer(norm, norm))
    np.fill_diagonal(linked, 0)
    free, out = set(range(BITS)), []
    for i in range(parts):
        size = len(free) // (parts - i)
        order = sorted(free)
        group = [max(order, key=lambda b: linked[b, order].sum())]
        while len(group) < size:
            rest = [b for b in order if b not in group]
            group.append(max(rest, key=lambda b: linked[b, group].sum()))
        free -= set(group)
        out.append(sorted(group))
    return out


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _lookups(width: int, radius: int) -> int:
    return 0 if radius < 0 else sum(len(list(combinations(range(width), r))) for r in range(radius + 1))


def allocate(sample: np.ndarray, total: int, limit: int, parts: list[list[int]]) -> tuple[float, list[int]]:
    """Cheapest thresholds for these parts, and their cost: sum(t + 1) = limit + 1, each t from -1 to 2.

    A part's cost is its keys plus the candidates expected among ``total`` fingerprints:
    the share of sampled pairs that close in the part, and what independent bits would give.
    """
    left, right = np.triu_indices(len(sample), 1)
    ones = [float(((sample >> np.uint64(b)) & np.uint64(1)).mean()) for b in range(BITS)]
    cost = []
    for bits in parts:
        apart = np.bitwise_count((sample[left] ^ sample[right]) & np.uint64(_mask(bits)))
        chance = np.prod([ones[b] ** 2 + (1 - ones[b]) ** 2 for b in bits])
        row = [0.0]
        for radius in range(3):
            near = (float((apart <= radius).mean()) if len(apart) else 0.0) + chance * _lookups(len(bits), radius)
            row.append(KEY_COST * total * (1 + _lookups(len(bits), radius) * (radius > 0)) + total * total / 2 * min(near, 1))
        cost.append(row)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for extra, c in enumerate(row):
                key = used + extra
                if key <= limit + 1 and (key not in step or spent + c < step[key][0]):
                    step[key] = (spent + c, [*chosen, extra - 1])
        best = step
    return best[limit + 1]


def plan_search(sample: np.ndarray, total: int, limit: int) -> list[tuple[list[int], int]]:
    """The parts in use and their thresholds, over all numbers of parts that make sense for the limit."""
    options = []
    for n in range(2, limit + 2):
        parts = correlated_parts(sample, n)
        cost, thresholds = allocate(sample, total, limit, parts)
        options.append((cost, [(p, t) for p, t in zip(parts, thresholds) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


# --- probe and verify ---

def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keys(fp: Column, bits: list[int], radius: int) -> tuple[Column, Column]:
    """The stored key of a part and the array of keys to look up beside it.

    Of two keys one bit apart, one has the bit clear, so setting clear bits is enough
    for radius 1.
    """
    own = fp.bitwiseAND(F.lit(_signed(_mask(bits))))
    changed = []
    if radius == 1:
        changed = [F.when(fp.bitwiseAND(F.lit(_signed(1 << b))) == 0, own.bitwiseXOR(F.lit(_signed(1 << b)))) for b in bits]
    elif radius == 2:
        changed = [own.bitwiseXOR(F.lit(_signed(_mask(c)))) for r in (1, 2) for c in combinations(bits, r)]
    return own, F.array_compact(F.array(*changed)) if changed else F.array().cast("array<bigint>")


def _signatures(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Rows ``(part, key, probe, fp)``: one stored key per part and the keys to look up."""
    fp = F.col("fp")

    def entry(part: int, key: Column, probe: bool) -> Column:
        return F.struct(F.lit(part).alias("part"), key.alias("key"), F.lit(probe).alias("probe"))

    def lookups(part: int, keys: Column) -> Column:
        return F.transform(keys, lambda k: entry(part, k, True))

    groups = []
    for i, (bits, radius) in enumerate(plan):
        own, changed = _keys(fp, bits, radius)
        groups.append(F.array(entry(i, own, False)))
        if radius:
            groups.append(lookups(i, changed))
    return fps.select("fp", F.explode(F.concat(*groups)).alias("s")).select("s.*", "fp")


def _split_hot(sig: DataFrame, plan: list[tuple[list[int], int]], limit: int) -> DataFrame:
    """Deal the rows of hot buckets out again by ``limit + 1`` groups of the other bits.

    Two fingerprints within the limit agree in at least one of the groups, so no pair is lost.
    """
    hot = (sig.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_BUCKET)
           .select("part", "key", F.lit(True).alias("hot")))
    again = F.lit(None).cast("array<struct<sub:int,rest:bigint>>")
    for i, (bits, _) in enumerate(plan):
        others = [b for b in range(BITS) if b not in bits]
        masks = [_signed(_mask(others[j::limit + 1])) for j in range(limit + 1)]
        again = F.when(F.col("part") == i, F.array(*[
            F.struct(F.lit(j).alias("sub"), F.col("fp").bitwiseAND(F.lit(m)).alias("rest")) for j, m in enumerate(masks)
        ])).otherwise(again)
    once = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("bigint").alias("rest")))
    dealt = F.explode(F.when(F.col("hot"), again).otherwise(once)).alias("d")
    return sig.join(hot, ["part", "key"], "left").select("part", "key", "probe", "fp", dealt).select(
        "part", "key", "probe", "fp", "d.*")


def links(fps: DataFrame, limit: int = 3) -> DataFrame:
    """Distinct pairs ``(u, v)`` of different fingerprints (column ``fp``, distinct) at most ``limit`` bits apart."""
    total = fps.count()
    # The least hashes: a sample that does not depend on the order of rows.
    rows = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    if total < 2:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    plan = plan_search(sample, total, limit)
    sig = _split_hot(_signatures(fps, plan), plan, limit)
    on = ["part", "key", "sub", "rest"]
    stored_keys = sig.where(~F.col("probe")).select(*on, F.col("fp").alias("v"))
    looked_up = sig.select(*on, "probe", F.col("fp").alias("u"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= limit
    pairs = looked_up.join(stored_keys, on).where(near & (F.col("u") != F.col("v")) & (F.col("probe") | (F.col("u") < F.col("v"))))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   limit: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id of its group).

    Copies share a fingerprint and are one node of the search; the group structure is
    found among distinct fingerprints and handed back to all rows.
    """
    marked = stored(add_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                    "text", "fp", shingle), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    groups = components(links(classes.select("fp"), limit), "u", "v")
    rooted = classes.join(groups.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = rooted.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                       limit: int = 3) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, once each.

    Rows without an id are never the smallest; where a group has no row with an id, one
    row of each of its fingerprints stays. Of rows that share an id, one stays.
    """
    groups = simhash_groups(docs, doc_id, text, shingle, limit)
    kept_id, fp, copy = (unused(docs, n) for n in ("_kept", "_fp", "_copy"))
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(kept_id)).distinct()
    named = docs.join(kept, F.col(doc_id) == F.col(kept_id), "left_semi").dropDuplicates([doc_id])
    nameless = groups.where(F.col("component_id").isNull()).select(F.col("fingerprint").alias(fp)).distinct()
    rest = add_fingerprint(docs.where(F.col(doc_id).isNull()).withColumn(copy, F.col(text)), copy, fp, shingle)
    rest = rest.withColumn(fp, F.lower(F.lpad(F.hex(fp), 16, "0"))).join(nameless, fp, "left_semi")
    return named.unionByName(rest.dropDuplicates([fp]).drop(fp))
