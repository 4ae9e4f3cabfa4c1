import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeworks.llm import simhash


def fingerprint(text):
    """The fingerprint by its definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def groups(fps, limit=3):
    """Smallest id reachable over pairs within the limit, by trying all pairs; fps: id -> value."""
    least = dict((i, i) for i in fps)
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= limit and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


TEXTS = [
    "The quick brown fox jumps over the lazy dog near the river bank today",
    "the QUICK brown fox jumps over the lazy dog near the river bank today",
    None, "", " \t\n", "one", "one two", "ONE two three", "é ñ ü ß words beyond ascii É",
    "word " * 5000, "lone\x0bverse\x0cwith\x1cother\x85marks here",
]


def test_fingerprints_and_groups_by_definition(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[5])]
    out = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    want = groups({i: fingerprint(t) for i, t in enumerate(TEXTS)})
    for r in out:
        if r.doc_id is None:
            assert r.component_id == 5
        else:
            assert r.fingerprint == "%016x" % fingerprint(TEXTS[r.doc_id])
            assert r.component_id == want[r.doc_id]


def near_values(n, seed=5):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 2 ** 63, n // 4, dtype=np.int64)
    out = set(base.tolist())
    while len(out) < n:
        v = int(draw.choice(base))
        for b in draw.choice(64, draw.integers(1, 6), replace=False):
            v ^= -(1 << 63) if b == 63 else 1 << int(b)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("thresholds", [(0, 0, 0, 0), (1, 0, 0), (1, 1), (2, 0), (2, 0, -1), (1, -1, 1)])
def test_every_allocation_finds_every_pair(spark, monkeypatch, thresholds):
    values = near_values(400)
    parts = simhash.correlated_parts(np.array(values, np.int64).view(np.uint64), len(thresholds))
    assert sorted(b for p in parts for b in p) == list(range(64))
    plan = [(p, t) for p, t in zip(parts, thresholds) if t >= 0]
    monkeypatch.setattr(simhash, "plan_search", lambda *_: plan)
    monkeypatch.setattr(simhash, "HOT_BUCKET", 3)  # the second dealing is used as well
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {(r.u, r.v) for r in simhash.links(fps).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert want and got == want


def test_thresholds_sum_and_follow_the_cost():
    sample = np.array(near_values(300), np.int64).view(np.uint64)
    for total in (1000, 10 ** 6, 10 ** 9):
        for n in (2, 3, 4):
            _, t = simhash.allocate(sample, total, 3, simhash.correlated_parts(sample, n))
            assert sum(x + 1 for x in t) == 4
    few, many = (simhash.plan_search(sample, total, 3) for total in (1000, 10 ** 9))
    assert max(len(p) for p, _ in many) >= max(len(p) for p, _ in few)  # wider parts for more rows


def test_keep_one_per_group(spark):
    rows = [(3, "a b c d e", 1), (1, "A b c d e", 2), (1, "A b c d e", 2), (7, "other words here now", 3), (None, "a b c d e", 4),
            (None, "only nameless rows", 5), (None, "only nameless rows", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int").withColumn("_kept", F.lit(1)).withColumn("_fp", F.lit("x"))
    out = simhash.keep_one_per_group(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "only nameless rows"), (1, "A b c d e"), (7, "other words here now")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(docs).collect() == [] and simhash.keep_one_per_group(docs).collect() == []
