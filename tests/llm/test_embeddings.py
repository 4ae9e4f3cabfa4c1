import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import embeddings as emb


def brute(vectors, threshold=0.9):
    """Links and components by all pairs; vectors: id -> list or None."""
    good = {}
    for i, v in vectors.items():
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float64) / np.max(np.abs(np.array(v, np.float64)))
            good[i] = a / np.sqrt(a @ a)
    links = {i: [j for j in good if j != i and i in good and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold] for i in vectors}
    least = {i: i for i in vectors}
    changed = True
    while changed:
        changed = False
        for i in vectors:
            for j in links[i]:
                if least[j] < least[i]:
                    least[i], changed = least[j], True
    return {i: (len(links[i]), least[i], least[i] == i) for i in vectors}


def data():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 16))
    rows = {i: (centres[i % 12] + draw.normal(scale=0.12, size=16)).tolist() for i in range(240)}
    rows |= {240 + i: rows[5] for i in range(30)}  # copies
    rows |= {300: None, 301: [], 302: [0.0] * 16, 303: [None] + [1.0] * 15, 304: [float("nan")] * 16, 305: [float("inf")] + [1.0] * 15,
             306: [1.0, 2.0], 307: [2.0, 4.0], 308: [1e300, 2e300], 309: [3.0], 310: [-5.0], 311: [7.0], 312: [x * 1e-30 for x in rows[5]]}
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_links_and_components_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(emb, "BLOCK", block)  # with small blocks every list is cut
    rows = data()
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in emb.near_duplicates(df, pivots=24, nearest=8).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (None, None), (5, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in emb.near_duplicates(df).collect()), key=str)
    assert got == [(1, 2, 1), (1, 2, 1), (5, 0, 5), (None, 0, None), (None, 2, 1)]
    assert emb.near_duplicates(df.where("false")).collect() == []


def test_recall_at_the_threshold():
    """Random pairs right at a cosine of 0.9: the share that has two of its nearest pivots in common."""
    draw = np.random.default_rng(0)
    a = emb.unit(draw.normal(size=(2000, 64)))
    side = draw.normal(size=a.shape)
    side = emb.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.9 * a + np.sqrt(1 - 0.81) * side
    pivots = emb.unit(draw.normal(size=(emb.PIVOTS, 64)))
    near_a, near_b = (emb.nearest_pivots(x, pivots, emb.NEAREST) for x in (a, b))
    shared = np.array([len(np.intersect1d(x, y)) for x, y in zip(near_a, near_b)])
    assert (shared >= 2).mean() >= 0.99


@pytest.mark.parametrize("cosine", [0.91, 0.95, 0.98, 0.995])
def test_a_third_of_all_vectors_are_near_copies(spark, monkeypatch, cosine):
    """Vectors of one group, all different, with this cosine to each other on average; the group's own cell and lists are cut."""
    monkeypatch.setattr(emb, "BLOCK", 60)
    monkeypatch.setattr(emb, "CELL_BLOCK", 150)
    draw = np.random.default_rng(7)
    points = emb.unit(draw.normal(size=(1200, 64)))
    points[:400] = np.sqrt(cosine) * emb.unit(draw.normal(size=(1, 64))) + np.sqrt(1 - cosine) * points[:400]
    points = emb.unit(points)
    near = points @ points.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in emb.near_duplicates(df).collect()}
    want = near.sum(1)
    assert want.sum() > 50_000 and all(found[i] <= want[i] for i in found)
    assert sum(found.values()) >= 0.99 * want.sum()


def test_pivots_are_spread_out():
    draw = np.random.default_rng(1)
    sample = emb.unit(np.concatenate([draw.normal(size=(1, 64)) + draw.normal(scale=0.2, size=(300, 64)), draw.normal(size=(500, 64))]))
    pivots = emb.spread_pivots(sample, 128)
    alike = np.triu(pivots @ pivots.T, 1)
    assert pivots.shape == (128, 64) and alike.max() <= emb.SPREAD
    assert emb.spread_pivots(sample[:300], 128).any(1).all()  # random directions fill up
