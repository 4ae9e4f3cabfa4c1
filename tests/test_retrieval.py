import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.functions.vector import cosine_similarity, vector_literal
from lakeworks.operators import retrieval as ret


def test_cosine_values(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0], 1.0), ([1.0, 2.0], [-1.0, -2.0], -1.0), ([0.0, 0.0], [1.0, 0.0], 0.0)],
                               "a array<float>, b array<float>, want double")
    assert df.where(F.abs(cosine_similarity("a", "b") - F.col("want")) > 1e-12).count() == 0
    assert df.select(cosine_similarity("a", vector_literal([1.0, 2.0])).alias("s")).first()["s"] == pytest.approx(1.0)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 16)).astype(np.float32)
    data[7] = 0
    data[20] = data[10]  # an exact tie
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "id bigint, embedding array<float>").repartition(7).cache()


def brute(data, q, k):
    d, q = data.astype(float), np.asarray(q, dtype=float)
    size = np.linalg.norm(d, axis=1) * np.linalg.norm(q)
    s = np.where(size > 0, d @ q / np.where(size > 0, size, 1), 0)
    return [(i, pytest.approx(-x, abs=1e-9)) for x, i in sorted((-round(float(x), 12), i) for i, x in enumerate(s))[:k]]


def test_single_query_equals_brute_force(vectors, spark):
    data, df = vectors
    for query in ([float(x) for x in data[10]], df.where("id = 10").select("embedding")):
        got = [(r["id"], r["similarity"]) for r in ret.topk_cosine(df, query, 8, ["id"]).collect()]
        assert got == brute(data, data[10], 8) and [i for i, _ in got[:2]] == [10, 20]


@pytest.mark.parametrize("block_rows", [1000, 4])
def test_batch_equals_brute_force_for_any_block_size(vectors, block_rows):
    data, df = vectors
    queries = df.where("id < 12").withColumnRenamed("id", "qid")
    got = {}
    for r in ret.topk_cosine_batch(df, queries, 5, ["id"], "qid", block_rows=block_rows).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["id"], r["similarity"]))
    assert got == {q: brute(data, data[q], 5) for q in range(12)}


def test_batch_with_more_asked_than_there_are(vectors):
    data, df = vectors
    got = ret.topk_cosine_batch(df.where("id < 3"), df.where("id = 1").withColumnRenamed("id", "q"), 10, ["id"], "q")
    assert [r["id"] for r in got.orderBy("rank").collect()] == [i for i, _ in brute(data[:3], data[1], 3)]


def test_ann_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(10, 16))
    data = (centres[rng.integers(0, 10, 500)] + 0.15 * rng.normal(size=(500, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, embedding array<float>")
    exact = {i for i, _ in brute(data, data[3], 10)}
    found = {r["id"] for r in ret.topk_ann(df, [float(x) for x in data[3]], 10, "id").collect()}
    assert len(exact & found) >= 8


def test_chunks_hold_the_whole_text(spark):
    words = [f"w{i}" for i in range(1003)]
    docs = spark.createDataFrame([(1, "  " + " \n".join(words) + "\t"), (2, "one"), (3, " "), (4, None)], "id int, text string")
    chunks = [r["chunk"] for r in ret.chunk_documents(docs.where("id = 1"), "id", "text", 100).orderBy("chunk_no").collect()]
    assert len(chunks) == 11 and " ".join(chunks).split(" ") == words
    assert ret.chunk_documents(docs, "id", "text", 100).where("id > 2").count() == 0
    overlapping = [r["chunk"].split(" ") for r in ret.chunk_documents(docs.where("id = 1"), "id", "text", 100, 20).orderBy("chunk_no").collect()]
    assert overlapping[0][-20:] == overlapping[1][:20] and overlapping[-1][-1] == "w1002"
    assert {w for c in overlapping for w in c} == set(words)
    with pytest.raises(ValueError):
        ret.chunk_documents(docs, "id", "text", 10, 10)


def test_encoder_is_pluggable_and_its_width_is_checked(spark):
    df = spark.createDataFrame([("abc",), ("a",)], "t string")

    def lengths():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    assert sorted(r["embedding"] for r in ret.embed(df, "t", lengths, dim=2).collect()) == [[1.0, 1.0], [3.0, 1.0]]
    with pytest.raises(Exception, match="expected 3"):
        ret.embed(df, "t", lengths, dim=3).collect()


def test_hashed_words():
    model = ret.HashedWords(32)
    a, b, empty = model(["pump too hot", "hot pump too", ""])
    assert (a == b).all() and a.sum() == 3 and empty.sum() == 0


def test_words_of_a_batch_are_counted_at_once(monkeypatch):
    texts = ["pump  too hot ", None, "hot hot é 漢字", "", "a b c " * 500]
    cell = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 7
    want = [[sum(cell(w) == c for w in (t or "").split()) for c in range(7)] for t in texts]
    calls, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or count(*a, **k))
    found = ret.HashedWords(7)(texts)
    assert found.tolist() == want and found.dtype == np.float32 and len(calls) == 1
    assert ret.HashedWords(7)([]).shape == (0, 7)


def test_retrieval_finds_the_passage(spark, folder):
    docs = spark.createDataFrame([(1, "the valve leaks oil when cold"), (2, "vibration above ten suggests bearing wear"),
                                  (3, "pumps run hotter in building three")], "id int, text string")
    index = ret.build_doc_index(docs, "id", "text", 50, path=f"{folder}/index")
    asked = spark.createDataFrame([("q1", "bearing wear and vibration"), ("q2", "hotter pumps")], "q string, text string")
    best = ret.retrieve(index, asked, "q", "text", 1, "id")
    assert {r["q"]: r["id"] for r in best.collect()} == {"q1": 2, "q2": 3}


def test_sensor_index_takes_abnormal_rows_only(spark):
    rows = [(f"s{i}", "pump", "A01", ["normal", "warning", "critical"][i % 3], 70.0, 100.0, 2.0) for i in range(60)]
    df = spark.createDataFrame(rows, "sensor_id string, device_type string, facility string, status string, temperature double, pressure double, vibration double")
    index = ret.sensor_log_index(df, 25, ["sensor_id"], dim=16)
    assert index.count() == 25 and index.where("status = 'normal' OR size(embedding) <> 16").count() == 0


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_cells_change_the_work_and_not_the_answer(spark, spread):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + spread * draw.normal(size=16)).tolist()) for i in range(1500)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [1.0, 2.0]), (2003, rows[5][1]), (2004, rows[5][1])]
    index = spark.createDataFrame(rows + odd, "id long, embedding array<double>")
    asked = [(f"q{i}", v) for i, v in enumerate([rows[5][1], [-x for x in rows[7][1]], [0.0] * 16, None, draw.normal(size=16).tolist()])]
    queries = spark.createDataFrame(asked, "q string, embedding array<double>")
    got = {}
    for r in ret.topk_cosine_batch(index, queries, 12, ["id"], "q", cells=32).collect():
        got.setdefault(r["q"], []).append((r["rank"], r["id"], r["similarity"]))

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or not any(a) or not any(b):
            return 0.0
        return math.floor(float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)) * 1e12 + 0.5) / 1e12

    for name, q in asked:
        want = sorted(((-cosine(q, v), i) for i, v in rows + odd))[:12]
        found = sorted(got[name])
        assert [i for _, i, _ in found] == [i for _, i in want]
        assert [s for _, _, s in found] == pytest.approx([-c for c, _ in want], abs=1e-11)
    visits = {r["q"]: r["rows_met"] / r["rows"] for r in ret.cell_visits(index, queries, 12, ["id"], "q", cells=32).collect()}
    if spread < 1:
        assert visits["q0"] < 0.3  # two thirds and more are never compared


@pytest.mark.parametrize("task_bytes, few", [(32 << 20, 8), (400, 10 ** 6), (400, 8), (2000, 0)])
def test_batch_search_in_tasks_of_bounded_size(spark, monkeypatch, task_bytes, few):
    monkeypatch.setattr(ret, "TASK_BYTES", task_bytes)
    monkeypatch.setattr(ret, "FEW", few)
    draw = np.random.default_rng(5)
    data = {i: [float(x) for x in draw.integers(-3, 4, 4)] for i in range(90)}
    data |= {90 + i: data[3] for i in range(60)} | {150: None, 151: [0.0] * 4, 152: [1.0, 2.0]}  # a large group of copies
    df = spark.createDataFrame(list(data.items()), "id long, embedding array<float>").repartition(3)
    asked = df.withColumnRenamed("id", "q").where("q % 2 = 0 OR q = 151")

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or not any(a) or not any(b):
            return 0.0
        return round(float(np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))), 12)

    want = sorted((q, rank + 1, i) for q in data if q % 2 == 0 or q == 151
                  for rank, i in enumerate(sorted(data, key=lambda i: (-cosine(data[q], data[i]), i))[:5]))
    exact = ret.topk_cosine_batch(df, asked, 5, ["id"], "q", block_rows=16, cells=8)
    assert sorted((r["q"], r["rank"], r["id"]) for r in exact.collect()) == want
    every = ret.topk_ann_batch(df, asked, 5, ["id"], "q", probes=16, cells=8, block_rows=16)
    assert sorted((r["q"], r["rank"], r["id"]) for r in every.collect()) == want
    # A task passes on k rows of a query, however many blocks it multiplies.
    placed, found = ret.with_cells(df, ["id"], "embedding", 8)
    visits = ret._visits(asked, "q", "embedding", found, 5, 16)
    passed = ret._scanned(placed, visits, found, 5, ["id"], "q", "embedding", 4, asked.count())
    parts = 3 if asked.count() <= task_bytes // 32 and few * asked.count() <= len(data) else -(-len(data) // (task_bytes // 32))
    assert passed.groupBy("q").count().agg(F.max("count")).first()[0] <= 5 * parts
