"""Whitening, archives and source divergence, beside plain versions of their definitions."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lakeworks.llm import divergence, warc, whitening

# --- 11: whitening ---

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def vectors(spark, values, start=0):
    return spark.createDataFrame([(start + i, v, 0, "x", "y") for i, v in enumerate(values)], SCHEMA)


def random_vectors(n, d, seed=5, scale=None):
    draw = np.random.default_rng(seed)
    spread = np.linspace(0.3, 0.05, d) if scale is None else scale
    return (draw.normal(size=(n, d)) * spread @ np.linalg.qr(draw.normal(size=(d, d)))[0]).astype(np.float32).tolist()


def whole_numbers(values):
    return [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in values]


def compare(found, values, count=8):
    x = whole_numbers(values)
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    z = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    rows = {(r["vec_id"], r["component"]): r for r in found}
    k = min(count, d)
    assert len(rows) == len(found) == n * k
    for i in range(n):
        r = rows[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
    for c in range(1, k + 1):
        got = np.array([rows[i, c]["whitened"] for i in range(n)])
        want = z @ u[:, c - 1] / np.sqrt(e[c - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert rows[0, c]["explained"] == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-10


def test_whitening_is_that_of_the_covariance(spark):
    values = random_vectors(90, 11)
    compare(whitening.whiten(vectors(spark, values)).collect(), values)
    few = random_vectors(40, 3)
    compare(whitening.whiten(vectors(spark, few).repartition(7)).collect(), few)


def test_vectors_that_cannot_be_used_are_left_out(spark):
    values = random_vectors(60, 9)
    odd = [None, [], [1.0, None] + [0.0] * 7, [float("nan")] * 9, [float("inf")] + [0.0] * 8, [0.5] * 4]
    both = vectors(spark, values).union(vectors(spark, odd, 1000))
    compare(whitening.whiten(both).collect(), values)


def test_no_rows_without_variance(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for values in ([], [None], [[0.1, 0.2]], [[0.1, 0.2]] * 5):
        found = whitening.whiten(vectors(spark, values))
        assert found.columns == names and found.collect() == []


def test_repeated_eigenvalues_and_lower_rank(spark):
    # Corners of a cube in the first three of five dimensions: three equal eigenvalues, two of zero.
    values = [[a, b, c, 0.25, 0.5] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    found = whitening.whiten(vectors(spark, values)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    assert all(r["explained"] == pytest.approx(1 / 3) for r in found) and found[0]["identity_error"] < 1e-12


def test_huge_entries_stay_exact(spark):
    values = [[3.0e38, 0.0], [-3.0e38, 0.25], [0.0, 0.5]]
    found = whitening.whiten(vectors(spark, values)).collect()
    assert {r["vec_id"] for r in found} == {0, 1, 2} and any(r["deviation"] is None for r in found)


def test_polynomial_roots_and_close_eigenvalues(spark):
    draw = random.Random(1)
    b = np.array([[draw.randrange(-50, 50) for _ in range(6)] for _ in range(9)], object)
    m = b.T @ b
    found = whitening.characteristic_polynomial(spark, m)
    # Faddeev and LeVerrier, in integers.
    want, step, d = [1], np.zeros((6, 6), object), 6
    for k in range(1, d + 1):
        step = m @ step + want[-1] * np.eye(d, dtype=int).astype(object)
        want.append(-sum((m @ step)[i, i] for i in range(d)) // k)
    assert found == want[::-1]
    # (t - 5)^2 (t - 5000001/1000000): a double root and one a millionth beside it.
    close = np.poly1d([1, -5]) * np.poly1d([1, -5]) * np.poly1d([1, -6])
    roots, bits = whitening.largest_roots([int(c) for c in close.c[::-1]], 16, 3)
    assert [r / 2 ** bits for r in roots] == [6, 5, 5]


# --- 12: archives ---

PAGES = "page_id long, url string, html string, record_type string, problem string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def some_pages(n=120):
    draw = random.Random(4)
    words = ["<p>", "</p>", "maß", "été", "word", "\r\n\r\n", "WARC/1.1", "P*M\x18\x00\x00\x00\x00", "x" * 40]
    out = [(i, f"http://h{i % 3}/a b\r\n{i}", " ".join(draw.choice(words) for _ in range(draw.randrange(80)))) for i in range(n)]
    out += [(n + i, "http://copy/", "the same page") for i in range(40)]
    return out + [(900, None, None), (901, "http://empty/", ""), (902, "http://long/", "long \x00 " * 900_000), (None, "u", "the same page"), (None, None, "alone")]


def expected(rows, least=0):
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        known = [j for j in groups[h or ""] if j is not None]
        top = max(known) if known and len(data) >= least else i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 14])
def test_archives_give_back_what_was_written(spark, least):
    rows = some_pages()
    found = warc.round_trip(pages(spark, rows).repartition(3), min_bytes=least)
    got = sorted(map(tuple, found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == expected(rows, least)
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in found.where("record_type = 'response'").collect()}
    assert all(texts[i] == (h or "") for i, _, h in rows if i in texts and i is not None)


def test_files_are_plain_zstandard_with_a_dictionary_in_front(spark, folder):
    warc.write_archives(warc.mark_revisits(pages(spark, some_pages()).select("page_id", "url", "html").coalesce(1)), f"{folder}/a")
    files = spark.read.format("binaryFile").load(f"{folder}/a").collect()
    assert len(files) > 1  # the long page ends an archive
    for row in files:
        data = bytes(row["content"])
        if data[:4] == warc.DICTIONARY_MAGIC:
            size = int.from_bytes(data[4:8], "little")
            trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
        else:
            trained = None
        reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(data, read_across_frames=True)
        assert reader.read().startswith(b"WARC/1.1\r\n")
    assert any(bytes(r["content"])[:4] == warc.DICTIONARY_MAGIC for r in files)


def test_empty_tables_and_repeated_rows(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
    found = warc.round_trip(pages(spark, [(1, "u", "a"), (1, "u", "a"), (0, "u", "a")])).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in found) == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


def one(data):
    return [r[-1] for r in warc.records_of(data)]


def test_bad_records_and_frames_are_named():
    good = warc.record(1, "u", b"payload", True)
    frame = zstandard.ZstdCompressor(write_checksum=True).compress
    assert one(frame(good)) == [None]
    for old, new, said in ((b"WARC/1.1", b"WARC/9.1", "version"), (b"WARC-Date", b"Warc-Day", "no header"), (b"payload\r\n", b"payloaf\r\n", "block digest"),
                           (b"\r\n\r\nHTTP", b"\r\nContent-Length: 1\r\n\r\nHTTP", "repeated")):
        assert said in one(frame(good.replace(old, new)))[0]
    assert "Content-Length" in one(frame(good + b"x"))[0] and "Content-Length" in one(frame(good[:-6]))[0]
    assert "refers" in one(frame(warc.record(1, "u", b"p", False, 2).replace(b"WARC-Refers-To", b"WARC-Refers-Of")))[0]
    # The record after a bad one is read; after a frame that cannot be decoded nothing is.
    assert one(frame(good + b"x") + frame(good))[1] is None
    cut = frame(good)
    assert len(one(cut[:-3])) == 1 and one(cut[:-3])[0] is not None
    assert "byte 0" in one(b"garbage" + frame(good))[0]
    # A dictionary that is not compressed, and no dictionary where one is needed.
    learnt = zstandard.train_dictionary(2048, [warc.record(i, "u" * (i % 7), b"some payload %d" % (i * 37), True) for i in range(200)])
    packed = zstandard.ZstdCompressor(dict_data=learnt).compress(good)
    raw = learnt.as_bytes()
    assert one(warc.DICTIONARY_MAGIC + len(raw).to_bytes(4, "little") + raw + packed) == [None]
    assert one(packed)[0] is not None


def test_a_bad_archive_ends_the_query(spark, folder):
    data = zstandard.ZstdCompressor().compress(warc.record(1, "u", b"p", True) + b"x")
    with open(f"{folder}/a.warc.zst", "wb") as f:
        f.write(data)
    found = warc.read_archives(spark, folder)
    assert found.count() == 1 and "Content-Length" in found.first()["problem"]
    with pytest.raises(Exception, match="Content-Length"):
        found.where(warc.sound()).collect()


# --- 13: divergence of sources ---

def audited(rows, min_df=3, size=None, top=200):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    df, total, sums = collections.Counter(), collections.Counter(), collections.Counter()
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = collections.Counter(word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
        for t, n in found.items():
            df[lang, t] += 1
            total[lang, t] += n
            sums[lang, source, t] += n
    kept = collections.defaultdict(list)
    for (lang, t), n in sorted(df.items(), key=lambda e: (-total[e[0]], e[0][1].encode())):
        if n >= min_df and (size is None or len(kept[lang]) < size):
            kept[lang].append(t)

    def shares(lang, of):
        v, words = len(kept[lang]), sum(of(t) for t in kept[lang])
        return {t: 1 + 10**9 * (of(t) + 1) // (words + v) for t in kept[lang]}

    out = []
    for lang, source in groups:
        mine, whole = shares(lang, lambda t: sums[lang, source, t]), shares(lang, lambda t: total[lang, t])
        pairs = []
        for other in {s for g, s in groups if g == lang} - {source}:
            q = shares(lang, lambda t: sums[lang, other, t])
            pairs.append((other, sum((mine[t] - q[t]) ** 2 // q[t] for t in mine)))
        terms = [(t, (mine[t] - whole[t]) ** 2 // whole[t]) for t in mine if sums[lang, source, t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda e: (-e[1], e[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def some_documents(n=150):
    draw = random.Random(8)
    words = ["the", "The", "Été", "ß", "a1b", "don't", "日本", "z"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(draw.choice(words[:draw.randrange(1, len(words))]) for _ in range(draw.randrange(40))),
             draw.choice(["en", "de", None]), draw.choice(["s0", "s0", "s0", "s1", "s2", None, ""])) for _ in range(n)]
    return rows + [(None, "en", "s9"), ("", "xx", "s0"), ("12 34 !", "xx", "s1"), ("only here", "xx", "s2"), ("the " * 300_000, "en", "long")] + rows[:5] * 2


@pytest.mark.parametrize("options", [{}, {"min_df": 1}, {"min_df": 2, "vocab_size": 7}, {"top": 3}])
def test_divergence_is_that_of_dense_vectors(spark, options):
    rows = some_documents()
    docs = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string")
    found = divergence.audit(docs.repartition(4), **options)
    assert sorted(map(tuple, found.collect())) == audited(rows, options.get("min_df", 3), options.get("vocab_size"), options.get("top", 200))


def test_divergence_of_nothing(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []
    lone = divergence.audit(spark.createDataFrame([("a b", "en", "s")], schema))
    assert lone.collect() == [] and lone.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_beyond_64_bits(spark):
    row = spark.range(1).select(F.lit(8 * 10**12).alias("n"), F.lit(16 * 10**12).alias("w"), F.lit(10).cast("long").alias("v"))
    assert row.select(divergence.share("n", "w", "v")).first()[0] == 1 + 10**9 * (8 * 10**12 + 1) // (16 * 10**12 + 10)
