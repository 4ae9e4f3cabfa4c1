"""Operators that judge whole texts, beside plain versions of their definitions."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeworks.llm import bpe, decontaminate, pii, ppm, quality, substring
from lakeworks.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def some_texts(seed=3, n=60):
    """Texts of few words, so that windows repeat within and across them; nulls, blanks, copies and a very long one."""
    draw = random.Random(seed)
    words = ["The", "the", "cat", "Été", "x1", "a", "of", "ß", "sat.", "on-it", "42"]
    phrase = [draw.choice(words) + str(i) for i in range(40)]
    out = [None, "", " \t\n ", "one", "lone\x0bverse\x0cwith\x1cother\x85marks"]
    for _ in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(1, 60))]
        at = draw.randrange(len(text))
        text[at:at] = phrase[draw.randrange(10):draw.randrange(12, 40)]
        out.append(draw.choice([" ", "  ", "\n", "  "]).join(text))
    return out + [out[8], out[9], "same " * 3000 + " ".join(phrase)]


def table(spark, texts, **more):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.select("*", *(F.lit(v).alias(k) for k, v in more.items()))


# --- 3: decontamination ---

def contaminated(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known, sizes = collections.defaultdict(set), set()
    for i, t in items:
        w = word.findall(low(t))
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            known[tuple(w[s:s + n])].add(str(i))
            sizes.add(n)
    for t in docs:
        w = word.findall(low(t))
        hit, found = [0] * len(w), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (own := known.get(tuple(w[s:s + n]))):
                    hit[s:s + n] = [1] * n
                    found |= own
        yield len(w), sum(hit), sorted(found)


def test_contamination_by_definition(spark):
    texts = some_texts()
    items = [(i, t) for i, t in enumerate(some_texts(9, 12))] + [(100, texts[7]), (101, "CAT a"), (102, "sat"), (102, "of of of"), (103, texts[7])]
    out = decontaminate.contamination(table(spark, texts, n_words="x", spans=1, lang="en"),
                                      spark.createDataFrame(items, "item_id long, text string"))
    assert "lang" in out.columns
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in out.collect()}
    assert got == dict(enumerate(contaminated(texts, items)))


def test_contamination_of_empty_tables(spark):
    docs, items = table(spark, ["a b", None]), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, items).collect()] == [0, 0]
    assert decontaminate.contamination(docs.where("false"), items).collect() == []


# --- 4: repeated windows ---

def kept_words(rows, n):
    seen = set()
    for key in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        w = re.findall(r"[^\x20\x09-\x0D]+", key[1] or "")
        covered = [0] * len(w)
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in seen:
                covered[i:i + n] = [1] * n
            seen.add(tuple(w[i:i + n]))
        yield key[0], len(w), sum(covered), " ".join(x for x, c in zip(w, covered) if not c)


@pytest.mark.parametrize("window,base", [(20, 5), (20, 10), (7, 2), (3, 5)])
def test_repeats_by_definition(spark, window, base):
    texts = some_texts()
    rows = list(enumerate(texts)) + [(None, texts[10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x"))
    out = substring.remove_repeats(docs, window=window, base=base, kept="kept").collect()
    want = sorted(kept_words(rows, window), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out), key=str) == want
    assert all(r.kept_sha256 == sha(r.kept) for r in out)


def test_repeats_of_equal_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = table(spark, [text, text]).withColumn("doc_id", F.lit(7))
    assert [r.n_removed for r in substring.remove_repeats(docs).collect()] == [0, 0]  # equal rows are one document
    assert substring.remove_repeats(docs.where("false")).collect() == []


# --- 5: language model ---

def test_base_score_by_definition(spark, monkeypatch):
    texts = some_texts()
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", low(t)) + [None] for t in texts]
    counts = collections.Counter(w for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 5 != 1 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for cached in (1 << 20, 8, 0):  # with a small cache most words go through the join
        monkeypatch.setattr(ppm, "CACHED", cached)
        for r in ppm.score(table(spark, texts)).collect():
            own = tokens[r.doc_id]
            base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
            assert r.base_score == pytest.approx(base) and r.n_tokens == len(own) and r.train_tokens == total
            assert r.n_known == sum(counts[w] > 0 for w in own) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
            assert r.score < 0 and math.isfinite(r.score)


def stream(text):
    """Symbols of a text, and its endings: ``(first symbol, beginning, rest of the word with what follows)``."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", low(text).encode())
    symbols, endings, at = list(b" ".join(words)) + [ppm.END], [], 0
    for w in words:
        if len(w) >= 4:
            endings.append((at + 4, w[:4], bytes(symbols[at + 4:at + len(w) + 1])))
        at += len(w) + 1
    return symbols, endings


def contexts_of(symbols, i):
    return [bytes(([ppm.PAD] * 4 + symbols[:i])[i + 4 - k:i + 4]) for k in range(4, -1, -1)]


def train_by_definition(texts):
    trie, begun = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text in texts:
        symbols, endings = stream(text)
        for i, s in enumerate(symbols):
            for c in contexts_of(symbols, i):
                trie[c][s] += 1
        for _, beginning, rest in endings:
            begun[beginning][rest] += 1
    return trie, begun


def score_by_definition(trie, begun, text):
    symbols, endings = stream(text)
    odds = [math.log10(odds_by_definition(trie, contexts_of(symbols, i), s)) for i, s in enumerate(symbols)]
    for at, beginning, rest in endings:
        if seen := begun.get(beginning):
            escape = sum(n == 1 for n in seen.values()) + 0.5
            weight = sum(seen.values()) + escape
            if rest in seen:
                odds[at:at + len(rest)] = [math.log10(seen[rest] / weight)] + [0] * (len(rest) - 1)
            else:
                odds[at] += math.log10(escape / weight)
    return sum(odds)


def odds_by_definition(trie, contexts, s):
    """Down the contexts, without the symbols ruled out so far."""
    out, total = set(), 1.0
    for c in contexts:
        seen = trie.get(c)
        if not seen:
            continue
        left = {x: n for x, n in seen.items() if x not in out}
        escape = sum(n == 1 for n in seen.values()) + 0.5
        weight = sum(left.values()) + escape
        if s in left:
            return total * left[s] / weight
        total *= escape / weight
        out |= seen.keys()
    return total / max(255 - len(out), 1)


@pytest.mark.parametrize("cached", [1 << 20, 20, 0])
def test_score_by_definition(spark, monkeypatch, cached):
    """All counted contexts are used, whether cached or joined; held-out texts have words and contexts of their own."""
    monkeypatch.setattr(ppm, "CACHED", cached)
    texts = some_texts() + [f"unheard{i} of-word{i % 7}s Sentences {'x' * (i + 10)}y internationalisation internationalisations {i}" for i in range(30)]
    trie, begun = train_by_definition(t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1)
    got = {r.doc_id: r.score for r in ppm.score(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(score_by_definition(trie, begun, t), rel=1e-9), (i, t)


def test_odds_of_all_symbols_add_up():
    texts = some_texts(n=10)
    trie, _ = train_by_definition(texts)
    for text in texts[:9]:
        symbols, _ = stream(text)
        for i in range(min(len(symbols), 60)):
            assert sum(odds_by_definition(trie, contexts_of(symbols, i), s) for s in range(256) if s != ppm.PAD) == pytest.approx(1)


def test_symbols_of_texts():
    assert ppm.Streams([b" A  b\n"]).symbols.tobytes() == b"\xfe" * 4 + b"a b\xff" and ppm.Streams([b""]).symbols.tobytes() == b"\xfe" * 4 + b"\xff"


def test_adaptive_score(spark):
    repeated, mixed = ppm.adaptive_score(b"ab " * 50), ppm.adaptive_score(bytes(random.Random(1).choices(range(97, 123), k=150)))
    assert repeated > mixed and ppm.adaptive_score(b"") == pytest.approx(-math.log10(255))
    out = ppm.score(table(spark, ["a b a b", None]), adaptive=True).collect()
    assert [r.score for r in sorted(out)] == pytest.approx([ppm.adaptive_score(b"a b a b"), ppm.adaptive_score(b"")])


def test_model_without_training_texts(spark):
    docs = table(spark, ["a", None])
    unseen = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    assert ppm.score(docs.where("false")).collect() == []
    for r in ppm.score(docs.withColumn("doc_id", F.lit(unseen))).collect():
        assert r.held_out and r.base_score == 0 and r.score == pytest.approx(-r.n_tokens * math.log10(255))  # "a" and the end, or the end


# --- 6: personal data ---

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in re.findall("[0-9]", m[0])]
            check = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            if {"email": True, "ip": all(int(x) <= 255 for x in re.findall("[0-9]+", m[0])),
                    "card": 14 <= len(digits) <= 19 and check % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]:
                yield m.start(), m.end(), kind


def test_rules_by_definition():
    draw = random.Random(2)
    for _ in range(5000):
        text = "".join(draw.choice("0123456789 .-+()@ab_%\né") for _ in range(draw.randrange(45)))
        assert sorted(base_spans(text), key=pii._order) == pii.rule_spans(text)
    assert pii.rule_spans("9" * 100_000 + "@" + "a" * 100_000) == []


def people(n=300):
    draw = random.Random(4)

    def card():
        digits = [4] + [draw.randrange(10) for _ in range(14)]
        return "".join(map(str, next(d for c in range(10) if pii.luhn(d := digits + [c]))))

    phone = lambda: f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
    out = [f"Call {phone()} or mail a{i}@b.example.com about {card()} from {draw.randrange(256)}.1.2.3, lot {draw.randrange(10 ** 9)}" for i in range(n)]
    return out, f"é {phone()} {card()} end"


def test_trees_add_what_the_rules_lose(spark):
    texts, glued = people()
    docs = table(spark, [*texts, glued, None, "", "no digits"], spans="x")
    models = pii.train(docs, "text")
    out = {r.doc_id: r for r in pii.add_spans(docs, "text", models, redacted="clean").collect()}
    n = len(texts)
    assert out[n].rule_spans == [] and [s.kind for s in out[n].spans] == ["phone", "card"] and out[n].clean == "é [PHONE] [CARD] end"
    assert all(out[i].spans == out[i].rule_spans for i in range(n)) and out[n + 1].clean is None and out[n + 2].clean == ""
    assert [r.spans for r in pii.add_spans(docs.where("false"), "text", pii.train(docs.where("false"), "text")).collect()] == []


def test_trees_add_spans_of_every_kind(spark):
    texts, _ = people(400)
    models = pii.train(table(spark, texts), "text")
    assert all(m.threshold <= 1 for m in models.values())
    draw = random.Random(9)
    planted, wanted = [], []
    for i in range(200):
        a, b = f"a{draw.randrange(400)}", draw.randrange(256)
        for form, kind in ((f"{a} at b dot example dot com", "email"), (f"{a} [at] b.example.com", "email"), (f"{b}.1.2[.]3", "ip"), (f"{b} dot 1 dot 2 dot 3", "ip")):
            planted.append(f"about it {form} from, lot {draw.randrange(10 ** 6)}")
            wanted.append((9, 9 + len(form), kind))
    found = pii.add_spans(table(spark, planted), "text", models).orderBy("doc_id").collect()
    assert all(r.rule_spans == [] for r in found)
    right = sum((tuple(w) in [tuple(s) for s in r.spans]) for r, w in zip(found, wanted))
    added = sum(len(r.spans) for r in found)
    assert right >= 0.95 * len(wanted) and right >= 0.98 * added
    clean = ["we met at noon. Then at the house. It was 12.5 at 7.30", "look at this.that", "version 1.2.3.4.5.6 of 2020", "part 123 456 789 of it", "999.1.2.3 and 1.2.3"]
    assert all(r.spans == r.rule_spans for r in pii.add_spans(table(spark, clean), "text", models).collect())


def test_long_numbers_and_many_spans():
    assert pii.rule_spans("0" * 5000 + "1.1.1.1") == [(0, 5007, "ip")] and pii.rule_spans("9" * 5000 + ".1.1.1") == []
    text = "mail a.b@c.example.com or +1 (743) 555-3824 1.2.3.4 x at y dot org; " * 5_000  # 350 KB, 15,000 spans
    start = time.process_time()
    spans = pii.rule_spans(text)
    labels = sum(1 for _ in pii._labelled(text))
    assert pii.all_spans(text, spans, {k: pii.Trees() for k in pii.KINDS}) == spans and labels > len(spans) == 15_000
    model = pii.Trees()
    model.threshold = 0.4
    assert len(pii.all_spans(text, spans, dict.fromkeys(pii.KINDS, model))) > len(spans)
    for hard in ("1 " * 10_000 + "a", "a dot " * 100_000 + "at b", "a at " * 100_000, "@" * 300_000, "+1" + "(" * 300_000, "1." * 300_000, "+1" * 200_000):
        pii.rule_spans(hard), sum(1 for _ in pii.candidates(hard))
    assert time.process_time() - start < 60


def test_redaction_of_overlaps():
    assert pii.redact("abcdef", [(0, 3, "card"), (0, 5, "phone"), (4, 6, "ip")]) == "[PHONE]"
    assert pii.redact("a é b", [(2, 3, "ip")]) == "a [IP] b"


# --- 9: BPE ---

def test_ids_and_texts_equal_the_library(spark):
    library = Tokenizer.from_file(TOKENIZER)
    library.no_truncation()
    library.no_padding()
    draw = random.Random(6)
    odd = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endo", "  two  spaces \n\n x", "don't I'LL 's", "２３ ½ Ⅷ 漢字🙂👩‍👧", "\x00\x1c\x85　 w", "zq" * 5000]
    odd += ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(0xD800), 32, 32, 10])) for _ in range(25)) for _ in range(200)]
    texts = some_texts() + odd
    docs = table(spark, texts, n_tokens="x", _text=1)
    for r in bpe.add_tokens(docs, "text", TOKENIZER, ids="ids", decoded="back", digest=True).collect():
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.back == library.decode(want, skip_special_tokens=False) == (texts[r.doc_id] or "")
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), sha(r.back))
    assert bpe.add_tokens(docs.where("false"), "text", TOKENIZER, ids="ids").collect() == []


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tops", "tap", "taps", "top", "stop", "stops", "é"])}
    block = bpe.compile_lexicon(words)
    (tmp_path / "lexicon").write_bytes(block)
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    assert all(lexicon.find(w) == ids for w, ids in words.items())
    assert lexicon.find(b"to") is None and lexicon.find(b"topss") is None and lexicon.find(b"") is None
    # "tap(s)", "top(s)" and "stop(s)" share their ends: start, s, s-t, p-node, p-end ... by hand nine states.
    assert len(lexicon.final) <= 9


def test_unseen_words_are_looked_up_and_merged_together(tmp_path, monkeypatch):
    with open(TOKENIZER, "rb") as f:
        merges = bpe.Merges(f.read())
    draw = random.Random(8)
    words = list(dict.fromkeys("".join(draw.choices("etaoinsrhé\u00df漢'&.\n7", k=draw.randrange(1, 30))) for _ in range(3000)))
    packed = [np.array(merges.merge(w.encode()), "<u4").tobytes() for w in words]
    assert merges.merge_many([w.encode() for w in words]) == packed
    listed = {(" " + w).encode(): merges.merge((" " + w).encode()) for w in words[:500] if w.isalpha()}
    (tmp_path / "lexicon").write_bytes(bpe.compile_lexicon(listed))
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    asked = [(" " + w).encode() for w in words] + [b"", *(w[:-1] for w in listed)]
    assert [None if p is None else np.frombuffer(p, "<u4").tolist() for p in lexicon.find_many(asked)] == [lexicon.find(w) for w in asked]

    def alone(*_):
        raise AssertionError("a word at a time")

    library = Tokenizer.from_file(TOKENIZER)
    texts = ["The " + " ".join(w for w in words[i::100] if "\n" not in w) for i in range(100)]
    encoder = bpe._Encoder(merges, lexicon)
    encoder.whole["The"]
    monkeypatch.setattr(lexicon, "find", alone)
    monkeypatch.setattr(merges, "merge", alone)
    found = [np.frombuffer(p, "<u4").tolist() for p in encoder.encode_many(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


# --- 10: quality ---

def graded(n=400):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randrange(2, 8)))
    good = [" ".join(word() for _ in range(60)) + "." for _ in range(n)]
    bad = [" ".join(draw.choice(["BUY!!", "NOW%%%", "win$$$"]) + word() for _ in range(60)) for _ in range(n)]
    return [t for pair in zip(good, bad) for t in pair]


def test_held_out_accuracy_and_identity(spark):
    texts = graded()
    docs = table(spark, [*texts, None, ""], score="x").withColumn("n_chars", F.length("text"))
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(len(texts))] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, "doc_id", "text", "n_chars", "quality", most=300)
    out = quality.add_score(docs, model, "text", "n_chars").select("*", quality.held_out(F.col("doc_id")).alias("h")).collect()
    held = [r for r in out if r.h and r.doc_id < len(texts)]
    assert len(held) > 100 and sum(r.predicted == 1 - r.doc_id % 2 for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out) and len(out) == len(texts) + 2
    # The linear-time form equals the sum over all pairs.
    f = quality.Features([t.encode() for t in texts[:3]], np.zeros(3))
    index, value, first, _ = model.sparse(f)
    got, _ = model.margin(index, value, first)
    for r in range(3):
        i, x = index[first[r]:first[r + 1]], value[first[r]:first[r + 1]]
        pairs = sum(model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert got[r] == pytest.approx(model.bias + model.linear[i] @ x + pairs)


def test_quality_without_labels(spark):
    docs = table(spark, ["a b", None])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, labels, "doc_id", "text", None, "quality")
    assert [r.score for r in quality.add_score(docs, model, "text", None).collect()] == [0.5, 0.5]
    assert quality.add_score(docs.where("false"), model, "text", None).collect() == []


# --- the queries' columns ---

COLUMNS = {
    "op1_url_filter": ["page_id", "host", "path", "rule", "verdict"], "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5_ppm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_html": ["page_id", "url", "text", "n_chars"], "op8_embeddings": ["vec_id", "n_links", "component_id", "kept"],
    "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op10_quality": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_a_row_for_every_input_row(spark, sf, name):
    source = {"op1": "pages", "op7": "pages", "op8": "embeddings"}.get(name.split("_")[0], "documents")
    out = QUERIES[name](spark, sf)
    assert set(COLUMNS[name]) <= set(out.columns)
    assert all(t == "bigint" for c, t in out.dtypes if c.startswith("n_") or c in ("train_tokens", "component_id"))
    assert out.count() == spark.read.parquet(f"{sf}/{source}.parquet").count()
