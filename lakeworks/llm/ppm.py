"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is its words in small ASCII letters, one space between them, and an end symbol.
Each symbol is predicted from the last ``ORDER`` bytes before it and ever fewer. The
longest context seen in training is asked first; a symbol it has not seen is escaped to
the next shorter one, where the symbols already ruled out are excluded, down to equal
odds for all symbols. The weight of the escape is the number of symbols seen once, as one
unseen so far is as likely, and ``LEAST_ESCAPE``. After the first ``ORDER`` bytes of a
word a longer context is asked before: those bytes as the beginning of a word. Its
symbols are whole endings, with the space or the end after them; an ending it has not
seen is escaped to the contexts above, byte by byte and with nothing excluded.

Pretrained: the counts of all contexts come from all training texts and none is left out.
They are counted where the texts are and summed by key. The trie is a table per order, a
row per context and symbol that occurs in any text. As the symbols of a context are all
known to the shorter one, what exclusion takes away is a sum per context, and a
probability follows from that of the next shorter order in one join, from order 0 up.
Endings have one value per word, so a text meets the trie by its words and by the
remaining positions. Words and contexts that occur most are looked up where the text is (at most ``CACHED`` of each are broadcast); all
others meet their values in a join. Both ways give the same score at any size of the
cache. Adaptive: each text is coded by itself with a trie that grows as it is read.

The base score is a word unigram model, by the same look-up and join. Words are told
apart by 64-bit hashes there.

Defined cases: a null or empty text is the end symbol alone; without training texts all
symbols have equal odds and the base score is zero; equal rows get equal scores; a null
id is not held out; a very long text is handled whole, by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import discard, stored
from .text import SPACES, Words, row_slices

ORDER = 4
LEAST_ESCAPE = 0.5
# Words, and contexts with their symbol, that are broadcast; the others meet the texts in a join.
CACHED = 1 << 19

# Bytes that no UTF-8 text has.
PAD, END = 0xFE, 0xFF
SYMBOLS = 255  # all bytes but PAD; END stands for the end

# Kinds of counts: contexts of ``ORDER`` bytes with the next, words, texts.
BYTES, WORDS, TEXTS = 0, 1, 2


class Streams:
    """Symbols of some texts in one array: per text ``ORDER`` pads, then its bytes and the end."""

    def __init__(self, texts: list[bytes]):
        self.words = w = Words(texts, SPACES, lower=True)
        inside = np.zeros(len(w.bytes) + 1, np.int8)
        inside[w.starts] += 1
        inside[w.ends] -= 1
        keep = np.cumsum(inside[:-1]).astype(bool)
        keep[w.ends] = True  # one separator after each word
        values = w.bytes.copy()
        values[w.ends] = 0x20
        some = w.counts > 0
        values[w.ends[w.first[1:][some] - 1]] = END
        per_text = np.zeros(len(texts), np.int64)
        lengths = w.ends - w.starts + 1
        if len(w):
            per_text[some] = np.add.reduceat(lengths, w.first[:-1][some])
        self.sizes = np.maximum(per_text, 1)
        self.begins = np.cumsum(self.sizes + ORDER) - self.sizes  # of the bytes after the pads
        self.symbols = np.full(int(self.begins[-1] + self.sizes[-1]) if len(texts) else 0, PAD, np.uint8)
        self.symbols[self.begins[~some]] = END
        place = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.symbols[np.repeat(self.begins, per_text) + place] = values[keep]
        self.at = np.arange(self.sizes.sum()) + np.repeat(self.begins - (np.cumsum(self.sizes) - self.sizes), self.sizes)

    def grams(self) -> np.ndarray:
        """The context and the symbol of every position as one number, the symbol in the lowest byte."""
        total = np.zeros(len(self.symbols), np.uint64)
        for j in range(ORDER, -1, -1):
            total[ORDER:] |= self.symbols[ORDER - j:len(self.symbols) - j].astype(np.uint64) << np.uint64(8 * j)
        return total[self.at]

    def word_hashes(self) -> np.ndarray:
        return self.words.hashes()

    def last_words(self) -> np.ndarray:
        """Which words are the last of their text."""
        last = np.zeros(len(self.words), bool)
        last[self.words.first[1:][self.words.counts > 0] - 1] = True
        return last

    def by_words(self) -> np.ndarray:
        """Which positions belong to the ending of a word."""
        w = self.words
        lengths, row = w.ends - w.starts, w.row()
        before = np.cumsum(lengths + 1) - (lengths + 1)
        at = self.begins[row] + before - before[w.first[:-1][row]]
        long = lengths >= ORDER
        change = np.zeros(len(self.symbols) + 1, np.int8)
        change[at[long] + ORDER] = 1
        change[(at + lengths)[long] + 1] = -1
        return np.cumsum(change[:-1], dtype=np.int8)[self.at] > 0


class _Tally:
    """Counts of 64-bit keys, merged as they come."""

    def __init__(self):
        self.keys, self.counts, self.late, self.late_size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        found, n = np.unique(keys, return_counts=True)
        self.late.append((found, n * weight))
        self.late_size += len(found)
        if self.late_size > max(4_000_000, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.late)])
        counts = np.concatenate([self.counts, *(c for _, c in self.late)])
        self.late, self.late_size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts


# A task hands on its tallies when they hold this many keys, so its memory is bounded.
TALLY_KEYS = 4_000_000


def count(rows: DataFrame, text: str, held_out: str) -> DataFrame:
    """``kind, key, word, n, n_last``: contexts of ``ORDER`` bytes with their symbol, words and texts.

    What occurs in any text has a row; counts are those of training texts alone, so they
    may be 0. A word comes with its hash as key; ``n`` is about words before a space and
    ``n_last`` about words before the end, null where no text has that.
    """

    def batch_of(kind: int, keys: np.ndarray, words: pa.Array, n: pa.Array, n_last: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), words, n, n_last],
                                          ["kind", "key", "word", "n", "n_last"])

    def plain_batch(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return batch_of(kind, keys, pa.nulls(len(keys), pa.binary()), pa.array(n, pa.int64()), pa.nulls(len(keys), pa.int64()))

    def gram_batches(tally: _Tally) -> Iterator[pa.RecordBatch]:
        tally.merge()
        for i in range(0, len(tally.keys), 200_000):
            yield plain_batch(BYTES, tally.keys[i:i + 200_000], tally.counts[i:i + 200_000])

    def word_batch(words: dict[bytes, list[int | None]], hashes: dict[bytes, int]) -> pa.RecordBatch:
        keys = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        return batch_of(WORDS, keys, pa.array(list(words), pa.binary()), *(pa.array([n[i] for n in words.values()], pa.int64()) for i in (0, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, words, hashes, n_texts = _Tally(), {}, {}, 0
        for batch in batches:
            held = batch.column(1).to_pylist()
            for first, texts in row_slices(batch.column(0)):
                for weight in (0, 1):
                    own = [t for t, h in zip(texts, held[first:first + len(texts)]) if h is not bool(weight)]
                    if not own:
                        continue
                    n_texts += weight * len(own)
                    streams = Streams(own)
                    tally.add(streams.grams(), weight)
                    every, last = streams.word_hashes(), streams.last_words()
                    for place, some in enumerate((np.flatnonzero(~last), np.flatnonzero(last))):
                        found, at, n = np.unique(every[some], return_index=True, return_counts=True)
                        for value, i, m in zip(found.tolist(), some[at].tolist(), n.tolist()):
                            word = streams.words.word(i)
                            held_n = words.setdefault(word, [None, None])
                            held_n[place] = (held_n[place] or 0) + m * weight
                            hashes[word] = value
                if len(tally.keys) + tally.late_size > TALLY_KEYS:
                    yield from gram_batches(tally)
                    tally = _Tally()
                if len(words) > TALLY_KEYS // 8:
                    yield word_batch(words, hashes)
                    words, hashes = {}, {}
        yield from gram_batches(tally)
        yield word_batch(words, hashes)
        yield plain_batch(TEXTS, np.zeros(1, np.int64), np.array([n_texts]))

    return (rows.select(text, held_out).mapInArrow(run, "kind int, key long, word binary, n long, n_last long")
            .groupBy("kind", "key", "word").agg(F.sum("n").alias("n"), F.sum("n_last").alias("n_last")))


def _order(cells: DataFrame) -> DataFrame:
    """One order of the trie: ``key, n, tail, start`` per context and symbol, and ``total, escape`` of the context.

    ``cells`` has the counts, beside those of the same symbol in the next shorter context
    (``up_*``). ``tail`` is the logarithm of what a longer context shares out on an escape
    to this one, and ``start`` the log10 probability if this context is asked first.
    """
    of = Window.partitionBy(F.shiftright("key", 8))  # a row per symbol, 255 at most
    seen = F.col("n") > 0
    stats = cells.withColumns({
        "total": F.sum("n").over(of), "escape": F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).over(of) + F.lit(LEAST_ESCAPE),
        # What the shorter context has for symbols that this one has not.
        "left": F.col("up_total") - F.sum(F.when(seen, F.col("up_n")).otherwise(0)).over(of) + F.col("up_escape")})
    stats = stats.withColumn("tail", F.when(seen, F.log10("n")).otherwise(F.log10("escape") - F.log10("left") + F.col("up_tail")))
    start = F.when(F.col("total") > 0, F.col("tail") - F.log10(F.col("total") + F.col("escape"))).otherwise(F.col("up_start"))
    return stats.select("key", "n", "total", "escape", "tail", start.alias("start"))


def byte_trie(counts: DataFrame) -> DataFrame:
    """``key, n, start`` of every context of ``ORDER`` bytes with its symbol, which is the lowest byte of the key."""
    cells = {ORDER: counts.where(F.col("kind") == BYTES).select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        cells[k] = cells[k + 1].groupBy(F.col("key").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("key")).agg(F.sum("n").alias("n"))
    known = cells[0].where("n > 0").count()
    equal = F.lit(-float(np.log10(max(SYMBOLS - known, 1))))
    base = cells[0].select("*", F.lit(0).alias("up_n"), F.lit(0).alias("up_total"), F.lit(1.0).alias("up_escape"), equal.alias("up_tail"), equal.alias("up_start"))
    trie = _order(base)
    for k in range(1, ORDER + 1):
        up = trie.select(F.col("key").alias("up"), *(F.col(c).alias(f"up_{c}") for c in ("n", "total", "escape", "tail", "start")))
        trie = _order(cells[k].withColumn("up", F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))).join(up, "up").drop("up"))
    return trie.select("key", "n", "start")


def word_values(counts: DataFrame, trie: DataFrame) -> DataFrame:
    """``key, n, inner_tail, last_tail`` of every word: its count, and log10 of the odds of its ending before a space and before the end."""
    words = counts.where(F.col("kind") == WORDS).select("key", "word", "n", "n_last")
    zero, root = F.lit(0), F.substring("word", F.lit(1), F.lit(ORDER)).alias("root")
    long = words.where(F.length("word") >= ORDER)
    once = (F.when(F.col("n") == 1, 1).otherwise(0) + F.when(F.col("n_last") == 1, 1).otherwise(0))
    begun = long.groupBy(root).agg(F.sum(F.coalesce("n", zero) + F.coalesce("n_last", zero)).alias("total"), (F.sum(once) + F.lit(LEAST_ESCAPE)).alias("escape"))
    # Endings of held-out texts alone go by their bytes.
    unseen = [long.where(F.col(n) == 0).select("key", F.lit(n).alias("of"), F.concat("word", F.lit(after)).alias("word"))
              for n, after in (("n", b" "), ("n_last", bytes([END])))]
    grams = unseen[0].unionByName(unseen[1]).select("key", "of", "word", F.explode(F.sequence(F.lit(1), F.length("word") - ORDER)).alias("i"))
    grams = grams.select(F.col("key").alias("word_key"), "of", F.conv(F.hex(F.substring("word", F.col("i"), F.lit(ORDER + 1))), 16, 10).cast("long").alias("key"))
    by_bytes = grams.join(trie.select("key", "start"), "key").groupBy("word_key").agg(
        *(F.sum(F.when(F.col("of") == n, F.col("start"))).alias(f"{n}_bytes") for n in ("n", "n_last")))
    joined = (words.withColumn("root", F.when(F.length("word") >= ORDER, root)).drop("word")
              .join(begun, "root", "left").join(by_bytes, F.col("key") == F.col("word_key"), "left"))
    weight = F.log10(F.col("total") + F.col("escape"))

    def tail(n: str) -> Column:
        escaped = F.when(F.col("total") > 0, F.log10("escape") - weight).otherwise(F.lit(0.0)) + F.col(f"{n}_bytes")
        return F.coalesce(F.when(F.col(n) > 0, F.log10(n) - weight).otherwise(escaped), F.lit(0.0))

    return joined.select("key", (F.coalesce("n", zero) + F.coalesce("n_last", zero)).alias("n"), tail("n").alias("inner_tail"), tail("n_last").alias("last_tail"))


def _least_cached(counts: DataFrame) -> int:
    """The least count of what is broadcast: 0 or a power of two that at most ``CACHED`` rows reach."""
    bins = counts.groupBy(F.when(F.col("n") > 0, F.length(F.bin("n"))).otherwise(0).alias("bits")).agg(F.count("*").alias("rows")).collect()
    held, least = 0, 1 << 62
    for bits, rows in sorted(((r["bits"], r["rows"]) for r in bins), reverse=True):
        held += rows
        if held > CACHED:
            break
        least = 1 << (bits - 1) if bits else 0
    return least


def adaptive_score(text: bytes, order: int = ORDER) -> float:
    """log10 probability of one text, coded by itself: the trie starts empty and grows."""
    symbols = np.append(np.frombuffer(b" ".join(text.lower().split()), np.uint8), np.uint8(END)).tolist()
    trie: dict[bytes, dict[int, int]] = {}
    history, total = bytes([PAD]) * order, 0.0
    for s in symbols:
        out: set[int] = set()
        for k in range(order, -1, -1):
            node = {t: n for t, n in trie.get(history[order - k:], {}).items() if t not in out}
            if node:
                weight = sum(node.values()) + len(node)
                if s in node:
                    total += np.log10(node[s] / weight)
                    break
                total += np.log10(len(node) / weight)
                out |= node.keys()
        else:
            total -= np.log10(SYMBOLS - len(out))
        for k in range(order + 1):
            node = trie.setdefault(history[order - k:], {})
            node[s] = node.get(s, 0) + 1
        history = (history + bytes([s]))[-order:] if order else b""
    return float(total)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", adaptive: bool = False) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    With ``adaptive`` the score is that of each text by itself.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    counts = stored(count(rows, "text", "held_out"), "counts")
    grams = stored(byte_trie(counts), "grams")
    words = stored(word_values(counts, grams), "words")
    sums = words.where("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    texts_n = counts.where(F.col("kind") == TEXTS).agg(F.sum("n")).first()[0] or 0
    discard(counts)
    total, distinct = (sums["n"] or 0) + texts_n, sums["v"] + (texts_n > 0)
    unit = total + 0.5 * (distinct + 1)
    end = float(np.log10((texts_n + 0.5) / unit))
    least_word, least_gram = _least_cached(words), _least_cached(grams)
    frequent = words.where(F.col("n") >= least_word).toArrow()  # at most ``CACHED`` rows, the next one as well
    contexts = grams.where(F.col("n") >= least_gram).select("key", "start").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((
        pd.Index(frequent["key"].to_numpy()), [frequent[c].to_numpy() for c in ("n", "inner_tail", "last_tail")],
        pd.Index(contexts["key"].to_numpy()), contexts["start"].to_numpy()))

    def lists(values: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
        ends = np.append(0, np.cumsum(np.bincount(row, minlength=n))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (known_n, inner_tail, last_tail), trie, starts = shared.value
        known_log, known_seen = np.log10((known_n + 0.5) / unit), known_n > 0
        for batch in batches:
            for first, texts in row_slices(batch.column(1)):
                streams, n = Streams(texts), len(texts)
                hashes, row, last = streams.word_hashes().view(np.int64), streams.words.row(), streams.last_words()
                at = known.get_indexer(hashes)
                found = at >= 0
                at, own = at[found], row[found]
                base = np.bincount(own, known_log[at], n) + end
                n_known = np.bincount(own, known_seen[at], n).astype(np.int64) + (texts_n > 0)
                if adaptive:
                    model = np.array([adaptive_score(t) for t in texts])
                    keys, gram_row = np.zeros(0, np.int64), np.zeros(0, np.int64)
                else:
                    model = np.bincount(own, np.where(last[found], last_tail[at], inner_tail[at]), n)
                    alone = ~streams.by_words()
                    keys, gram_row = streams.grams()[alone].view(np.int64), np.repeat(np.arange(n), streams.sizes)[alone]
                    place = trie.get_indexer(keys)
                    met = place >= 0
                    model = model + np.bincount(gram_row[met], starts[place[met]], n)
                    keys, gram_row = keys[~met], gram_row[~met]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(streams.words.counts.astype(np.int64) + 1),
                     pa.array(n_known), pa.array(base, pa.float64()), pa.array(model, pa.float64()), lists(hashes[~found & ~last], row[~found & ~last], n),
                     lists(hashes[~found & last], row[~found & last], n), lists(keys, gram_row, n)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "inner", "last", "grams"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "text", "held_out").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, inner array<long>, last array<long>, grams array<long>")
    scored = stored(scored.select(F.monotonically_increasing_id().alias("row"), "*"), "scored")

    # What is not cached meets its values here.
    def rare(column: str) -> DataFrame:
        return scored.select("row", F.explode(column).alias("key")).groupBy("row", "key").agg(F.count("*").alias("m"))

    of_words = rare("inner").withColumn("last", F.lit(False)).unionByName(rare("last").withColumn("last", F.lit(True))).join(
        words.where(F.col("n") < least_word), "key").select(
        "row", F.when(F.col("n") > 0, F.col("m")).otherwise(0).alias("known"), (F.col("m") * F.log10((F.col("n") + 0.5) / F.lit(float(unit)))).alias("base"),
        (F.col("m") * F.when(F.col("last"), F.col("last_tail")).otherwise(F.col("inner_tail"))).alias("score"))
    of_grams = rare("grams").join(grams.where(F.col("n") < least_gram).select("key", "start"), "key").select(
        "row", F.lit(0).alias("known"), F.lit(0.0).alias("base"), (F.col("m") * F.col("start")).alias("score"))
    met = of_words.unionByName(of_grams).groupBy("row").agg(
        F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("score").alias("more_score"))
    model_score = F.col("score") if adaptive else F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        model_score.alias("score"))
