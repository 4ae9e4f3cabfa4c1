"""How the sources of a language differ in their words: exact count vectors, summed by source, compared in pairs.

Every document becomes a sparse vector of term counts. The vocabulary of a language are the terms
of at least ``min_df`` of its documents, at most ``vocab_size`` of them, the most frequent first.
The vectors of a (language, source) group are added up, as a summariser does, and restricted to the
vocabulary; the sum of restricted vectors and the restricted sum are the same, and the latter moves
a row per group and term instead of one per document and term. The vocabulary stays a table: it
grows with the corpus and is neither collected nor handed out.

A term's smoothed share in a group is the whole number ``p = 1 + floor(SCALE * (count + 1) / (N + V))``,
N being the group's words of the vocabulary and V its size; the divergence of p from q is
``floor((p - q)^2 / q)``. All of it is integer arithmetic.

A pair of groups is evaluated where either has counts. With p0 and q0 as the shares of a term that
does not occur, the sum over all V terms is ``V f(p0, q0)`` and what the terms that occur add to it:
terms of one group alone depend on their own share only, so they are counted by share; only terms
that both groups have are met term by term.

Defined cases: null text, language and source are empty strings; a repeated row is one more document;
ids play no part; documents without terms make their group known but add nothing; a language without
vocabulary has pair values of 0 and no term rows; equal values are ranked by name in UTF-8 order;
texts of any length are handled in slices; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import discard, stored
from .text import row_slices

SCALE = 1_000_000_000
MIN_DF = 3
# The largest integer: the vocabulary is not cut.
VOCAB_SIZE = 2**31 - 1
TOP = 200

# ASCII letters in lower case and bytes beyond ASCII; all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def document_vectors(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, terms, counts``: the distinct terms of every row's text and how often they occur in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in row_slices(batch.column(2)):
                terms, counts, ends = [], [], [0]
                for t in texts:
                    found = Counter(t.translate(_FOLD).split())
                    terms.extend(found)
                    counts.extend(found.values())
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], ["lang", "source", "terms", "counts"])

    held = docs.select(_named(lang).alias("lang"), _named(source).alias("source"), F.col(text).cast("string").alias("text"))
    return held.mapInArrow(run, "lang string, source string, terms array<string>, counts array<long>")


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def group_sums(vectors: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``: the vectors of a group added up, and the documents that have the term."""
    entries = vectors.select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    return entries.select("lang", "source", F.col("e.terms").alias("term"), F.col("e.counts").alias("n")).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.count("*").alias("df"))


def vocabulary(sums: DataFrame, min_df: int = MIN_DF, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """``lang, term, total``: the terms that a language keeps, with their occurrences in it."""
    terms = sums.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_df)
    if vocab_size < VOCAB_SIZE:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "term"))
        terms = terms.withColumn("place", place).where(F.col("place") <= vocab_size)
    return terms.select("lang", "term", "total")


def share(n: str, words: str, size: str) -> Column:
    """p of a term that occurs ``n`` times among ``words`` words of a vocabulary of ``size``; the product may pass 64 bits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + 1 as decimal(20, 0))) div cast({words} + {size} as decimal(20, 0))")


def divergence(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); both are at most SCALE + 1, so the square fits."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))


def _pair_values(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for all ordered pairs of groups of a language."""
    held = groups.select("lang", "source", "v", "nnz", F.when(F.col("v") > 0, share("0", "words", "v")).alias("p0"))
    first = held.select("lang", F.col("source").alias("a"), "v", F.col("nnz").alias("nnz_a"), F.col("p0").alias("a0"))
    second = held.select("lang", F.col("source").alias("b"), F.col("nnz").alias("nnz_b"), F.col("p0").alias("b0"))
    pairs = first.join(second, "lang").where("a != b")
    base = pairs.select("lang", "a", "b", F.coalesce(F.expr("v - nnz_a - nnz_b") * divergence("a0", "b0"), F.lit(0)).alias("value"))

    shares = rated.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    alone = shares.join(held.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0")), "lang").where("source != other")
    alone = alone.groupBy("lang", "source", "other").agg(
        F.sum(F.col("m") * divergence("p", "o0")).alias("there"), F.sum(F.col("m") * divergence("o0", "p")).alias("back"))
    ones = alone.select("lang", F.inline(F.array(
        F.struct(F.col("source").alias("a"), F.col("other").alias("b"), F.col("there").alias("value")),
        F.struct(F.col("other").alias("a"), F.col("source").alias("b"), F.col("back").alias("value")))))

    terms = rated.join(held.select("lang", "source", "p0"), ["lang", "source"]).select("lang", "term", "source", "p", "p0")
    left = terms.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("p"), "p0")
    right = terms.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("p0").alias("q0"))

    def both(p: str, q: str, p0: str, q0: str) -> Column:
        return F.sum(divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0))

    met = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(
        both("p", "q", "p0", "q0").alias("there"), both("q", "p", "q0", "p0").alias("back"))
    shared = met.select("lang", F.inline(F.array(
        F.struct("a", "b", F.col("there").alias("value")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("value")))))
    return base.unionByName(ones).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_df: int = MIN_DF,
          vocab_size: int = VOCAB_SIZE, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) group.

    Part ``pair``: the divergence from each other source of the language, all of them. Part ``term``: the terms of the
    group whose share is above that in the language, by divergence from it, the first ``top``.
    """
    sums = stored(group_sums(document_vectors(docs, lang, source, text)), "sums")
    kept = stored(sums.join(vocabulary(sums, min_df, vocab_size), ["lang", "term"]), "kept")
    discard(sums)
    sizes = kept.select("lang", "term", "total").distinct().groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_words"))
    words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count("*").alias("nnz"))
    known = docs.select(_named(lang).alias("lang"), _named(source).alias("source")).distinct()
    groups = stored(known.join(sizes, "lang", "left").join(words, ["lang", "source"], "left").na.fill(0), "groups")
    rated = stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "words", "v").alias("p"), share("total", "lang_words", "v").alias("q")), "rated")
    pairs = _pair_values(rated, groups).select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    over = rated.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(over, "term").where(F.col("rank") <= top))
