"""Embedding and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import round_to
from ..operators import retrieval
from ..session import new_folder
from .cleaning import SAMPLE_KEYS, SAMPLE_SQL, TEXT_COLUMNS, TEXT_SQL, readings
from .registry import query, table

K, DIM, WORDS = 10, 384, 200


def words():
    """The encoder that the word queries name; the default one counts character n-grams."""
    return retrieval.HashedWords(DIM)


COSINE = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


def shown(df):
    """Similarities to six decimals."""
    return df.withColumn("similarity", round_to("similarity", 6))


def query_vector(spark, sf):
    """The embedding of vector 0 as a one-row frame."""
    return table(spark, sf, "embeddings").where("vec_id = 0").select("embedding")


@query(f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
           q AS (SELECT v AS q FROM e WHERE vec_id = 0)
           SELECT vec_id, label, ROUND(s, 6) AS similarity
           FROM (SELECT vec_id, label, ROUND({COSINE.format(a='v', b='q')}, 12) AS s FROM e, q ORDER BY 3 DESC, 1 LIMIT {K}) t""")
def topk_cosine(spark, sf):
    return shown(retrieval.topk_cosine(table(spark, sf, "embeddings"), query_vector(spark, sf), K, ["vec_id"], ["label"]))


@query(f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
           q AS (SELECT v AS q FROM e WHERE vec_id = 0)
           SELECT vec_id, ROUND({COSINE.format(a='v', b='q')}, 6) AS similarity FROM e, q""")
def cosine_to_query(spark, sf):
    scored = retrieval.with_similarity(table(spark, sf, "embeddings"), query_vector(spark, sf))
    return shown(scored.select("vec_id", "similarity"))


def centroids(spark, sf):
    """Mean vector of each label: one query per class."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("p", "x"))
    means = cells.groupBy("label", "p").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("p", "x"))).alias("c"))
    return ordered.select("label", F.col("c.x").alias("embedding"))


@query(f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
           c AS (SELECT label, p, AVG(x) AS x FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM e) u GROUP BY 1, 2),
           q AS (SELECT label, list(x ORDER BY p) AS q FROM c GROUP BY 1),
           s AS (SELECT q.label, e.vec_id, ROUND({COSINE.format(a='e.v', b='q.q')}, 12) AS similarity FROM e CROSS JOIN q),
           r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rank FROM s)
           SELECT label, CAST(rank AS INTEGER) AS rank, vec_id, ROUND(similarity, 6) AS similarity FROM r WHERE rank <= {K}""")
def topk_cosine_batch(spark, sf):
    return shown(retrieval.topk_cosine_batch(table(spark, sf, "embeddings").drop("label"), centroids(spark, sf), K,
                                             ["vec_id"], "label"))


@query(f"SELECT {K} AS rows, TRUE AS recall_enough FROM (SELECT COUNT(*) AS n FROM embeddings) t WHERE n >= {K}")
def topk_ann(spark, sf):
    """How many rows come back, and whether nine in ten of the exact answer are among them."""
    embeddings = table(spark, sf, "embeddings")
    vector = embeddings.where("vec_id = 0").first()["embedding"]
    found = retrieval.topk_ann(embeddings, vector, K, "vec_id", tables=16).select("vec_id")
    exact = retrieval.topk_cosine(embeddings, list(vector), K, ["vec_id"]).select("vec_id", F.lit(1).alias("hit"))
    return found.join(exact, "vec_id", "left").agg(
        F.count("*").cast("int").alias("rows"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * K).alias("recall_enough"))


CHUNKS = f"""
words AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\r\\n]+'), lambda w: w <> '') AS w FROM documents),
chunks AS (
  SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, array_to_string(list_slice(w, i * {WORDS} + 1, (i + 1) * {WORDS}), ' ') AS chunk
  FROM (SELECT doc_id, w, unnest(range(CAST(ceil(len(w) / {WORDS}.0) AS BIGINT))) AS i FROM words WHERE len(w) > 0) x)"""


@query(f"WITH {CHUNKS} SELECT * FROM chunks")
def chunk_documents(spark, sf):
    return retrieval.chunk_documents(table(spark, sf, "documents"), "doc_id", "text", WORDS)


def _cells(source: str, keys: str, text: str) -> str:
    return f"""SELECT {keys}, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {DIM} AS cell, COUNT(*) AS n
               FROM (SELECT {keys}, unnest(string_split_regex({text}, '[ \\t\\r\\n]+')) AS w FROM {source}) u
               WHERE w <> '' GROUP BY ALL"""


@query(f"""WITH {CHUNKS},
  a AS ({_cells("chunks", "doc_id, chunk_no", "chunk")}), b AS ({_cells("benchmark", "item_id", "text")}),
  an AS (SELECT doc_id, chunk_no, sqrt(CAST(SUM(n * n) AS DOUBLE)) AS size FROM a GROUP BY 1, 2),
  bn AS (SELECT item_id, sqrt(CAST(SUM(n * n) AS DOUBLE)) AS size FROM b GROUP BY 1),
  dots AS (SELECT item_id, doc_id, chunk_no, CAST(SUM(a.n * b.n) AS DOUBLE) AS dot FROM a JOIN b USING (cell) GROUP BY 1, 2, 3),
  s AS (SELECT bn.item_id, an.doc_id, an.chunk_no, ROUND(COALESCE(dot, 0.0) / (an.size * bn.size), 12) AS similarity
        FROM an CROSS JOIN bn LEFT JOIN dots USING (item_id, doc_id, chunk_no)),
  r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY similarity DESC, doc_id, chunk_no) AS rank FROM s)
  SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, chunk_no, ROUND(similarity, 6) AS similarity FROM r WHERE rank <= {K}""")
def retrieve_chunks(spark, sf):
    index = retrieval.build_doc_index(table(spark, sf, "documents"), "doc_id", "text", WORDS, encoder=words, dim=DIM,
                                      path=new_folder(spark, "doc_index"))
    return shown(retrieval.retrieve(index, table(spark, sf, "benchmark"), "item_id", "text", K, "doc_id", words, DIM))


@query(f"""WITH {CHUNKS}, a AS ({_cells("chunks", "doc_id, chunk_no", "chunk")})
           SELECT doc_id, chunk_no, CAST({DIM} AS INTEGER) AS width, CAST(SUM(n) AS DOUBLE) AS total,
                  CAST(MAX(n) AS DOUBLE) AS largest FROM a GROUP BY 1, 2""")
def embed_chunks(spark, sf):
    index = retrieval.build_doc_index(table(spark, sf, "documents"), "doc_id", "text", WORDS, encoder=words, dim=DIM)
    vector = F.transform("embedding", lambda x: x.cast("double"))
    return index.select("doc_id", "chunk_no", F.size("embedding").alias("width"),
                        F.aggregate(vector, F.lit(0.0), lambda a, x: a + x).alias("total"),
                        F.array_max(vector).alias("largest"))


@query(f"""WITH {CHUNKS},
  grams AS (SELECT doc_id, chunk_no, unnest(list_transform(range(1, len(chunk) - 1), lambda i: substr(chunk, CAST(i AS INTEGER), 3))) AS g FROM chunks),
  cells AS (SELECT doc_id, chunk_no, CAST((((ascii(g) * 65599::BIGINT + ascii(substr(g, 2, 1))) % 1000000007 * 65599
                   + ascii(substr(g, 3, 1))) % 1000000007) % {DIM} AS INTEGER) AS cell FROM grams)
  SELECT doc_id, chunk_no, cell, CAST(COUNT(*) AS DOUBLE) AS n FROM cells GROUP BY ALL""")
def embed_ngrams(spark, sf):
    """All cells that are not zero of the default embedding of all chunks."""
    index = retrieval.build_doc_index(table(spark, sf, "documents"), "doc_id", "text", WORDS, dim=DIM)
    # An outer one, as no embedding is empty: otherwise the planner asks for its size first, which computes it again.
    cells = index.select("doc_id", "chunk_no", F.posexplode_outer("embedding").alias("cell", "n")).where("n <> 0")
    return cells.withColumn("n", F.col("n").cast("double"))


@query(f"""SELECT COUNT(*) AS queries, CAST(COUNT(*) * LEAST({K}, COUNT(*)) AS BIGINT) AS rows, TRUE AS recall_enough FROM embeddings""")
def topk_ann_batch(spark, sf):
    """All vectors as queries: how many rows come back, and whether nine in ten of the exact answer are among them."""
    embeddings = table(spark, sf, "embeddings").select("vec_id", "embedding")
    asked = embeddings.withColumnRenamed("vec_id", "asked")
    found = retrieval.topk_ann_batch(embeddings, asked, K, ["vec_id"], "asked").select("asked", "vec_id")
    exact = retrieval.topk_cosine_batch(embeddings, asked, K, ["vec_id"], "asked").select("asked", "vec_id", F.lit(1).alias("hit"))
    per_query = found.join(exact, ["asked", "vec_id"], "left").groupBy("asked").agg(F.count("*").alias("n"), F.count("hit").alias("hits"))
    return per_query.agg(F.count("*").alias("queries"), F.sum("n").alias("rows"), (F.sum("hits") >= 0.9 * F.sum("n")).alias("recall_enough"))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {TEXT_SQL} AS searchable_text,
           CAST({DIM} AS INTEGER) AS width FROM ({SAMPLE_SQL}) s""")
def sensor_log_index(spark, sf):
    index = retrieval.sensor_log_index(readings(spark, sf), 500, SAMPLE_KEYS, TEXT_COLUMNS, dim=DIM)
    return index.select(*SAMPLE_KEYS, "searchable_text", F.size("embedding").alias("width"))
