"""The registered queries of this subpackage and their DuckDB twins.

Each query applies one operator, with production parameters, to its whole
table and returns the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpwave.llm.centroids import centroid_clusters
from chirpwave.llm.decontaminate import decontaminate
from chirpwave.llm.language_id import identify
from chirpwave.llm.lexical_rank import lexical_rank
from chirpwave.llm.line_dedup import kept_lines, line_dedup
from chirpwave.llm.lm_score import lm_score
from chirpwave.llm.merge_dropout import piece_encode
from chirpwave.llm.ngram_join import ngram_join
from chirpwave.llm.substring_dedup import substring_dedup
from chirpwave.llm.topk_search import topk_search
from chirpwave.llm.toxicity import toxicity
from chirpwave.llm.url_filter import path_of, url_filter
from chirpwave.llm.warc import read_archives, resolve_revisits, write_archives
from chirpwave.session import scratch_path
from chirpwave.sources.tables import read_table

#: vocabulary file of a public tokenizer (merge type, with byte pieces)
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT k, min(doc_id) AS m FROM g GROUP BY k),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM g JOIN f USING (k) WHERE m < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t
         FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w)
         ANTI JOIN cov USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM cov GROUP BY doc_id) USING (doc_id)
"""

def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT u, v FROM (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS x
                            FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2)
          JOIN n AS p ON p.doc_id = u JOIN n AS q ON q.doc_id = v WHERE 100 * x >= 85 * (p.n + q.n - x)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach AS r JOIN links AS l ON r.v = l.u)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u AS doc_id, min(v) AS m FROM reach GROUP BY u) USING (doc_id)
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.select(F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry the number of their document in the path; a page is known
    as bad if that document is labelled toxic or of quality 0."""
    labels = (read_table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("number"))
              .agg(F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("bad")))
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url").withColumn(
        "number", F.try_to_number(F.nullif(F.regexp_extract(path_of(F.col("url")), "([0-9]{1,18})", 1), F.lit("")),
                                  F.lit("9" * 18)).cast("bigint"))
    judged = url_filter(pages.join(labels, "number", "left"), F.col("bad"))
    return judged.select(F.col("page.page_id").alias("page_id"), "host", "path", "rule", "verdict", "template", "purity")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score(docs, PIECES).select(F.col("doc.doc_id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens",
                                         "base_score", "score")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.w, v.w) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10
"""


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return resolve_revisits(read_archives(spark, path, payloads=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
o AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id > m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > m THEN m END AS refers_to
FROM o
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return marked.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
k AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS k
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k))),
hit AS (SELECT doc_id, i, n, item_id FROM g JOIN k USING (n, k)),
cov AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_encode(docs, PIECES).select(F.col("doc.doc_id").alias("doc_id"), "n_tokens", "tokens", "lossless")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select(F.col("doc.doc_id").alias("doc_id"), "held_out", "lang_pred", "score")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id").drop("checked")


def _op11_sql(k: int = 8, width: int = 64, rounds: int = 10) -> str:
    """The rounds written out one after the other."""
    near = """a{i} AS MATERIALIZED (SELECT r, vec_id, w, best % {k} AS c, best // {k} AS d FROM (
  SELECT r, any_value(vec_id) AS vec_id, any_value(w) AS w, min({k} * list_sum(list_transform(list_zip(w, cw),
         lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + c) AS best FROM v, c{i} GROUP BY r))"""
    mean = """c{j} AS MATERIALIZED (SELECT p.c, coalesce(m.cw, p.cw) AS cw FROM c{i} AS p LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY x) AS cw FROM (
    SELECT c, x, sum(y) AS s, count(*) AS n FROM (SELECT c, unnest(w) AS y, unnest(range({width})) AS x FROM a{i}) GROUP BY c, x)
  GROUP BY c) AS m USING (c))"""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, w FROM (SELECT vec_id, list_transform(embedding,
  lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {width}
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, w) - 1 AS c, w AS cw FROM (
  SELECT w, sha256('3:' || CAST(vec_id AS VARCHAR)) AS h FROM v) ORDER BY h NULLS LAST, w LIMIT {k})"""]
    for i in range(rounds):
        steps += [near.format(i=i, k=k), mean.format(i=i, j=i + 1, width=width)]
    steps.append(near.format(i=rounds, k=k))
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(cw, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.c = c.c"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_lines(docs, line_dedup(docs)).select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                                                     F.sha2("kept_text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM s)),
g AS (SELECT k, max(doc_id) AS m FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.*, coalesce(l.doc_id < m, false) AS gone FROM l LEFT JOIN g USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_rank(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, sum(tf) AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
e AS (SELECT term, count(*) AS df FROM f GROUP BY term),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
      GROUP BY item_id, term),
s AS (SELECT item_id, doc_id, CAST(sum(c * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 12 * CAST(75 + (25 * n * docs) // total AS BIGINT)))) AS BIGINT) AS score
      FROM q JOIN e USING (term) JOIN f USING (term) JOIN d USING (doc_id), g GROUP BY item_id, doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op4_url_filter": op4_url_filter,
    "op5_lm_score": op5_lm_score,
    "op6_topk_search": op6_topk_search,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_merge_dropout": op9_merge_dropout,
    "op10_language_id": op10_language_id,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_rank": op13_lexical_rank,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_ngram_join": OP2_SQL,
    "op6_topk_search": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op8_decontamination": OP8_SQL,
    "op11_centroid_clusters": _op11_sql(),
    "op12_line_dedup": OP12_SQL,
    "op13_lexical_rank": OP13_SQL,
}
