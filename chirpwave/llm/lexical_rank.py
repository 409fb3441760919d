"""Operator 13: ranked lexical search with exact sparse ball trees.

Each query item ranks all documents by an integer score of its terms (see
``term_weight`` and ``term_value``).  A document is the sparse vector of
weight times value of its terms, a query the vector of its term counts, the
score their inner product.

1. Items are numbered and dealt into blocks of bounded bytes.  For a block,
   one pass over the whole texts writes every document's counts of the
   block's terms, together with its length.
2. Spark adds up the corpus statistics from that table: documents, terms, and
   the documents of every term of the block.
3. Every task builds ball trees over its documents, a few thousand at a time,
   and searches them best-first for all queries of the block, carrying each
   query's best scores from tree to tree (``ball_tree``).  A first search of
   one document in 64 gives each query a score that its k-th best reaches at
   least; all tasks prune with it from the start.
4. A window per query merges the tasks' best.

A benchmark of any size is worked off block by block; only one block (at most
about ``block_bytes`` of text, with its terms' weights) is in the driver and
the tasks at a time, and each block's result is written before the next
begins.

Defined cases: a null or empty text, of a document or an item, has no terms;
rows with a null document id are no documents; repeated document rows are
ranked each; every item row is answered by itself, null and repeated ids
included, and items without a match give no rows; texts are read whole; equal
scores go by ascending document id; empty tables give an empty result; only
the columns named are read, so extra columns clash with nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .ball_tree import Best, Sparse, build, search
from .words import ALNUM, shards, split_words

BLOCK_BYTES = 1 << 20
BLOCK_ITEMS = 512
TREE_ROWS = 4096
SHARD_BYTES = 4 << 20
SEED_PART = 64


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def term_value(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The value of a term that occurs ``tf`` times in a document of ``n`` terms."""
    m = 75 + (25 * n * docs) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _pairs(words, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, code, count`` of the words that ``known`` holds (code: position in it)."""
    code = np.asarray(pc.fill_null(pc.index_in(words.vocab, value_set=known), -1), dtype=np.int64)[words.codes]
    rows = words.rows()[code >= 0]
    both, counts = np.unique(rows * max(len(known), 1) + code[code >= 0], return_counts=True)
    return both // max(len(known), 1), both % max(len(known), 1), counts.astype(np.int64)


def _lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def term_counts(docs: DataFrame, known: pa.Array) -> DataFrame:
    """``id, n, codes, tfs``: a document's length in terms and its counts of the known terms."""
    def count(batches):
        for batch in batches:
            for part in shards(batch, batch["text"], SHARD_BYTES):
                words = split_words(part["text"], ALNUM)
                rows, codes, counts = _pairs(words, known)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(words.counts.astype(np.int64)), _lists(rows, codes, part.num_rows),
                     _lists(rows, counts, part.num_rows)], names=["id", "n", "codes", "tfs"])

    return docs.mapInArrow(count, "id bigint, n bigint, codes array<int>, tfs array<int>")


def _vectors(batch: pa.RecordBatch, weights: np.ndarray, docs: int, total: int) -> Sparse:
    """Documents that hold a term of the block, as weighted vectors."""
    sizes = np.asarray(pc.list_value_length(batch["codes"]), dtype=np.int64)
    codes = np.asarray(batch["codes"].flatten(), dtype=np.int64)
    tfs = np.asarray(batch["tfs"].flatten(), dtype=np.int64)
    values = weights[codes] * term_value(tfs, np.repeat(np.asarray(batch["n"], dtype=np.int64), sizes), docs, total)
    some = sizes > 0
    return Sparse(np.asarray(batch["id"], dtype=np.int64)[some], np.concatenate([[0], np.cumsum(sizes[some])]), codes, values)


def _search_block(table: DataFrame, queries: np.ndarray, weights: np.ndarray, docs: int, total: int, k: int,
                  floor: np.ndarray | None = None) -> DataFrame:
    """``query, doc_id, score``: every task's best documents of every query."""
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=0)) * (1 + 1e-9)

    def run(batches):
        best = Best(queries.shape[1], k, floor)
        for batch in batches:
            for at in range(0, batch.num_rows, TREE_ROWS):
                rows = _vectors(batch.slice(at, TREE_ROWS), weights, docs, total)
                if len(rows.ids):
                    search(build(rows, len(weights)), queries, norms, best)
        query, ids, scores = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(ids), pa.array(scores)],
                                         names=["query", "doc_id", "score"])

    return table.mapInArrow(run, "query int, doc_id bigint, score bigint")


def _rank_block(docs: DataFrame, items: pa.Table, k: int) -> DataFrame:
    """``num, rank, doc_id, score`` of one block of items."""
    spark = docs.sparkSession
    words = split_words(items["text"], ALNUM)
    known = words.vocab
    width, rows = max(len(known), 1), words.rows()
    queries = np.zeros((width, items.num_rows), dtype=np.float32)  # counts, exact below 2^24
    np.add.at(queries, (words.codes, rows), 1)
    path = scratch_path(spark, "term-counts")
    term_counts(docs, known).write.parquet(path)
    table = spark.read.parquet(path)
    n, total = table.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = np.zeros(width, dtype=np.int64)
    for r in table.select(F.explode("codes").alias("code")).groupBy("code").count().collect():  # terms of the block
        weights[r["code"]] = term_weight(n, r["count"])
    args = (queries, weights, n, total or 0, k)
    # any document's score is one that the k-th best of all reaches, if k documents have it
    floor = Best(items.num_rows, k)
    seed = _search_block(table.where(F.pmod(F.xxhash64("id"), F.lit(SEED_PART)) == 0), *args)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    kth = seed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    for r in kth.select("query", "score").collect():  # one row per query of the block
        floor.scores[r["query"], -1] = r["score"]
    found = _search_block(table, *args, floor=floor.least())
    numbers = F.array(*[F.lit(x) for x in items["num"].to_pylist()])
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select(F.get(numbers, F.col("query")).cast("bigint").alias("num"), "rank", "doc_id", "score"))


def lexical_rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", k: int = 20, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    corpus = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    # numbers are drawn once and written, so that repeated items spread over the blocks too
    stored = scratch_path(spark, "items")
    items.select(F.monotonically_increasing_id().alias("num"), F.col(item_col).alias("item_id"),
                 F.col(item_text_col).alias("text")).write.parquet(stored)
    numbered = spark.read.parquet(stored)
    count, size = numbered.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-count // block_items), -(-(size or 0) // block_bytes), 1)
    results = []
    for block in range(blocks):
        part = numbered.where(F.pmod(F.xxhash64("num"), F.lit(blocks)) == block)
        table = part.select("num", "text").toArrow()  # about block_bytes of text
        found = _rank_block(corpus, table, k)
        if blocks > 1:
            path = scratch_path(spark, "ranked")
            found.write.parquet(path)
            found = path
        results.append(found)
    ranked = results[0] if blocks == 1 else spark.read.parquet(*results)
    return ranked.join(numbered.select("num", "item_id"), "num").select(F.col("item_id"), "rank", "doc_id", "score")
