"""From raw documents to token ids, in five stages.

Each stage takes the documents its predecessor kept and returns documents
(the last one adds token ids); ``run`` writes every stage's result as Parquet
in the cluster's shared folder and rereads it for the next.

1. toxicity: documents that the classifier rejects go.
2. near duplicates: the document with the smallest id of every group of
   documents linked by five-word shingles with a similarity of 0.8 or more
   stays.
3. substring dedup: text that repeats an earlier document is cut out; every
   document stays, its text possibly empty.
4. decontamination: documents contaminated by the benchmark go.
5. encoding: the texts' token ids.

Defined cases: a null or empty text goes through all stages as it is (it is
clean, near nothing, without repeats, and has no tokens).  Rows that share a
doc_id are one document: stage 2 keeps one of them, the one with the smallest
text, then the smallest other columns as JSON; rows with a null doc_id are
documents of their own, which no stage links or cuts.  Texts of any length are
read whole.  Ties cannot occur elsewhere: the smallest doc_id stays.  Extra
columns are kept; one that has the name of a column the last stage adds comes
out with ``doc_`` before its name.  Empty documents give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpwave.llm.decontaminate import decontaminate
from chirpwave.llm.merge_dropout import piece_encode
from chirpwave.llm.ngram_join import ngram_join
from chirpwave.llm.substring_dedup import substring_dedup
from chirpwave.llm.toxicity import toxicity
from chirpwave.session import scratch_path
from chirpwave.sources.tables import read_table

#: vocabulary file of a public tokenizer (merge type, with byte pieces)
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: near duplicates: words of a shingle, least similarity (query op2 has its own)
SHINGLE, PERCENT = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = ngram_join(docs, shingle=SHINGLE, percent=PERCENT)
    others = linked.where("component_id <> id").select(F.col("id").alias("doc_id")).distinct()
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    rows = docs.select("doc_id", F.struct("*").alias("row"))
    order = F.struct(F.col("row.text"), F.to_json("row"))
    one = (rows.join(repeated.join(others, "doc_id", "left_anti"), "doc_id", "left_semi")
           .groupBy("doc_id").agg(F.min_by("row", order).alias("row")).select("row.*"))
    single = docs.join(others.union(repeated), "doc_id", "left_anti").select(docs.columns)
    return single.unionByName(one.select(docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup(docs)
    text = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint"))
            .otherwise(F.col("doc.n_chars"))}
    return cut.select(*[text.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ["tokens", "n_tokens", "lossless"]
    names = {c.lower() for c in docs.columns} | set(added)
    kept = []
    for c in docs.columns:
        name = c
        while name.lower() in added or (name != c and name.lower() in names):
            name = f"doc_{name}"
        kept.append(F.col(f"doc.`{c}`").alias(name))
    return piece_encode(docs, PIECES).select(*kept, *added)


STAGES = [("toxicity", reject_toxic), ("ngram_join", drop_near_duplicates), ("substring_dedup", cut_repeats),
          ("decontamination", drop_contaminated), ("sentencepiece", encode)]

#: the stages' models cannot be written in SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
