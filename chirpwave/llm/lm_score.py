"""Operator 5: language-model scores from subword lattices.

The model is a unigram over the pieces of an existing vocabulary: a text's
probability is the sum, over all ways to segment it into pieces, of the
product of the pieces' probabilities, times the probability of the end.
Words (lower-cased A-Z) are separated by the marker that begins each word, so
the sum over a text's segmentations is the product of its words' sums,
and each distinct word's lattice is summed once per corpus, not once per use.

The vocabulary's scores order the pieces; they give the starting weights
(inverse to the rank).  One expectation step over all training words turns
them into the corpus's expected piece counts, smoothed by 0.5, as the model.

Counts go through the key exchange: each slice of documents sends its
distinct words with their training counts to word buckets, each bucket keeps
one written row of distinct words and counts, and the answers (count and
lattice sum of each word) go back to the slices.  The driver holds the piece
counts only, at most one per vocabulary piece.

Defined cases: null and empty texts have the end token only; without
training rows all counts are 0 and the model is the smoothed starting point;
rows with a null id are scored, not trained on and not held out; repeated
rows count and are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpwave.llm import exchange as X
from chirpwave.llm.language_id import fold
from chirpwave.llm.memory import releasing
from chirpwave.llm.lattice import PieceTrie, word_lattices
from chirpwave.llm.words import LOWER, digests, split_words, vocab_bytes
from chirpwave.session import scratch_path

SENT = "slice int, bucket int, words binary, counts binary"
BUCKET = "bucket int, words binary, counts binary, slices array<int>, sizes array<int>, sent binary"
ANSWER = (np.dtype("<u8"), np.dtype("<f8"))  # training count, lattice sum
LN10 = math.log(10.0)


def _blob_words(blob: bytes) -> list[bytes]:
    return blob.split(b"\n") if blob else []  # words hold no white space


class _SliceWords:
    """A slice's distinct words, dealt to buckets in hash order, so that the
    order is the same whenever the slice is read again."""

    def __init__(self, table: pa.Table, text_col: str, n: int):
        self.words = split_words(pc.struct_field(table["doc"], text_col), LOWER)
        self.vocab = vocab_bytes(self.words)
        first, second = digests(self.vocab) if self.vocab else (np.empty(0, np.uint64),) * 2
        self.order = np.lexsort((second, first))
        self.buckets = X.bucket_of(first[self.order], n)
        self.train = np.asarray(table["train"], dtype=bool)


def _combine(table: pa.Table) -> pa.Table:
    """A bucket's distinct words with total counts, and which of them each slice sent."""
    words = [w for blob in table["words"].to_pylist() for w in _blob_words(blob)]
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype="<u8")
    coded = pa.array(words, type=pa.large_binary()).dictionary_encode()
    which = np.asarray(coded.indices, dtype=np.int64)
    total = np.zeros(len(coded.dictionary), dtype="<u8")
    np.add.at(total, which, counts)
    sizes = [len(b) // 8 for b in table["counts"].to_pylist()]
    return pa.table({"bucket": table["bucket"].slice(0, 1),
                     "words": pa.array([b"\n".join(coded.dictionary.to_pylist())], type=pa.binary()),
                     "counts": pa.array([total.tobytes()], type=pa.binary()),
                     "slices": pa.array([table["slice"].to_pylist()], type=pa.list_(pa.int32())),
                     "sizes": pa.array([sizes], type=pa.list_(pa.int32())),
                     "sent": pa.array([which.astype("<u4").tobytes()], type=pa.binary())})


def _text(words: list[bytes]) -> list[str]:
    return [w.decode() for w in words]


def load_pieces(model_path: str) -> tuple[list[str], list[float], list[int]]:
    """Pieces ("" for control and unused ones), scores and byte piece ids of a sentencepiece file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
    return (["" if odd[i] else model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)],
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def starting_weights(scores: list[float]) -> np.ndarray:
    """Natural logs of weights inverse to the pieces' score rank."""
    rank = np.empty(len(scores))
    rank[np.argsort(-np.array(scores), kind="stable")] = np.arange(len(scores))
    weight = 1.0 / (rank + 10.0)
    return np.log(weight / weight.sum())


def expected_uses(buckets: DataFrame, pieces: list[str], byte_ids: list[int], start: np.ndarray) -> DataFrame:
    """``(piece, uses, n, v)``: the expected uses, in millionths, of every piece
    in the training words, and in a row of piece -1 how many words there are
    with repeats and distinct.  Each task adds up its buckets, so there are at
    most as many rows as pieces and one more for each task."""
    def expect(batches):
        trie = PieceTrie(pieces, byte_ids)
        spent, total, distinct = np.zeros(len(pieces), dtype=np.int64), 0, 0
        for batch in batches:
            for words, counts in zip(batch["words"].to_pylist(), batch["counts"].to_pylist()):
                counts, words = np.frombuffer(counts, dtype="<u8"), _blob_words(words)
                seen = np.nonzero(counts)[0]
                _, uses = word_lattices(_text([words[i] for i in seen.tolist()]), trie, start, counts[seen].astype(float))
                spent += np.rint(uses * 1e6).astype(np.int64)  # whole millionths, so that the sum has one value in any order
                total, distinct = total + int(counts.sum()), distinct + len(seen)
        piece = np.nonzero(spent)[0]
        none = np.zeros(len(piece), dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(piece, -1)), pa.array(np.append(spent[piece], 0)), pa.array(np.append(none, total)),
             pa.array(np.append(none, distinct))], names=["piece", "uses", "n", "v"])

    return buckets.select("words", "counts").mapInArrow(expect, "piece bigint, uses bigint, n bigint, v bigint")


def lm_score(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
             held_out: int = 1, slices: int | None = None) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    spark = docs.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    trie_pieces, scores, byte_ids = load_pieces(model_path)
    part = fold(id_col, folds)
    parts = (X.sliced(docs, X.byte_slices(docs, text_col, slices), id_col, text_col)
             .withColumn("train", F.coalesce(fold(f"doc.{id_col}", folds) != held_out, F.lit(False)))
             .withColumn("held_out", F.coalesce(fold(f"doc.{id_col}", folds) == held_out, F.lit(False))))

    def send(key, table):
        part = _SliceWords(table, text_col, n)
        used = np.repeat(part.train, part.words.counts)
        counts = np.bincount(part.words.codes[used], minlength=len(part.vocab)).astype("<u8")[part.order]
        at = X.run_starts(part.buckets)
        ends = np.append(at[1:], len(part.order))
        blobs = [b"\n".join([part.vocab[i] for i in part.order[a:b].tolist()]) for a, b in zip(at.tolist(), ends.tolist())]
        return pa.table({"slice": pa.array(np.full(len(at), key[0].as_py(), dtype=np.int32)), "bucket": pa.array(part.buckets[at]),
                         "words": pa.array(blobs, type=pa.binary()),
                         "counts": pa.array([counts[a:b].tobytes() for a, b in zip(at, ends)], type=pa.binary())})

    path = scratch_path(spark, "lm-words")
    (parts.groupBy("slice").applyInArrow(releasing(send), SENT).groupBy("bucket").applyInArrow(releasing(_combine), BUCKET)
     .write.parquet(path))
    buckets = spark.read.schema(BUCKET).parquet(path)
    ends = docs.where(part != held_out).count()
    start = starting_weights(scores)

    sums = (expected_uses(buckets, trie_pieces, byte_ids, start)
            .groupBy("piece").agg(F.sum("uses").alias("uses"), F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    uses = np.zeros(len(trie_pieces) + 1)  # the last one is the end
    uses[-1] = ends
    total, distinct = ends, int(ends > 0)
    for r in sums:
        if r["piece"] < 0:
            total, distinct = total + r["n"], distinct + r["v"]
        else:
            uses[r["piece"]] = r["uses"] / 1e6
    logp = np.log((uses + 0.5) / (uses + 0.5).sum())
    floor = total + 0.5 * (distinct + 1)

    def answer(batches):
        trie = PieceTrie(trie_pieces, byte_ids)
        for batch in batches:
            for row in batch.to_pylist():
                sums, _ = word_lattices(_text(_blob_words(row["words"])), trie, logp)
                sent, counts = np.frombuffer(row["sent"], dtype="<u4"), np.frombuffer(row["counts"], dtype="<u8")
                at = np.concatenate([[0], np.cumsum(row["sizes"])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["slices"], type=pa.int32()), pa.array([row["bucket"]] * len(row["slices"]), type=pa.int32()),
                     pa.array([X.pack(np.zeros(b - a, int), [counts[sent[a:b]], sums[sent[a:b]]])[1][0] for a, b in zip(at[:-1], at[1:])],
                              type=pa.binary())], names=["slice", "bucket", "payload"])

    answers = buckets.mapInArrow(answer, X.ASKED)
    schema = T.StructType([parts.schema["doc"], parts.schema["held_out"]] + T.StructType.fromDDL(
        "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields)

    def score(key, table, reply):
        part = _SliceWords(table, text_col, n)
        reply = reply.sort_by("bucket")
        _, (counts, sums) = X.unpack(reply["payload"].to_pylist(), ANSWER)
        count, log_sum = np.zeros(len(part.vocab)), np.zeros(len(part.vocab))
        count[part.order], log_sum[part.order] = counts, sums
        offsets = part.words.offsets

        def per_row(values, end):
            return np.array([math.fsum(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]) + end

        base = np.log10((count + 0.5) / floor)
        rows = len(part.train)
        n_known = np.add.reduceat(np.append((count > 0)[part.words.codes], 0), offsets[:-1]) if rows else np.empty(0, int)
        n_known = np.where(part.words.counts > 0, n_known, 0) + int(ends > 0)
        return pa.table({
            "doc": table["doc"], "held_out": table["held_out"], "n_tokens": pa.array(part.words.counts + 1),
            "n_known": pa.array(n_known.astype(np.int64)), "train_tokens": pa.array(np.full(rows, total, dtype=np.int64)),
            "base_score": pa.array(per_row(base[part.words.codes], math.log10((ends + 0.5) / floor))),
            "score": pa.array(per_row((log_sum / LN10)[part.words.codes], logp[-1] / LN10))})

    return parts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(releasing(score), schema)
