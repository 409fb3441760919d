"""Operator 3: toxicity by a naive-Bayes-scaled character n-gram classifier.

Features are the presence of character n-grams (code points, A-Z lower-cased)
of the text, its words separated by one boundary space.  On the labelled training rows each n-gram
gets its naive Bayes log-count ratio r = log((p + a) / P) - log((q + a) / Q)
over toxic and other documents; the ``features`` n-grams that separate the
classes best (largest likelihood-ratio statistic) are kept.  A logistic
regression with L2 penalty is then fitted on the presence vectors scaled by
r, and a document's score is its probability.

Only labelled rows outside the held-out fold train.  The fit uses at most
``train_rows`` of them, those with the smallest id hash; the bound is a
parameter.  Scoring covers all rows and whole texts and is row-local.  Labels,
language, source and id are never inputs of a score.

Defined cases: null and empty texts have no features and get the model's
base rate; labels that are null or not 0/1 do not train; a document labelled
more than once trains as toxic if any of its labels says so; with no rows of
one class the score is the smoothed base rate; rows with a null id are scored
and not held out; repeated rows are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpwave.llm.language_id import fold
from chirpwave.llm.memory import releasing_map
from chirpwave.llm.words import LOWER, mix, shards
from chirpwave.session import scratch_path

ORDERS = (4, 5, 6)
TRAIN_ROWS = 10_000
FEATURES = 1_000
MIN_DOCS = 5
SMOOTH = 1.0
PENALTY = 1.0
SHARD_BYTES = 1 << 20  # of text whose n-grams are held at a time
SHARD_ROWS = 1_000  # of the presence matrix
_SLOTS = 1 << 16


def _table() -> np.ndarray:
    table = LOWER.copy()
    table[:48] = 32
    table[58:97] = 32
    table[123:128] = 32
    table[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


BYTES = _table()


def boundary_chars(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all rows with ASCII punctuation as spaces, every word
    between two single spaces, and the row of every character.  A character
    is the number that its UTF-8 bytes spell."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    space = pa.scalar(" ", pa.large_string())
    texts = pc.binary_join_element_wise(space, pc.fill_null(texts, "").cast(pa.large_string()), space,
                                        pa.scalar("", pa.large_string()))
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    flat = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    flat = BYTES[flat]
    row = np.repeat(np.arange(len(raw), dtype=np.int32), np.diff(offsets))
    keep = np.ones(len(flat), dtype=bool)  # one space between words
    keep[1:] = (flat[1:] != 32) | (flat[:-1] != 32) | (row[1:] != row[:-1])
    flat, row = flat[keep], row[keep]
    if not len(flat) or flat.max() < 128:
        return flat, row
    tail = (flat & 0xC0) == 0x80
    at = np.nonzero(~tail)[0]
    chars, row = flat[at].astype(np.uint32), row[at]
    more = np.diff(np.append(at, len(flat))) - 1
    for i in (1, 2, 3):
        long = np.nonzero(more >= i)[0]
        chars[long] = chars[long] << np.uint32(8) | flat[at[long] + i]
    return chars, row


def gram_keys(chars: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every n-gram inside a row as an integer whose top byte tells its order:
    the ASCII characters themselves, or a 56-bit hash if one lies beyond ASCII."""
    m = len(chars) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
    same = row[:m] == row[n - 1:]
    key = np.full(m, n << 56, dtype=np.uint64)
    for i in range(n):
        key |= chars[i:i + m].astype(np.uint64) << np.uint64(8 * i)
    if chars.max() > 127:
        foreign = np.concatenate([[0], np.cumsum(chars > 127)])
        wide = np.nonzero(foreign[n:] > foreign[:m])[0]
        spelt = np.zeros(len(wide), dtype=np.uint64)
        for i in range(n):
            spelt = mix(spelt ^ chars[wide + i].astype(np.uint64)) + np.uint64(i + 1)
        key[wide] = spelt >> np.uint64(8) | np.uint64((n | 0x80) << 56)
    return key[same], row[:m][same]


def bounded(batches, texts_of):
    """Consecutive rows with at most ``SHARD_BYTES`` of text (or one row) and ``SHARD_ROWS`` rows."""
    for batch in batches:
        for part in shards(batch, texts_of(batch), SHARD_BYTES):
            for start in range(0, part.num_rows, SHARD_ROWS):
                yield part.slice(start, SHARD_ROWS)


class Vocabulary:
    """Feature ids of n-gram keys, by an exact open-addressing table."""

    def __init__(self, keys: np.ndarray):
        self.size = len(keys)
        self.keys = np.zeros(_SLOTS * 2, dtype=np.uint64)
        self.ids = np.full(_SLOTS * 2, -1, dtype=np.int32)
        self.probes = 1
        for i, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            tries = 1
            while self.ids[slot] >= 0:
                slot, tries = slot + 1, tries + 1
            self.keys[slot], self.ids[slot] = key, i
            self.probes = max(self.probes, tries)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(48)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot, out = self._slot(keys), np.full(len(keys), -1, dtype=np.int32)
        for probe in range(self.probes):
            match = self.keys[slot + probe] == keys
            out[match] = self.ids[slot[match] + probe]
        return out

    def presence(self, texts: pa.Array) -> np.ndarray:
        """Rows x features."""
        chars, row = boundary_chars(texts)
        present = np.zeros((len(texts), self.size), dtype=bool)
        for n in ORDERS:
            keys, rows = gram_keys(chars, row, n)
            ids = self.find(keys)
            hit = ids >= 0
            present[rows[hit], ids[hit]] = True
        return present


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression by accelerated gradient descent."""
    n = len(y)
    w, b = np.zeros(x.shape[1], dtype=np.float32), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    v = np.random.default_rng(0).normal(size=x.shape[1]).astype(np.float32)
    for _ in range(20):  # the curvature sets the step
        v = x.T @ (x @ v)
        scale = float(np.linalg.norm(v))
        v /= scale or 1.0
    rate = 1 / ((scale + n) / 4 + penalty)
    at, bias, old_w, old_b = w, b, w, b
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ at + bias, -30, 30)))
        w, b = at - rate * (x.T @ (p - y).astype(np.float32) + penalty * at), bias - rate * float((p - y).sum())
        k = (step - 1) / (step + 2)
        at, bias, old_w, old_b = w + k * (w - old_w), b + k * (b - old_b), w, b
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held_out: int,
          train_rows: int, features: int):
    """(n-gram keys, weights already scaled by r, intercept)."""
    marks = (labels.where(F.col(label_col).isin(0, 1) & (fold(id_col, folds) != held_out))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(train_rows))  # ids only, at most train_rows: small enough to broadcast
    path = scratch_path(docs.sparkSession, "toxicity-sample")
    (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id").select("y", "text")
     .write.parquet(path))
    chosen = docs.sparkSession.read.schema("y int, text string").parquet(path)

    def count(batches):
        for part in (p for batch in batches for p in shards(batch, batch["text"], SHARD_BYTES)):
            y = np.asarray(part["y"], dtype=np.int64)
            chars, row = boundary_chars(part["text"])
            for n in ORDERS:
                keys, rows = gram_keys(chars, row, n)
                order = np.lexsort((rows, keys))
                keys, rows = keys[order], rows[order]
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
                keys, toxic = keys[new], y[rows[new]]
                at = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.empty(0, int)
                if len(at):
                    total = np.diff(np.append(at, len(keys)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[at].view(np.int64)), pa.array(np.add.reduceat(toxic, at)), pa.array(total)],
                        names=["gram", "toxic", "total"])

    sizes = chosen.groupBy("y").count().collect()
    n_toxic = sum(r["count"] for r in sizes if r["y"] == 1)
    n_other = sum(r["count"] for r in sizes if r["y"] == 0)
    if not n_toxic or not n_other:
        return np.empty(0, np.uint64), np.empty(0, np.float32), float(np.log((n_toxic + 1) / (n_other + 1)))
    grams = (chosen.mapInArrow(releasing_map(count), "gram bigint, toxic bigint, total bigint").groupBy("gram")
             .agg(F.sum("toxic").alias("p"), F.sum("total").alias("n")).where(F.col("n") >= MIN_DOCS))
    p, q = F.col("p").cast("double"), (F.col("n") - F.col("p")).cast("double")

    def term(k, n, total):  # k log(k / expected) of the likelihood-ratio statistic
        return F.when(k > 0, k * F.log(k / (n * F.lit(total / (n_toxic + n_other))))).otherwise(0.0)

    n = p + q
    g2 = (term(p, n, n_toxic) + term(q, n, n_other)
          + term(F.lit(float(n_toxic)) - p, F.lit(float(n_toxic + n_other)) - n, n_toxic)
          + term(F.lit(float(n_other)) - q, F.lit(float(n_toxic + n_other)) - n, n_other))
    best = grams.select("gram", "p", "n", g2.alias("g2")).orderBy(F.desc("g2"), "gram").limit(features).toPandas()
    keys = best["gram"].to_numpy().view(np.uint64)
    pos, neg = best["p"].to_numpy(float), (best["n"] - best["p"]).to_numpy(float)
    r = (np.log((pos + SMOOTH) / (pos + SMOOTH).sum()) - np.log((neg + SMOOTH) / (neg + SMOOTH).sum())).astype(np.float32)
    vocabulary = Vocabulary(keys)

    def rows(batches):
        for part in bounded(batches, lambda batch: batch["text"]):
            bits = np.packbits(vocabulary.presence(part["text"]), axis=1)
            yield pa.RecordBatch.from_arrays([part["y"], pa.array([b.tobytes() for b in bits], type=pa.binary())],
                                             names=["y", "bits"])

    table = chosen.mapInArrow(releasing_map(rows), "y int, bits binary").toArrow()  # train_rows x features / 8 bytes
    bits = np.frombuffer(b"".join(table["bits"].to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
    x = np.unpackbits(bits, axis=1, count=len(keys)).astype(np.float32) * r
    w, b = fit_logistic(x, np.asarray(table["y"], dtype=np.float32), PENALTY)
    return keys, w * r, b


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             folds: int = 5, held_out: int = 0, train_rows: int = TRAIN_ROWS, features: int = FEATURES,
             threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``held_out``, ``score``
    and ``predicted`` (1 if score >= ``threshold``)."""
    keys, weights, intercept = train(docs, labels, id_col, text_col, label_col, folds, held_out, train_rows, features)
    vocabulary = Vocabulary(keys)
    out = docs.select(F.struct("*").alias("doc"), F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out"))
    schema = T.StructType(out.schema.fields + T.StructType.fromDDL("score double").fields)

    def score(batches):
        for part in bounded(batches, lambda batch: pc.struct_field(batch["doc"], text_col)):
            z = vocabulary.presence(pc.struct_field(part["doc"], text_col)) @ weights + intercept
            scores = 1 / (1 + np.exp(-np.clip(z, -500, 500, dtype=np.float64)))
            yield pa.RecordBatch.from_arrays([part["doc"], part["held_out"], pa.array(scores)],
                                             names=["doc", "held_out", "score"])

    return out.mapInArrow(releasing_map(score), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
