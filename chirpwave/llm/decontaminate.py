"""Operator 8: benchmark decontamination with an FM-index per shard.

Each task turns its documents into shards of bounded size and builds an
FM-index over every shard's words.  The benchmark's windows (13
consecutive words of an item, or the whole of a shorter item) are searched
backward through wavelet ranks, located by sampled suffix positions, and
their occurrences merged into removal spans.  Nothing is shuffled.

The index alphabet is the benchmark's own vocabulary: a word that no window
holds separates the text, and stretches too short for any window are
left out, which loses no occurrence.

The benchmark goes to the tasks in chunks of at most ``chunk_bytes`` of text
(by item, so the bound holds for a benchmark of any size); each chunk is one
more row-local pass that adds its spans to the document's row.

Defined cases: null or wordless documents have no words, no hits and are not
contaminated; null or wordless items match nothing; items with a null id mark
hits but are not listed; equal ids are one item; repeated document rows are
judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpwave.llm.fm_index import FMIndex
from chirpwave.llm.memory import releasing_map
from chirpwave.llm.words import ALNUM, shards, split_words, vocab_bytes

SPANS = "array<struct<start:int,length:int>>"
SHARD_BYTES = 16 << 20
CHUNK_BYTES = 8 << 20
SEPARATOR = 1


@dataclass
class Windows:
    """Distinct windows as right-aligned symbols (2 and up; 0 pads)."""

    vocab: dict[bytes, int]
    symbols: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]  # of each window


def windows_of(ids: list, texts: pa.Array, window: int) -> Windows:
    words = split_words(texts, ALNUM)
    found: dict[tuple, set] = {}
    for i, item in enumerate(ids):
        codes = words.codes[words.offsets[i]:words.offsets[i + 1]].tolist()
        runs = [tuple(codes[j:j + window]) for j in range(len(codes) - window + 1)] or ([tuple(codes)] if codes else [])
        for run in runs:
            found.setdefault(run, set()).update([] if item is None else [str(item)])
    symbols = np.zeros((len(found), window), dtype=np.int64)
    for row, run in zip(symbols, found):
        row[window - len(run):] = np.array(run) + 2
    return Windows({w: k + 2 for k, w in enumerate(vocab_bytes(words))}, symbols,
                   np.array([len(run) for run in found], dtype=np.int64), [sorted(s) for s in found.values()])


def occurrences(words, windows: Windows, sample: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(window, stream position) of every occurrence inside one row."""
    none = np.empty(0, dtype=np.int64)
    if not len(windows.lengths) or not len(words.codes):
        return none, none
    known = np.array([windows.vocab.get(w, 0) for w in vocab_bytes(words)], dtype=np.int64)
    stream = known[words.codes]
    inside = stream > 0
    first = np.zeros(len(stream), dtype=bool)
    first[words.offsets[:-1][words.counts > 0]] = True
    begins = np.nonzero(inside & (first | ~np.concatenate([[False], inside[:-1]])))[0]
    ends = np.nonzero(inside & np.concatenate([first[1:] | ~inside[1:], [True]]))[0] + 1
    long = ends - begins >= windows.lengths.min()
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return none, none
    lengths = ends - begins + 1  # a separator after each stretch
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(begins, lengths)
    text = stream[np.minimum(at, len(stream) - 1)]
    text[np.cumsum(lengths) - 1] = SEPARATOR
    index = FMIndex(text, sample)
    which, positions = index.locate(*index.search(windows.symbols, windows.lengths))
    return which, at[positions]


def _mark(batch: pa.RecordBatch, windows: Windows, text_col: str) -> pa.RecordBatch:
    words = split_words(pc.struct_field(batch["doc"], text_col), ALNUM)
    which, at = occurrences(words, windows)
    row = np.searchsorted(words.offsets, at, side="right") - 1
    edges = np.zeros(len(words.codes) + 1, dtype=np.int32)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + windows.lengths[which], -1)
    spans, items = batch["spans"].to_pylist(), batch["items"].to_pylist()
    pairs = np.unique(np.stack([row, which], axis=1), axis=0) if len(row) else np.empty((0, 2), dtype=np.int64)
    for i, k in pairs.tolist():
        items[i] = items[i] + windows.items[k]
    hit = np.cumsum(edges)[:-1] > 0
    for i in np.unique(row).tolist():
        a, b = words.offsets[i], words.offsets[i + 1]
        mask = hit[a:b].copy()
        for s in spans[i]:  # of earlier chunks
            mask[s["start"]:s["start"] + s["length"]] = True
        change = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        spans[i] = [{"start": s, "length": e - s} for s, e in change.reshape(-1, 2).tolist()]
        items[i] = sorted(set(items[i]))
    return pa.RecordBatch.from_arrays(
        [batch["doc"], pa.array(words.counts.astype(np.int64)),
         pa.array(spans, type=batch["spans"].type), pa.array(items, type=batch["items"].type)],
        names=["doc", "n_words", "spans", "items"])


def benchmark_chunks(benchmark: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``chunk_bytes`` of text, by item."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // chunk_bytes))
    part = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n))
    return [benchmark.where(part == i).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) for i in range(n)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", item_text: str = "text",
                  text_col: str = "text", window: int = 13, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``n_words``, ``spans``
    (merged hit spans, in words), ``items`` (ids of matching items, sorted as
    strings), ``n_hit`` and ``contaminated`` (a twentieth of the words or
    more are hit)."""
    out = docs.select(F.struct("*").alias("doc"), F.lit(0).cast("bigint").alias("n_words"),
                      F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([out.schema["doc"]] + T.StructType.fromDDL(
        f"n_words bigint, spans {SPANS}, items array<string>").fields)
    for chunk in benchmark_chunks(benchmark, id_col, item_text, chunk_bytes):
        rows = chunk.toArrow()  # at most chunk_bytes
        windows = windows_of(rows["id"].to_pylist(), rows["text"], window)

        def mark(batches, windows=windows):
            for batch in batches:
                for shard in shards(batch, pc.struct_field(batch["doc"], text_col), SHARD_BYTES):
                    yield _mark(shard, windows, text_col)

        out = out.mapInArrow(releasing_map(mark), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return (out.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))

