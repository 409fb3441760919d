"""Two-way key exchange between slices of a table.

Many corpus operators ask a question about keys (word windows, shingles,
words) that span the whole corpus, and need the answer back beside each
document.  Shuffling one row per key occurrence would multiply the corpus
several times.  Here the documents are dealt into *slices* (groups of
documents that fit a task) and the keys into *buckets*:

1. each slice sends every bucket its distinct keys, already aggregated, as
   one packed binary row;
2. each bucket combines what the slices sent;
3. the answers go back to the slices that asked, again one packed row each.

A key that a third of all documents hold reaches its bucket once per slice,
not once per document.  No step gathers more than one slice or one bucket,
and the number of packed rows never exceeds the number of distinct
(slice, key) pairs.  Slices are keyed on the row's content, so that they are
the same when a lost executor's task runs again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpwave.llm.memory import releasing

ASKED = "slice int, bucket int, payload binary"
ANSWERED = "slice int, payload binary"
KEY_COUNT = (np.dtype("<u8"), np.dtype("<u4"))


#: text of a slice that its task holds at a time
SLICE_BYTES = 8 << 20


def slice_count(spark: SparkSession, slices: int | None = None) -> int:
    """Two per shuffle partition: for buckets, and for slices of records that
    are bounded already."""
    return slices or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_slices(docs: DataFrame, text_col: str, slices: int | None = None) -> int:
    """Slices of whole texts: as many as the corpus has ``SLICE_BYTES`` of
    text, whatever the number of partitions (a task works through its slices
    one by one).  Counts the bytes in one pass."""
    if slices:
        return slices
    size = docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    return max(1, -(-size // SLICE_BYTES))


def sliced(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``(slice, doc)`` with every input column inside the struct ``doc``, so
    that no input column can clash with an operator's own.  The text is part
    of the slice key: rows without an id still spread."""
    return docs.select(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int").alias("slice"),
                       F.struct("*").alias("doc"))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Even ranges of the 64-bit key space."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def pack(owner: np.ndarray, fields: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """One blob per owner.  Fields are stored byte plane by byte plane, which
    the shuffle's compression reduces to the planes that carry information."""
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    starts = np.nonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))[0] if len(owner) else np.empty(0, dtype=np.int64)
    ends = np.append(starts[1:], len(owner))
    planes = [np.ascontiguousarray(f[order]).view(np.uint8).reshape(len(owner), f.dtype.itemsize) for f in fields]
    blobs = [b"".join(p[a:b].T.tobytes() for p in planes) for a, b in zip(starts, ends)]
    return owner[starts], blobs


def unpack(blobs: list[bytes], dtypes) -> tuple[np.ndarray, list[np.ndarray]]:
    """The blob number of every record, and the fields."""
    dtypes = [np.dtype(d) for d in dtypes]
    width = sum(d.itemsize for d in dtypes)
    counts = [len(b) // width for b in blobs]
    fields: list[list[np.ndarray]] = [[] for _ in dtypes]
    for blob, n in zip(blobs, counts):
        raw, at = np.frombuffer(blob, dtype=np.uint8), 0
        for out, d in zip(fields, dtypes):
            size = n * d.itemsize
            out.append(np.ascontiguousarray(raw[at:at + size].reshape(d.itemsize, n).T).view(d).ravel())
            at += size
    return (np.repeat(np.arange(len(blobs)), counts),
            [np.concatenate(f) if f else np.empty(0, dtype=d) for f, d in zip(fields, dtypes)])


def asked(slice_id: int, buckets: np.ndarray, fields: list[np.ndarray]) -> pa.Table:
    owners, blobs = pack(buckets, fields)
    return pa.table({"slice": pa.array(np.full(len(owners), slice_id, dtype=np.int32)),
                     "bucket": pa.array(owners.astype(np.int32)), "payload": pa.array(blobs, type=pa.binary())})


def answered(slices: np.ndarray, fields: list[np.ndarray]) -> pa.Table:
    owners, blobs = pack(slices, fields)
    return pa.table({"slice": pa.array(owners.astype(np.int32)), "payload": pa.array(blobs, type=pa.binary())})


def received(table: pa.Table, dtypes) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sending slice of every record of a bucket, and the fields."""
    rows, fields = unpack(table["payload"].to_pylist(), dtypes)
    return np.asarray(table["slice"], dtype=np.int32)[rows], fields


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal values in sorted columns."""
    if not len(columns[0]):
        return np.empty(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.nonzero(new)[0]


def count_keys(asks: DataFrame, least: int = 2) -> DataFrame:
    """Answers to slices that sent (key, count) records (``KEY_COUNT``): the
    keys whose counts total ``least`` or more over all slices, with the total."""
    def count(table):
        senders, (keys, counts) = received(table, KEY_COUNT)
        order = np.argsort(keys, kind="stable")
        keys, senders = keys[order], senders[order]
        starts = run_starts(keys)
        totals = np.add.reduceat(counts[order].astype(np.int64), starts) if len(starts) else np.empty(0, dtype=np.int64)
        totals = np.repeat(totals, np.diff(np.append(starts, len(keys))))
        enough = totals >= least
        return answered(senders[enough], [keys[enough], np.minimum(totals[enough], 2**32 - 1).astype("<u4")])

    return asks.groupBy("bucket").applyInArrow(releasing(count), ANSWERED)


def ask_counts(slice_id: int, keys: np.ndarray, counts: np.ndarray, n: int) -> pa.Table:
    return asked(slice_id, bucket_of(keys, n), [keys, counts.astype("<u4")])


def shared_keys(slices: DataFrame, n: int, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
                least: int = 2) -> DataFrame:
    """For every slice, which of its keys belong to ``least`` or more documents
    of the whole corpus, with that number (fields ``KEY_COUNT``).

    ``keys_of(table)`` gives a slice's distinct 64-bit keys and the number of
    its documents that hold each.  Keys that collide are only answered
    needlessly; callers decide on full digests."""
    def ask(key, table):
        return ask_counts(key[0].as_py(), *keys_of(table), n)

    return count_keys(slices.groupBy("slice").applyInArrow(releasing(ask), ASKED), least)
