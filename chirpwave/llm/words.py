"""Word streams of text columns, as numpy arrays.

Every word operator of this subpackage reads an Arrow string column and
works on one flat *word stream*: an integer code per word, the distinct
words behind the codes, and the offset of every row's first word.  Splitting
and dictionary encoding run inside Arrow, so no Python code runs per word.

Nulls and texts without words are rows with no words.  Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_IDENTITY = np.arange(256, dtype=np.uint8)


def _lowered() -> np.ndarray:
    table = _IDENTITY.copy()
    table[ord("A"):ord("Z") + 1] += 32
    return table


#: words ``[^\x20\x09-\x0D]+``, unchanged
PLAIN = _IDENTITY
#: the same words with A-Z lower-cased
LOWER = _lowered()


def _alnum() -> np.ndarray:
    table = _lowered()
    keep = np.zeros(256, dtype=bool)
    keep[ord("0"):ord("9") + 1] = True
    keep[ord("a"):ord("z") + 1] = True
    keep[128:] = True
    table[~keep[table]] = 32
    return table


#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text
ALNUM = _alnum()


@dataclass
class Words:
    """``codes[offsets[i]:offsets[i + 1]]`` are row i's words; ``vocab[code]`` is the word."""

    codes: np.ndarray
    vocab: pa.Array
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int64), self.counts)


def shards(batch: pa.RecordBatch, texts: pa.Array, limit: int):
    """Consecutive rows of ``batch`` with at most ``limit`` bytes of text (or one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    total, start = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total + size > limit and i > start:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def byte_map(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """``texts`` as bytes with every byte replaced through a 256-entry table."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    if table is _IDENTITY or data is None:
        return texts
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(at):
        return texts
    mapped = table[np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]]  # of these rows only
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at - at[0]), pa.py_buffer(mapped)])


def split_words(texts: pa.Array | pa.ChunkedArray, table: np.ndarray = PLAIN) -> Words:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    mapped = byte_map(texts, table).cast(pa.large_string(), safe=False)
    parts = pc.ascii_split_whitespace(mapped)
    words, offsets = parts.flatten(), np.asarray(parts.offsets, dtype=np.int64)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, dtype=np.int64)
    full = np.asarray(pc.greater(pc.binary_length(words), 0))
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        words, offsets = words.filter(pa.array(full)), before[offsets]
    coded = words.dictionary_encode()
    return Words(np.asarray(coded.indices, dtype=np.int64), coded.dictionary, offsets.astype(np.int64))


def vocab_bytes(words: Words) -> list[bytes]:
    return words.vocab.cast(pa.large_binary()).to_pylist()


def digests(vocab: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of distinct words as two uint64 arrays."""
    raw = b"".join(map(xxhash.xxh3_128_digest, vocab))
    both = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 arithmetic wraps on purpose)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Order-sensitive 64-bit hash of every run of ``n`` consecutive words
    of the stream (length ``len(hashes) - n + 1``; runs may cross rows)."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    m = len(hashes) - n + 1
    factor = np.uint64((0x9E3779B97F4A7C15 + 2 * salt) & (2**64 - 1) | 1)
    out = hashes[:m].copy()
    for i in range(1, n):
        out *= factor
        out += hashes[i:i + m]
    return mix(out)


def inside(offsets: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which runs of ``n`` words starting at each stream position stay in one row."""
    m = max(total - n + 1, 0)
    ok = np.zeros(total + 1, dtype=np.int32)
    lengths = np.diff(offsets)
    rows = np.nonzero(lengths >= n)[0]
    np.add.at(ok, offsets[rows], 1)
    np.add.at(ok, offsets[rows + 1] - n + 1, -1)
    return np.cumsum(ok)[:m] > 0


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values."""
    span, out = 1, values
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
