"""Operator 10: language identification by cross-parsing entropy.

Each language's training text becomes a suffix automaton, which accepts
exactly the substrings of that text.  A document is parsed against an
automaton into longest matches: a phrase ends where the automaton has no
transition, and the next phrase starts there.  The language whose text
needs the fewest phrases per byte is the nearest in cross entropy.

Texts are lower-cased and parsed as UTF-8 bytes, so any script works with an
alphabet of at most 256; ASCII non-letters count as a space.  The parse
restarts every ``segment`` bytes.  That makes all segments of a batch
independent: they advance together, one table lookup per byte and language.

Training uses at most ``train_rows`` labelled rows per language, whole: those
with the smallest content hash, rows of more than ``row_bytes`` bytes only
where a language has too few others; rows of equal text are one.  Both are
parameters; nothing else bounds the sample, and scoring always covers whole
texts.  An automaton is stored as a double array of at most 40 bytes for each
byte of the sample, whatever the alphabet: 50 languages of 200 kB of sample
take at most 400 MB in a Python worker, usually some 250 MB.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without any training row all texts are ``und``; ties go to the
alphabetically first language; rows with a null id are scored, never trained
on and not held out; repeated rows are scored one by one, and rows that share
an id all train; an empty table gives an empty result; the input row stays in
the struct ``doc``, so extra columns clash with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_ROWS = 64
ROW_BYTES = 8192
SEGMENT = 512


def fold(id_col: str, n: int):
    """The contract's fold: crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def _byte_table() -> np.ndarray:
    table = np.full(256, 32, dtype=np.uint8)
    table[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[128:] = np.arange(128, 256)
    return table


BYTES = _byte_table()


def lowered_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mapped bytes of all rows, and row offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    rows = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_binary())
    offsets = np.frombuffer(rows.buffers()[1], dtype=np.int64)[rows.offset:rows.offset + len(rows) + 1]
    data = rows.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return BYTES[flat], offsets - offsets[0]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings, by state; state 0 is the root."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return moves


@dataclass
class Compact:
    """An automaton as a double array: state s moves on symbol c to
    ``target[base[s] + c]`` if ``owner[base[s] + c]`` is s, and not at all
    otherwise.  The root's moves are apart, in ``root`` (0 where it has none)."""

    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    root: np.ndarray


def compact(moves: list[dict[int, int]], alphabet: int, seed: int = 0) -> Compact:
    """States of several moves are tried at random places, all at once, those
    of most moves first, until none is left; the others fill the gaps."""
    root = np.zeros(alphabet, dtype=np.int32)
    root[list(moves[0])] = list(moves[0].values())
    sizes = np.array([0] + [len(m) for m in moves[1:]], dtype=np.int64)
    state = np.repeat(np.arange(len(moves)), sizes)
    symbol = np.array([c for m in moves[1:] for c in m], dtype=np.int64)
    to = np.array([t for m in moves[1:] for t in m.values()], dtype=np.int32)
    first = np.cumsum(sizes) - sizes
    room = int(1.3 * len(symbol)) + 2 * alphabet
    owner = np.full(room + 2 * alphabet, -1, dtype=np.int32)  # states without a place look at the end, which stays empty
    target, base = np.zeros(len(owner), dtype=np.int32), np.full(len(moves), room + alphabet, dtype=np.int32)
    rng = np.random.default_rng(seed)
    for size in np.unique(sizes[sizes > 1])[::-1].tolist():
        left = np.nonzero(sizes == size)[0]
        while len(left):
            edges = first[left][:, None] + np.arange(size)
            slots = rng.integers(0, room, len(left))[:, None] + symbol[edges]
            free = (owner[slots] < 0).all(axis=1)
            # of states that want the same slot, the first one gets it
            wanted = np.full(len(owner), len(left))
            np.minimum.at(wanted, slots[free].ravel(), np.repeat(np.nonzero(free)[0], size))
            won = free & (wanted[slots] == np.arange(len(left))[:, None]).all(axis=1)
            got, at, e = left[won], slots[won], edges[won]
            owner[at], target[at] = got[:, None], to[e]
            base[got] = at[:, 0] - symbol[e[:, 0]]
            left = left[~won]
    single = np.nonzero(sizes == 1)[0]
    at = alphabet + np.nonzero(owner[alphabet:room + alphabet] < 0)[0][:len(single)]
    owner[at], target[at] = single, to[first[single]]
    base[single] = at - symbol[first[single]]
    return Compact(base, owner, target, root)


def phrases(flat: np.ndarray, offsets: np.ndarray, tables: list[Compact], codes: np.ndarray,
            segment: int = SEGMENT) -> np.ndarray:
    """Phrase counts (rows x languages).  ``codes`` maps bytes to symbols."""
    lengths = np.diff(offsets)
    pieces = -(-lengths // segment)
    row = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = offsets[row] + nth * segment
    size = np.minimum(segment, offsets[row + 1] - start)
    order = np.argsort(-size, kind="stable")
    row, start, size = row[order], start[order], size[order]
    symbols = codes[flat]
    alive = np.searchsorted(-size, -np.arange(1, segment + 1), side="right")  # segments with at least that many bytes
    state = [np.zeros(len(row), dtype=np.int32) for _ in tables]
    found = [np.zeros(len(row), dtype=np.int32) for _ in tables]
    for step in range(int(size[0]) if len(size) else 0):
        n = alive[step]
        column = symbols[start[:n] + step]
        for s, f, table in zip(state, found, tables):
            slot = table.base[s[:n]] + column
            new = table.owner[slot] != s[:n]  # no move (the root has none here): the symbol starts a phrase
            f[:n] += new
            s[:n] = np.where(new, table.root[column], table.target[slot])
    return np.stack([np.bincount(row, weights=f, minlength=len(lengths)) for f in found], axis=1)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held_out: int,
          train_rows: int, row_bytes: int) -> dict[str, bytes]:
    """Training bytes of every language: its sampled rows, joined by spaces."""
    labelled = (docs.where((fold(id_col, folds) != held_out) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
                .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")))
    order = Window.partitionBy("lang").orderBy("long", "h")
    # hashes only; each task passes on no more than train_rows of a language
    chosen = (labelled.select("lang", (F.octet_length("text") > row_bytes).alias("long"), "h").distinct()
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= train_rows).select("lang", "h"))
    rows = labelled.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    table = rows.orderBy("lang", "h").toArrow()  # train_rows rows of each language
    flat, offsets = lowered_bytes(table["text"])
    parts: dict[str, list[bytes]] = {}
    for lang, a, b in zip(table["lang"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        parts.setdefault(lang, []).append(flat[a:b].tobytes())
    return {lang: b" ".join(p) for lang, p in parts.items()}


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held_out: int = 2, train_rows: int = TRAIN_ROWS, row_bytes: int = ROW_BYTES,
             segment: int = SEGMENT) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``held_out``,
    ``lang_pred``, ``score`` (0 to 1: by what part the best language needs
    fewer phrases than the second) and ``phrases`` (phrases per 1,000 bytes
    of each language)."""
    samples = train(docs, id_col, text_col, lang_col, folds, held_out, train_rows, row_bytes)
    langs = sorted(samples)
    used = np.unique(np.frombuffer(b"".join(samples.values()) + b" ", dtype=np.uint8))
    alphabet = len(used) + 1  # the last symbol is any other byte
    codes = np.full(256, len(used), dtype=np.int32)
    codes[used] = np.arange(len(used))
    tables = docs.sparkSession.sparkContext.broadcast(
        [compact(suffix_automaton(codes[np.frombuffer(samples[x], dtype=np.uint8)].tolist()), alphabet) for x in langs])

    out = docs.select(F.struct("*").alias("doc"), F.coalesce(fold(id_col, folds) == held_out, F.lit(False)).alias("held_out"))
    schema = T.StructType(out.schema.fields + T.StructType.fromDDL(
        "lang_pred string, score double, phrases map<string,double>").fields)

    def predict(batches):
        for batch in batches:
            texts = pc.struct_field(batch["doc"], text_col)
            lettered = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False), dtype=bool)
            flat, offsets = lowered_bytes(texts)
            if langs:
                counts = phrases(flat, offsets, tables.value, codes, segment)
                best = counts.argmin(axis=1)
                low = counts[np.arange(len(counts)), best]
                rest = counts.copy()
                rest[np.arange(len(counts)), best] = np.inf
                second = rest.min(axis=1)
                score = np.where(np.isinf(second), 1.0, 1 - low / np.maximum(second, 1))
                rate = counts * 1000 / np.maximum(np.diff(offsets), 1)[:, None]
            else:
                best, score = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
                rate, lettered = np.zeros((len(texts), 0)), np.zeros(len(texts), dtype=bool)
            pred = [langs[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], batch["held_out"], pa.array(pred, type=pa.string()),
                 pa.array(np.where(lettered, score, 0.0), type=pa.float64()),
                 pa.MapArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * len(langs),
                                         pa.array(langs * len(texts), type=pa.string()),
                                         pa.array(rate.ravel(), type=pa.float64()))], names=["doc", "held_out", "lang_pred", "score", "phrases"])

    return out.mapInArrow(predict, schema)
