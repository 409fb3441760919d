"""Operator 1: substring dedup by relative Lempel-Ziv parsing against
indexed reference blocks.

Every bucket of the key exchange is an indexed *reference block*: it holds
the ``window``-word seeds of one range of the seed space with the earliest
document and offset of each.  Every window of a document is looked up in the
block of its seed.  The document is then factored greedily from left to
right: a factor is anchored at the earliest occurrence of its first window,
grows in that source, and the next one is anchored where it ends.  At factor
ends the windows that reach across are checked, so that a passage over the
seam of two factors is found too.  Factors have ``window`` words or more;
their union, the duplicate text, is exactly the words of all windows that an
earlier document holds.

Growth follows the looked-up occurrences.  Where fewer than ``window`` windows in a
row occur in a still earlier document, the windows around them prove the
source's words equal and the factor goes on; after a longer stretch of that
kind the parse is anchored anew.

Seeds are not all shuffled.  The smallest ``anchor``-word hash inside a
window is the same wherever the window occurs, so a window can only repeat if
its anchor does.  Anchors (about one word in five) are exchanged first, then
the seeds of shared anchors only.  Seeds are compared by 96-bit digests.

Defined cases: a null or empty text has no words and nothing to remove; a
text of fewer than ``window`` words keeps all of them; rows that share an id
are no sources for each other (only a smaller id is); a row with a null id
keeps all its words and is no source; windows are judged on the input, so
removal never cascades; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chirpwave.llm import exchange as X
from chirpwave.llm.memory import releasing
from chirpwave.llm.words import digests, grams, inside, sliding_min, split_words, vocab_bytes

SEED = (np.dtype("<u8"), np.dtype("<u4"), np.dtype("<i8"), np.dtype("<u4"))  # digest, digest, document, offset
FACTORS = "array<struct<start:int,length:int,source:bigint,source_start:int>>"


class _Slice:
    """The windows of one slice of documents."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, window: int, anchor: int):
        self.docs = table["doc"]
        self.texts = pc.struct_field(self.docs, text_col)
        ids = pc.struct_field(self.docs, id_col)
        self.known = np.asarray(ids.is_valid())
        self.ids = np.asarray(pc.fill_null(ids, 0).cast(pa.int64()))
        self.words = split_words(self.texts)
        first, second = digests(vocab_bytes(self.words)) if len(self.words.vocab) else (np.empty(0, np.uint64),) * 2
        self.hashes, self.others = first[self.words.codes], second[self.words.codes]
        total = len(self.hashes)
        row = self.words.rows()
        whole = inside(self.words.offsets, window, total)
        self.starts = np.nonzero(whole)[0]
        self.starts = self.starts[self.known[row[self.starts]]]
        self.row = row[self.starts]
        self.window, self.anchor = window, anchor

    def anchors(self) -> np.ndarray:
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        return sliding_min(grams(self.hashes, self.anchor, 1), self.window - self.anchor + 1)[self.starts]

    def seeds(self, chosen=slice(None)):
        if not len(self.starts):
            return [np.empty(0, dtype=d) for d in SEED]
        starts, row = self.starts[chosen], self.row[chosen]
        return [grams(self.hashes, self.window, 2)[starts],
                (grams(self.others, self.window, 3)[starts] >> np.uint64(32)).astype("<u4"),
                self.ids[row], (starts - self.words.offsets[row]).astype("<u4")]


def _first_per_seed(fields):
    """Sort by (seed, document, offset); positions of each seed's first entry."""
    order = np.lexsort((fields[3], fields[2], fields[1], fields[0]))
    fields = [f[order] for f in fields]
    return order, fields, X.run_starts(fields[0], fields[1])


def _index_block(table: pa.Table) -> pa.Table:
    """A reference block: earliest document and offset of every seed, told to
    the slices whose own earliest document is later."""
    senders, fields = X.received(table, SEED)
    order, fields, starts = _first_per_seed(fields)
    lengths = np.diff(np.append(starts, len(order)))
    source, offset = np.repeat(fields[2][starts], lengths), np.repeat(fields[3][starts], lengths)
    told = source < fields[2]
    return X.answered(senders[order][told], [fields[0][told], fields[1][told], source[told], offset[told]])


def factor(starts, row, source, offset, window):
    """Greedy parse into factors of the windows that match an earlier document.

    ``starts`` are the windows' stream positions in order, with the earliest
    occurrence of each.  A factor is anchored at its first window's occurrence
    and grows there: windows on the same diagonal (same document, same
    distance) that overlap or touch prove all words between them equal, also
    where a window in between occurs in a still earlier document.  The next
    factor starts where this one ends, and windows across the seam become
    factors of their own; if no matching window starts at the end, the next
    factor is the first window that reaches across or lies behind.  Returns (row, start, length,
    source, source offset) arrays, start in stream positions."""
    if not len(starts):
        return [np.empty(0, dtype=np.int64)] * 5
    new = np.ones(len(starts), dtype=bool)
    new[1:] = ((starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1])
               | (source[1:] != source[:-1]) | (offset[1:] != offset[:-1] + 1))
    at = np.nonzero(new)[0]  # runs along a diagonal
    run = np.cumsum(new) - 1
    ends = starts[np.append(at[1:], len(starts)) - 1] + window
    order = np.lexsort((starts[at], (offset - starts)[at], source[at], row[at]))
    first, until = at[order], ends[order]
    apart = np.ones(len(at), dtype=bool)
    apart[1:] = ((row[first][1:] != row[first][:-1]) | (source[first][1:] != source[first][:-1])
                 | ((offset - starts)[first][1:] != (offset - starts)[first][:-1]) | (starts[first][1:] > until[:-1]))
    grown = np.empty(len(at), dtype=np.int64)  # where each run's diagonal stops matching
    grown[order] = until[np.append(np.nonzero(apart)[0][1:], len(at)) - 1][np.cumsum(apart) - 1]
    places, stops = starts.tolist(), grown[run].tolist()
    chosen, i = [], 0
    while i < len(places):
        chosen.append(i)
        end = stops[i]
        seam, following = bisect_left(places, end - window + 1, i + 1), bisect_left(places, end, i + 1)
        if following == len(places) or places[following] != end:
            i = seam
            continue
        while seam < following:
            chosen.append(seam)
            seam = bisect_left(places, stops[seam] - window + 1, seam + 1)
        i = following
    chosen = np.array(chosen)
    return [row[chosen], starts[chosen], grown[run][chosen] - starts[chosen], source[chosen], offset[chosen]]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                    anchor: int = 5, slices: int | None = None) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``n_words``,
    ``n_removed``, ``kept_text`` (kept words joined by one space; the text as
    it was where nothing is removed), ``kept_sha256`` (of the kept words
    joined by one space) and ``factors`` (start, length, source document and
    start there, in words)."""
    n = X.slice_count(docs.sparkSession, slices)
    parts = X.sliced(docs, X.byte_slices(docs, text_col, slices), id_col, text_col)

    def cut(table):
        return _Slice(table, id_col, text_col, window, anchor)

    def anchors_of(table):
        part = cut(table)
        anchors, owner = part.anchors(), part.ids[part.row]
        new = np.ones(len(anchors), dtype=bool)  # neighbours mostly share an anchor
        new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
        anchors, owner = anchors[new], owner[new]
        order = np.argsort(anchors, kind="stable")
        anchors, owner = anchors[order], owner[order]
        at = X.run_starts(anchors)
        several = np.ones(len(at), dtype="<u4")
        if len(at):
            several += np.minimum.reduceat(owner, at) < np.maximum.reduceat(owner, at)
        return anchors[at], several

    live = X.shared_keys(parts, n, anchors_of)

    def send_seeds(key, table, reply):
        if not table.num_rows:
            return X.asked(0, np.empty(0, np.int32), [])
        part = cut(table)
        _, (keys, _) = X.unpack(reply["payload"].to_pylist(), X.KEY_COUNT)
        fields = part.seeds(np.isin(part.anchors(), keys))
        _, fields, at = _first_per_seed(fields)
        fields = [f[at] for f in fields]
        return X.asked(key[0].as_py(), X.bucket_of(fields[0], n), fields)

    index = (parts.groupBy("slice").cogroup(live.groupBy("slice")).applyInArrow(releasing(send_seeds), X.ASKED)
             .groupBy("bucket").applyInArrow(releasing(_index_block), X.ANSWERED))

    schema = T.StructType([parts.schema["doc"]] + T.StructType.fromDDL(
        f"n_words bigint, n_removed bigint, kept_text string, kept_sha256 string, factors {FACTORS}").fields)

    def parse(key, table, reply):
        if not table.num_rows:
            return None
        part = cut(table)
        _, told = X.unpack(reply["payload"].to_pylist(), SEED)
        fields = part.seeds()
        own = len(fields[0])
        fields = [np.concatenate(pair) for pair in zip(fields, told)]
        order = np.argsort(fields[0])
        at = X.run_starts(fields[0][order])
        lengths = np.diff(np.append(at, len(order)))
        order = order[np.repeat(lengths > 1, lengths)]  # seeds seen twice, here or in a block
        within, sub, at = _first_per_seed([f[order] for f in fields])
        lengths = np.diff(np.append(at, len(order)))
        source, offset = np.repeat(sub[2][at], lengths), np.repeat(sub[3][at], lengths)
        hit = (source < sub[2]) & (order[within] < own)
        window_at, source, offset = order[within][hit], source[hit], offset[hit].astype(np.int64)
        back = np.argsort(window_at)
        window_at, source, offset = window_at[back], source[back], offset[back]
        starts, row = part.starts[window_at], part.row[window_at]
        f_row, f_start, f_length, f_source, f_offset = factor(starts, row, source, offset, window)
        edges = np.zeros(len(part.hashes) + 1, dtype=np.int32)
        np.add.at(edges, f_start, 1)
        np.add.at(edges, f_start + f_length, -1)
        return _result(part, table["doc"], np.cumsum(edges)[:-1] > 0, f_row, f_start, f_length, f_source, f_offset)

    def run(key, table, reply):
        out = parse(key, table, reply)
        return out if out is not None else _empty(schema)

    return parts.groupBy("slice").cogroup(index.groupBy("slice")).applyInArrow(releasing(run), schema)


def _empty(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema).empty_table()


def _result(part: _Slice, docs, removed, f_row, f_start, f_length, f_source, f_offset) -> pa.Table:
    offsets = part.words.offsets
    before = np.concatenate([[0], np.cumsum(removed)])
    n_removed = before[offsets[1:]] - before[offsets[:-1]]
    kept_text, sha = [], []
    for i, text in enumerate(part.texts.to_pylist()):
        words = text.encode().split() if text else []
        if n_removed[i]:
            words = list(compress(words, (~removed[offsets[i]:offsets[i + 1]]).tolist()))
        joined = b" ".join(words)
        kept_text.append(joined.decode() if n_removed[i] else text)
        sha.append(hashlib.sha256(joined).hexdigest())
    bounds = np.searchsorted(f_row, np.arange(len(offsets)))
    factors = pa.StructArray.from_arrays(
        [pa.array((f_start - offsets[f_row]).astype(np.int32)), pa.array(f_length.astype(np.int32)),
         pa.array(f_source.astype(np.int64)), pa.array(f_offset.astype(np.int32))],
        names=["start", "length", "source", "source_start"])
    return pa.table({"doc": docs, "n_words": pa.array(part.words.counts.astype(np.int64)),
                     "n_removed": pa.array(n_removed.astype(np.int64)),
                     "kept_text": pa.array(kept_text, type=pa.string()), "kept_sha256": pa.array(sha, type=pa.string()),
                     "factors": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), factors)})
