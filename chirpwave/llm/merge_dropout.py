"""Operator 9: SentencePiece (merge type) encoding and decoding with seeded
merge-dropout.

A word (the text between two spaces, with the space marker in front) starts
as its characters.  An agenda holds its mergeable neighbours, best score
first, leftmost first among equals.  Each candidate taken from the agenda is
skipped if a keyed hash of (seed, document id, number of the word in the
document, position, merged piece) falls below ``dropout``; otherwise the two
symbols merge and their new neighbours enter the agenda.  Every occurrence of
a word draws anew.  The hash makes the varied segmentation repeatable: the
same seed gives the same ids on any cluster and after any retry.  With
``dropout=0`` the ids are those of the sentencepiece library, apart from runs
of spaces, whose marker-only pieces are not merged.

The agendas of all words of a shard advance together, one candidate per word
and round, as array operations.  Occurrences of a word whose draws were alike
so far share one agenda, which splits where their draws differ; words over
``LONG`` characters use a heap each.  Decoding concatenates piece bytes.  Characters
without a piece, and the marker character where a text itself holds it,
become byte pieces, so decoding gives back every text byte for byte.

The vocabulary file is a parameter, read once on the driver; its 32,000-odd
pieces travel with the tasks.  No shuffle.

Defined cases: a null text has null tokens, an empty one none; both count 0
tokens and are lossless; rows with a null id draw by their text instead;
repeated rows are encoded one by one, alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirpwave.llm.memory import releasing_map
from chirpwave.llm.words import mix, shards

MARK = "▁"
LONG = 256
SHARD_BYTES = 3 << 20
NEVER = np.int64(1) << 40
KEY = np.uint64(0x9E3779B97F4A7C15)


class MergeVocabulary:
    """Pieces, merges and byte pieces of a merge-type model."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool], byte_ids: list[int]):
        self.size = len(pieces)
        byte_of = {i: b for b, i in enumerate(byte_ids)}
        self.bytes = [bytes([byte_of[i]]) if i in byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.byte_ids = np.array(byte_ids, dtype=np.int64)
        usable = {p: i for i, p in enumerate(pieces) if normal[i] and MARK not in p[1:]}
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in usable.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.mark = usable[MARK]
        self.char[ord(MARK)] = -1  # only the word's own first symbol is the marker
        by_score = sorted((i for p, i in usable.items() if len(p) > 1), key=lambda i: (-scores[i], i))
        rank = {i: k for k, i in enumerate(by_score)}
        self.piece_of_rank = np.array(by_score, dtype=np.int64)
        merges = {}
        for p, i in usable.items():
            for cut in range(1, len(p)):
                left, right = usable.get(p[:cut]), usable.get(p[cut:])
                if left is not None and right is not None and p[cut:] != MARK:
                    merges[left << 32 | right] = rank[i]
        self.keys = np.array(sorted(merges), dtype=np.int64)
        self.ranks = np.array([merges[k] for k in self.keys.tolist()], dtype=np.int64)

    @classmethod
    def load(cls, path: str) -> MergeVocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        return cls([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], normal,
                   [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of symbol pairs, ``NEVER`` where they do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Initial symbols of the words (each led by the marker) and their
        offsets.  A character without a piece is ``size + code point``."""
        sizes = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
        points = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le"), dtype=np.uint32) if words else np.empty(0, np.uint32)
        out = self.char[points].astype(np.int64)
        out = np.where(out < 0, self.size + points.astype(np.int64), out)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        out[offsets[:-1]] = self.mark
        return out, offsets

    def byte_fallback(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace code points without a piece by the byte pieces of their UTF-8."""
        point = symbols - self.size
        size = np.where(point < 0, 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        at = np.concatenate([[0], np.cumsum(size)])
        out = np.repeat(symbols, size)
        for k in range(1, 5):
            which = np.nonzero((point >= 0) & (size == k))[0]
            lead = (0x00, 0xC0, 0xE0, 0xF0)[k - 1]
            for j in range(k):
                part = point[which] >> (6 * (k - 1 - j))
                out[at[which] + j] = self.byte_ids[(lead | part) if j == 0 else (0x80 | part & 0x3F)]
        return out, at[offsets]


def word_keys(documents: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    """A key for every word of documents with the given keys and word counts."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    document = mix(documents.astype(np.uint64) ^ mix(np.array([seed % 2**64], dtype=np.uint64) + KEY))
    return mix(np.repeat(document, counts) + nth.astype(np.uint64))


def skipped(word_keys: np.ndarray, position: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    """The keyed hash's decision for agenda candidates."""
    h = mix(word_keys ^ mix(position.astype(np.uint64) << np.uint64(32) | piece.astype(np.uint64)))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def agenda_encode(symbols: list[int], word_key: int, vocabulary: MergeVocabulary, dropout: float) -> list[int]:
    """One word's agenda as a heap (used for long words)."""
    n = len(symbols)
    symbols, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n)) + [-1]
    keys = np.array([word_key], dtype=np.uint64)
    ranks = vocabulary.rank(np.array(symbols[:-1], dtype=np.int64), np.array(symbols[1:], dtype=np.int64)).tolist() if n > 1 else []
    agenda = [(r, i, symbols[i], symbols[i + 1]) for i, r in enumerate(ranks) if r < NEVER]
    heapq.heapify(agenda)
    while agenda:
        r, i, a, b = heapq.heappop(agenda)
        j = right[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        piece = int(vocabulary.piece_of_rank[r])
        if dropout and skipped(keys, np.array([i]), np.array([piece]), dropout)[0]:
            continue
        symbols[i], symbols[j], right[i] = piece, -1, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for p, q in ((left[i], i), (i, right[i])):
            if p >= 0 and q >= 0:
                new = int(vocabulary.rank(np.array([symbols[p]]), np.array([symbols[q]]))[0])
                if new < NEVER:
                    heapq.heappush(agenda, (new, p, symbols[p], symbols[q]))
    return [s for s in symbols if s >= 0]


def gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the lists ``which`` of a flat list array; also their end offsets."""
    sizes = np.diff(offsets)[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) + np.repeat(offsets[:-1][which] - ends[:-1], sizes)
    return flat[at], ends


def _rounds(symbols, sizes, use, at, keys, vocabulary, dropout):
    """Agendas of many words together.  ``sizes``: symbols of each agenda;
    ``at[k]``: the agenda that word use ``use[k]``, of key ``keys[use[k]]``, is in.  Yields finished
    agendas' symbols and sizes, the uses that end in them, and in which."""
    position = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rank = np.full(len(symbols), NEVER)
    same = np.nonzero(position[1:])[0]
    rank[same] = vocabulary.rank(symbols[same], symbols[same + 1])
    while len(symbols):
        starts = np.cumsum(sizes) - sizes
        best = np.minimum.reduceat(rank, starts)
        done = best >= NEVER
        if done.any():
            over, ends = np.repeat(done, sizes), done[at]
            yield symbols[over], sizes[done], use[ends], (np.cumsum(done) - 1)[at[ends]]
            use, at = use[~ends], at[~ends]
        # the leftmost best candidate of each agenda that goes on
        taken = np.nonzero(rank == np.repeat(np.where(done, -1, best), sizes))[0]
        if not len(taken):
            return
        agenda = np.searchsorted(starts, taken, "right") - 1
        leftmost = np.concatenate([[True], agenda[1:] != agenda[:-1]])
        taken, agenda = taken[leftmost], agenda[leftmost]
        piece, at = vocabulary.piece_of_rank[rank[taken]], (np.cumsum(~done) - 1)[at]
        skip = np.zeros(len(taken), dtype=bool)
        source = np.arange(len(taken))
        if dropout:  # an agenda goes on once for each decision that some use takes
            both = 2 * at + skipped(keys[use], position[taken][at], piece[at], dropout)
            some = np.bincount(both, minlength=2 * len(taken)) > 0
            at = (np.cumsum(some) - 1)[both]
            source, skip = np.nonzero(some)[0] >> 1, (np.nonzero(some)[0] & 1).astype(bool)
        old, sizes = starts[agenda[source]], sizes[agenda[source]]
        starts = np.cumsum(sizes) - sizes
        of = np.arange(sizes.sum()) + np.repeat(old - starts, sizes)
        symbols, position, rank = symbols[of], position[of], rank[of]
        taken, piece = taken[source] - old + starts, piece[source]
        rank[taken[skip]] = NEVER
        taken, piece, sizes = taken[~skip], piece[~skip], sizes - ~skip
        symbols[taken] = piece
        keep = np.ones(len(symbols), dtype=bool)
        keep[taken + 1] = False
        moved = (np.cumsum(keep) - 1)[taken]
        symbols, position, rank = symbols[keep], position[keep], rank[keep]
        first = position == 0
        for place in (moved, moved[~first[moved]] - 1):
            rank[place] = NEVER
            pair = place[place + 1 < len(symbols)]
            pair = pair[~first[pair + 1]]
            rank[pair] = vocabulary.rank(symbols[pair], symbols[pair + 1])


def encode_words(words: list[str], keys: np.ndarray, vocabulary: MergeVocabulary, dropout: float,
                 of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all word uses (flat) and their offsets.  ``keys`` are the
    uses' 64-bit hash keys, ``of`` the word of each use (the words in turn)."""
    of = np.arange(len(words)) if of is None else of
    symbols, offsets = vocabulary.symbols(words)
    sizes = np.diff(offsets)
    short = sizes <= LONG
    use = np.nonzero(short[of])[0]
    result, parts, ends, found = np.empty(len(of), dtype=np.int64), [], [], 0
    for ids, counts, uses, which in _rounds(symbols[np.repeat(short, sizes)], sizes[short], use, (np.cumsum(short) - 1)[of[use]],
                                            keys, vocabulary, dropout):
        result[uses] = found + which
        parts.append(ids)
        ends.append(counts)
        found += len(counts)
    known = {}  # without dropout all uses of a word are alike
    for k in np.nonzero(~short[of])[0].tolist():
        i = int(of[k])
        if dropout or i not in known:
            ids = agenda_encode(symbols[offsets[i]:offsets[i + 1]].tolist(), int(keys[k]), vocabulary, dropout)
            parts.append(np.array(ids, dtype=np.int64))
            ends.append(np.array([len(ids)]))
            known[i] = found
            found += 1
        result[k] = known[i]
    if not parts:
        return np.empty(0, dtype=np.int64), offsets[:1]
    flat, ends = vocabulary.byte_fallback(np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(ends))]))
    return gather(flat, ends, result)


def encode_texts(texts: pa.Array, documents: np.ndarray, vocabulary: MergeVocabulary, dropout: float, seed: int):
    """(flat ids, row offsets) of an Arrow string array; ``documents`` are the rows' hash keys."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.split_pattern(filled, " ")
    coded = lists.flatten().dictionary_encode()
    units, offsets = coded.dictionary.to_pylist(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    empty = np.asarray(pc.equal(pc.binary_length(filled), 0), dtype=bool)
    counts = np.where(empty, 0, np.diff(offsets))
    codes = np.asarray(coded.indices, dtype=np.int64)[np.repeat(~empty, np.diff(offsets))]
    tokens, ends = encode_words(units, word_keys(documents, counts, seed), vocabulary, dropout, codes)
    return tokens, ends[np.concatenate([[0], np.cumsum(counts)])]


def decode(tokens: np.ndarray, offsets: np.ndarray, pieces: pa.Array) -> list[bytes]:
    """The texts of encoded rows: piece bytes joined, without the first marker."""
    joined = pieces.take(pa.array(tokens))
    at = np.frombuffer(joined.buffers()[1], dtype=np.int64)[:len(tokens) + 1][offsets] if len(tokens) else np.zeros(len(offsets), int)
    data = joined.buffers()[2].to_pybytes() if len(tokens) else b""
    return [data[a + 1:b] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def piece_encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """One row per input row: ``doc`` (the input row), ``tokens``,
    ``n_tokens`` and ``lossless`` (the tokens were decoded and equal the text)."""
    vocabulary = MergeVocabulary.load(model_path)
    key = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(id_col))
    out = docs.select(F.struct("*").alias("doc"), key.alias("key"))
    schema = T.StructType([out.schema["doc"]] + T.StructType.fromDDL("tokens array<int>, n_tokens bigint, lossless boolean").fields)

    def encode(batches):
        pieces = pa.array(vocabulary.bytes, type=pa.large_binary())
        for batch in batches:
            for shard in shards(batch, pc.struct_field(batch["doc"], text_col), SHARD_BYTES):
                texts = pc.struct_field(shard["doc"], text_col)
                tokens, offsets = encode_texts(texts, np.asarray(shard["key"], dtype=np.int64), vocabulary, dropout, seed)
                back = decode(tokens, offsets, pieces)
                lossless = [b == (t or "").encode() for b, t in zip(back, texts.to_pylist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(tokens.astype(np.int32)))
                lists = pc.if_else(texts.is_valid(), lists, pa.scalar(None, lists.type))
                yield pa.RecordBatch.from_arrays(
                    [shard["doc"], lists, pa.array(np.diff(offsets)), pa.array(lossless, type=pa.bool_())],
                    names=["doc", "tokens", "n_tokens", "lossless"])

    return out.mapInArrow(releasing_map(encode), schema)


def piece_decode(encoded: DataFrame, model_path: str, tokens_col: str = "tokens") -> DataFrame:
    """One row per input row: ``row`` (the input row) and ``text``, decoded from
    its tokens (null for null tokens)."""
    vocabulary = MergeVocabulary.load(model_path)
    out = encoded.select(F.struct("*").alias("row"))
    schema = T.StructType(out.schema.fields + T.StructType.fromDDL("text string").fields)

    def restore(batches):
        pieces = pa.array(vocabulary.bytes, type=pa.large_binary())
        for batch in batches:
            lists = pc.struct_field(batch["row"], tokens_col)
            counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
            texts = decode(np.asarray(pc.list_flatten(lists), dtype=np.int64), np.concatenate([[0], np.cumsum(counts)]), pieces)
            texts = [t.decode() if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, type=pa.string())], names=["row", "text"])

    return out.mapInArrow(releasing_map(restore), schema)
