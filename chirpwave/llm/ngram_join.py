"""Operator 2: n-gram Jaccard join with signature trees.

A document's set holds its distinct ``shingle``-word runs (lower-cased A-Z;
fewer words: the whole sequence as one).  Two documents link when
``100 * shared >= percent * union``.

1. *Sets.*  One pass over the texts writes, per document, its size and a
   digest of its set, and for the first document of each set in a batch a
   signature bitmap and the smallest token hashes (its prefix).  Equal sets
   form one class, which goes on under its smallest id: a set that a third of
   all documents share travels once per batch.
2. *Routing.*  Linked sets share one of the first ``n - ceil(percent n / 100) + 1``
   tokens of any common token order, so the join runs per prefix token.
   Tokens that only one class holds are dropped by the key exchange.  Tokens
   in more than ``hot`` prefixes come last in the order, which every slice
   learns for all tokens it may choose: unrelated documents
   that share a frequent passage do not meet.  A document whose prefix has too
   few other tokens (*dense*) still meets everyone at its frequent ones.
3. *Signature trees.*  Each token's group becomes a tree; a dual traversal
   prunes node pairs by size range and by largest possible overlap of the
   OR-combined bitmaps.  Surviving pairs are verified on whole sets.
4. *Families.*  Large groups of more than ``star`` classes whose trees leave
   more than ``CROWDED`` pairs per member hold many near copies; listing their
   pairs would grow with the square of the group.  Their members that are in a
   possible pair form families (connected by such groups), and each member's whole set travels
   to its family; in a family of several blocks of ``BLOCK_SETS`` members it is
   compared with ``LEADERS`` members first, and travels again once per block of
   members that these leave unconnected.  There
   central members are compared first, a signature tree with wide bitmaps
   prunes node pairs below which all sets are already connected, and only
   links that join components leave.  All pairs of a family are decided, so
   the components are exact.
5. Components are contracted by joins; nothing is collected.

Tokens are 64-bit hashes (prefix tokens travel as their upper 48 bits), class
digests 128-bit.

Defined cases: a null, empty or wordless text has an empty set, size 0,
and is linked with nothing; rows that share an id are one document (they are
in one component); rows with a null id are linked with nothing and have a
null component; equal sets are one class, named by its smallest id; texts of
any length are read whole; an empty table gives an empty result; only the two
columns named are read, so extra columns clash with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpwave.llm import exchange as X
from chirpwave.llm import signature_tree as S
from chirpwave.llm.components import components
from chirpwave.llm.memory import releasing, releasing_map
from chirpwave.llm.words import LOWER, digests, grams, shards, split_words, vocab_bytes
from chirpwave.session import scratch_path

SETS = "id bigint, n bigint, digest binary, tokens binary, bits binary"
CLASSES = 8  # signatures of 64 << class bits
MEMBER = [np.dtype("<i8"), np.dtype("<u4")]  # id, size; its bitmap follows
RECORD = [np.dtype("<u8"), np.dtype("<u4"), np.dtype("u1")]  # token, which of the members sent along, may start a pair
FOUND = "family boolean, u bigint, v bigint"  # a possible pair, or two members of a family
HOT = 1000
STAR = 64
CROWDED = 8
LEADERS = 8
BLOCK_SETS = 2048
WIDEST = 1 << 14  # bits of a family's signatures
CHUNK_WORDS = 1 << 20  # bitmap words of the small groups compared together
SHARD_BYTES = 2 << 20
BROADCAST_IDS = 1_000_000
SLICE_SHINGLES = 1 << 20  # of a slice of sets; their tokens are dealt to as many buckets
GROUP_PAIRS = 5_000


def token_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct token hashes of every row."""
    words = split_words(texts, LOWER)
    hashes = digests(vocab_bytes(words))[0][words.codes] if len(words.vocab) else np.empty(0, np.uint64)
    runs = grams(hashes, shingle)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if b - a >= shingle:
            s = np.sort(runs[a:b - shingle + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def prefix_size(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def size_class(n):
    """Bitmap class of a set size: at least one bit per token, up to 8,192 bits."""
    return np.searchsorted(64 << np.arange(CLASSES - 1), n)


def signature(tokens: np.ndarray) -> np.ndarray:
    width = 64 << int(size_class(len(tokens)))
    marks = np.zeros(width, dtype=np.uint8)
    marks[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").view(np.uint64)


def routing_keys(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of sorted tokens, byte plane by byte plane.  Prefix
    tokens only route; that keeps their order, and tokens that agree in it
    merely meet needlessly."""
    return np.ascontiguousarray(tokens).view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def _keys(blob: bytes) -> np.ndarray:
    planes = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
    planes[:, 2:] = np.frombuffer(blob, dtype=np.uint8).reshape(6, -1).T
    return planes.view("<u8").ravel()


class _Part:
    """The classes of one slice, with flat prefix tokens."""

    def __init__(self, table: pa.Table, percent: int, hot: np.ndarray):
        table = table.sort_by([("digest", "ascending"), ("id", "ascending")])
        digest = np.frombuffer(b"".join(table["digest"].to_pylist()), dtype=np.uint64).reshape(-1, 2)
        self.table = table = table.take(pa.array(X.run_starts(digest[:, 0], digest[:, 1])))
        self.ids, self.sizes = np.asarray(table["id"], dtype=np.int64), np.asarray(table["n"], dtype=np.int64)
        parts = [_keys(b) for b in table["tokens"].to_pylist()]
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        self.tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(parts)), counts)
        start = np.cumsum(counts) - counts
        limit = prefix_size(self.sizes, percent)
        self.hot = np.isin(self.tokens, hot)
        before = np.concatenate([[0], np.cumsum(~self.hot)])
        nth = before[:-1] - before[start[self.doc]]
        self.dense = before[start + counts] - before[start] < limit
        self.chosen = np.where(self.hot, np.arange(len(self.tokens)) - start[self.doc] < limit[self.doc], nth < limit[self.doc])

    def asks(self):
        """Candidate tokens and counts; a frequent one counts only through dense documents (then as shared)."""
        tokens, hot = self.tokens[self.chosen], self.hot[self.chosen]
        weight = np.where(hot, 2 * self.dense[self.doc[self.chosen]], 1)
        keys, which = np.unique(tokens, return_inverse=True)
        return keys, np.bincount(which, weights=weight, minlength=len(keys)).astype(np.int64)


def _folded(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def _received(table: pa.Table, c: int):
    """(ids, sizes, bitmaps) of the members of bitmap class ``c`` that a
    bucket got, and (token, member, may start a pair) of its records."""
    here = table.filter(pa.array([k == c for k in table["class"].to_pylist()]))
    sender, (ids, sizes, bits) = X.unpack(here["members"].to_pylist(), MEMBER + [np.dtype(f"V{8 << c}")])
    bits = bits.view(np.uint64).reshape(len(ids), 1 << c)
    blob, (token, member, must) = X.unpack(here["records"].to_pylist(), RECORD)
    return (ids, sizes.astype(np.int64), bits), (token, member + np.searchsorted(sender, blob), must > 0)


def _groups(table: pa.Table):
    """Per bitmap class (view), the bucket's members and records of that class
    and the next larger one (folded): sets that may link differ by one class
    at most.  Records sorted by token, with whether they are of the view's own class."""
    held = set(table["class"].to_pylist())
    for c in sorted(held):
        (ids, sizes, bits), (token, member, must) = _received(table, c)
        native = np.ones(len(token), dtype=bool)
        if c + 1 in held:
            more, (other, which, may) = _received(table, c + 1)
            near = np.isin(other, token)
            token, member = np.concatenate([token, other[near]]), np.concatenate([member, which[near] + len(ids)])
            must, native = np.concatenate([must, may[near]]), np.concatenate([native, np.zeros(near.sum(), dtype=bool)])
            ids, sizes, bits = (np.concatenate(x) for x in zip((ids, sizes, bits), (*more[:2], _folded(more[2]))))
        order = np.argsort(token, kind="stable")
        yield (ids, sizes, bits), (token[order], member[order], must[order], native[order])


def _members(token: np.ndarray) -> np.ndarray:
    """Group size at every record of a sorted token column."""
    counts = np.diff(np.append(X.run_starts(token), len(token)))
    return np.repeat(counts, counts)


def _tree(token, ids, size, must, bits, native, percent: int, limit: int | None = None):
    """(u, v) arrays of the pairs that the trees of the token groups leave
    possible.  As soon as there are more than ``limit``, pairs are only
    marked, and (None, members of possible pairs) comes back."""
    order = np.lexsort((size, token))
    token, ids, size, must, bits, native = (x[order] for x in (token, ids, size, must, bits, native))
    _, group = np.unique(token, return_inverse=True)
    out, total, seen = [], 0, np.zeros(len(ids), dtype=bool)
    for x, y in S.dual_traversal(S.build(bits, size.astype(np.int64), np.arange(len(ids)), must, group), percent):
        ok = native[x] | native[y]
        seen[x[ok]] = seen[y[ok]] = True
        total += ok.sum()
        if limit is None or total <= limit:
            out.append(np.stack([ids[x[ok]], ids[y[ok]]], axis=1))
        elif seen.all():
            break
    return (out, None) if limit is None or total <= limit else (None, ids[seen])


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    both = np.concatenate(pairs) if pairs else np.empty((0, 2), dtype=np.int64)
    return np.unique(np.sort(both[both[:, 0] != both[:, 1]], axis=1), axis=0)


def _first_round(percent: int, star: int):
    """All possible pairs of small and uncrowded groups; of crowded ones the
    members of possible pairs, each with the smallest of them."""
    def search(table):
        pairs, family = [], []
        for (ids, sizes, bits), (token, member, must, native) in _groups(table):
            def tree(part, limit=None):
                m = member[part]
                return _tree(token[part], ids[m], sizes[m], must[part], bits[m], native[part], percent, limit)

            members = _members(token)
            at = X.run_starts(token)
            small = at[(members[at] > 1) & (members[at] <= star)]
            # whole groups, so many that their bitmaps stay within a bound
            cuts = X.run_starts(np.cumsum(members[small]) // max(1, CHUNK_WORDS // bits.shape[1]))
            for first, last in zip(cuts.tolist(), np.append(cuts[1:], len(small)).tolist()):
                starts = small[first:last]
                part = np.concatenate([np.arange(a, a + m) for a, m in zip(starts.tolist(), members[starts].tolist())])
                pairs = [_distinct(pairs + tree(part)[0])]  # near copies meet at many tokens
            for a in at[members[at] > star].tolist():
                part = np.arange(a, a + members[a])
                found, crowd = tree(part, CROWDED * int(members[a]))
                if found is None:
                    family.append(np.stack([np.full(len(crowd), crowd.min()), crowd], axis=1))
                else:
                    pairs += found
        pairs, family = _distinct(pairs), _distinct(family)
        return pa.table({"family": pa.array(np.repeat([False, True], [len(pairs), len(family)])),
                         "u": pa.array(np.concatenate([pairs[:, 0], family[:, 0]])),
                         "v": pa.array(np.concatenate([pairs[:, 1], family[:, 1]]))})

    return search


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared)


def _central(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sizes and wide bitmaps of the sets, and which of them agree most with
    the majority: those are likely to link with many."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    width = min(WIDEST, max(64, 1 << int(16 * sizes.max() - 1).bit_length()))
    bits = np.zeros((len(sets), width), dtype=np.uint8)
    row = np.repeat(np.arange(len(sets)), sizes)
    bits[row, (np.concatenate(sets) & np.uint64(width - 1)).astype(np.int64)] = 1
    common = 2 * bits.sum(axis=0, dtype=np.int64) > len(sets)
    agreement = bits[:, common].sum(axis=1, dtype=np.int64) * 2 - bits.sum(axis=1, dtype=np.int64)
    return sizes, np.packbits(bits, axis=1, bitorder="little").view(np.uint64), np.argsort(-agreement, kind="stable")[:LEADERS].tolist()


def family_links(ids: np.ndarray, sets: list[np.ndarray], percent: int, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the components of all the sets given (a spanning
    forest of the link graph).  Those marked in ``joined`` are connected already."""
    sizes, bits, central = _central(sets)
    leaders = {int(ids.argmin()), *central}
    parent, links = list(range(len(sets))), []
    if joined is not None and joined.any():
        for i in np.nonzero(joined)[0].tolist():
            parent[i] = int(joined.argmax())

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def compare(i, j):
        a, b = root(i), root(j)
        if a != b and _linked(sets[i], sets[j], percent):
            parent[max(a, b)] = min(a, b)
            links.append((int(ids[i]), int(ids[j])))

    every, true = np.arange(len(sets)), np.ones(len(sets), dtype=bool)
    level = S.build(bits, sizes, every, true, every)[0]
    for lead in sorted(leaders):
        rest = every[every != lead]
        for j in rest[S._possible(level, np.full(len(rest), lead), rest, percent)].tolist():
            compare(lead, j)
    component = np.array([root(i) for i in range(len(sets))])
    order = np.lexsort((sizes, component))
    levels = S.build(bits[order], sizes[order], component[order], true, np.zeros(len(sets), dtype=np.int64))
    for x, y in S.dual_traversal(levels, percent):
        for i, j in zip(order[x].tolist(), order[y].tolist()):
            compare(i, j)
    return links


def _loose(members: DataFrame, star: DataFrame) -> DataFrame:
    """``members`` with ``loose``: not in the largest part of the family that the links ``star`` connect."""
    parts = members.join(components(star).withColumnsRenamed({"node": "id", "component": "part"}), "id", "left")
    main = (parts.where("part is not null").groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("component").agg(F.max_by("part", F.struct("n", "part")).alias("main")))
    return (parts.join(main, "component", "left")
            .withColumn("loose", ~F.col("part").eqNullSafe(F.col("main")) | F.col("part").isNull()).drop("part", "main"))


def _dealt(marked: DataFrame) -> DataFrame:
    """``(id, component, a, b, loose)``: every loose member meets every member
    of its family in a group (a, b) of a block of each."""
    far = marked.where("loose").groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("far"))
    marked = marked.join(far, "component")

    def up_to(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    every = marked.select("id", "component", up_to("far").alias("a"), F.col("block").alias("b"), "loose")
    loose = marked.where("loose").select("id", "component", F.pmod(F.xxhash64("id"), F.col("far")).alias("a"), up_to("blocks").alias("b"), "loose")
    return every.unionByName(loose).distinct()


def families(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within the families that ``edges`` connect; ``sets``: (id, tokens).
    In a family of several blocks all members are compared with a few leaders
    first; only members that these do not connect are compared block by block."""
    spark, uv = edges.sparkSession, "u bigint, v bigint"
    named = components(edges).withColumnRenamed("node", "id")  # (id, component)
    blocks = named.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    path = scratch_path(spark, "families")
    placed = named.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    placed.select("id", "component", "blocks", "block").write.parquet(path)
    placed = spark.read.schema("id bigint, component bigint, blocks bigint, block bigint").parquet(path)

    def pairs(found):
        return pa.table({"u": pa.array([x[0] for x in found], type=pa.int64()), "v": pa.array([x[1] for x in found], type=pa.int64())})

    def unpacked(table):
        return table["id"].to_numpy(), [np.frombuffer(t, dtype="<u8") for t in table["tokens"].to_pylist()]

    def link(table):
        ids, found = unpacked(table)
        return pairs(family_links(ids, found, percent, ~np.asarray(table["loose"], dtype=bool)))

    small = placed.where("blocks = 1").join(sets, "id").withColumn("loose", F.lit(True)).groupBy("component").applyInArrow(releasing(link), uv)
    if placed.where("blocks > 1").isEmpty():
        return small
    path = scratch_path(spark, "family-sets")
    placed.where("blocks > 1").join(sets, "id").select("id", "component", "blocks", "block", "tokens").write.parquet(path)
    held = spark.read.schema("id bigint, component bigint, blocks bigint, block bigint, tokens binary").parquet(path)

    def choose(table):
        return table.take(pa.array(_central(unpacked(table)[1])[2]))

    def follow(members, leaders):
        if not members.num_rows or not leaders.num_rows:
            return pairs([])
        (ids, own), (leads, theirs) = unpacked(members), unpacked(leaders)
        return pairs([(int(u), int(v)) for u, a in zip(leads, theirs) for v, b in zip(ids, own) if u != v and _linked(a, b, percent)])

    path = scratch_path(spark, "leaders")
    (held.join(held.groupBy("component").agg(F.min("block").alias("block")), ["component", "block"]).select(held.columns)
     .groupBy("component").applyInArrow(choose, held.schema)).write.parquet(path)
    leaders = spark.read.schema(held.schema).parquet(path).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    star = scratch_path(spark, "star")
    held.groupBy("component", "block").cogroup(leaders.groupBy("component", "block")).applyInArrow(releasing(follow), uv).write.parquet(star)
    star = spark.read.schema(uv).parquet(star)
    dealt = _dealt(_loose(held.drop("tokens"), star)).join(held.select("id", "tokens"), "id")
    return small.unionByName(star).unionByName(dealt.groupBy("component", "a", "b").applyInArrow(releasing(link), uv))


def sets_of(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``(id, tokens)``: the whole sets of the documents in ``ids``."""
    if ids.count() <= BROADCAST_IDS:  # the text is then filtered where it is read
        ids = F.broadcast(ids)

    def describe(batches):
        for batch in batches:
            for part in shards(batch, batch["text"], SHARD_BYTES):
                sets = token_sets(part["text"], shingle)
                yield pa.RecordBatch.from_arrays([part["id"], pa.array([s.tobytes() for s in sets], type=pa.binary())],
                                                 names=["id", "tokens"])

    return docs.join(ids, "id", "left_semi").mapInArrow(releasing_map(describe), "id bigint, tokens binary")


def verified(pairs: DataFrame, docs: DataFrame, n: int, shingle: int, percent: int) -> DataFrame:
    """The pairs whose whole sets link.  ``docs``: (id, text)."""
    spark = pairs.sparkSession
    path = scratch_path(spark, "pairs")
    pairs.distinct().write.parquet(path)
    pairs = spark.read.schema("u bigint, v bigint").parquet(path)
    sets = sets_of(docs, pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), shingle)
    uses = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("uses"))
    dealt = pairs.join(uses, "u").select(
        F.pmod(F.xxhash64("u"), F.lit(n)).alias("g"),
        F.pmod(F.xxhash64("v"), F.ceil(F.col("uses") / GROUP_PAIRS)).alias("salt"), "u", "v")
    # both sides of the pairs (the left ones without ``u``) take their sets in one join: texts are read and sets shuffled once
    sides = (dealt.select("g", "salt", F.lit(None).cast("bigint").alias("u"), F.col("u").alias("id")).distinct()
             .unionByName(dealt.select("g", "salt", "u", F.col("v").alias("id"))).join(sets, "id"))

    def check(table):
        left = table.filter(pc.is_null(table["u"]))
        right = table.filter(pc.is_valid(table["u"]))
        known: dict[int, list] = {}
        for u, a in zip(left["id"].to_pylist(), left["tokens"].to_pylist()):
            known.setdefault(u, []).append(np.frombuffer(a, dtype="<u8"))
        out = []
        for u, v, b in zip(right["u"].to_pylist(), right["id"].to_pylist(), right["tokens"].to_pylist()):
            b = np.frombuffer(b, dtype="<u8")
            if any(_linked(a, b, percent) for a in known.get(u, [])):
                out.append((u, v))
        return pa.table({"u": pa.array([x[0] for x in out], type=pa.int64()), "v": pa.array([x[1] for x in out], type=pa.int64())})

    return sides.groupBy("g", "salt").applyInArrow(releasing(check), "u bigint, v bigint")


def set_slices(sets: DataFrame) -> int:
    """Slices that hold ``SLICE_SHINGLES`` each, whatever the number of
    partitions; a family is named once per bucket that holds a token of it."""
    total = sets.where("tokens is not null").agg(F.sum("n")).first()[0] or 0
    return max(1, -(-total // SLICE_SHINGLES))


def _candidates(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, hot: int, star: int,
                slices: int | None):
    """(texts, written sets of all documents, written output of the first round)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def describe(batches):
        for batch in batches:
            first: dict[bytes, int] = {}  # the smallest id of each set in this batch
            done = []
            for part in shards(batch, batch["text"], SHARD_BYTES):
                sets, ids = token_sets(part["text"], shingle), part["id"].to_pylist()
                digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                tokens, bits = [], []
                for i, d, s in zip(ids, digest, sets):
                    new = i is not None and len(s) > 0 and i < first.get(d, 1 << 63)
                    if new:
                        first[d] = i
                    tokens.append(routing_keys(s[:prefix_size(len(s), percent) * 3 // 2 + 8]) if new else None)
                    bits.append(signature(s).tobytes() if new else None)
                done.append(pa.RecordBatch.from_arrays(
                    [part["id"], pa.array([len(s) for s in sets], type=pa.int64()), pa.array(digest, type=pa.binary()),
                     pa.array(tokens, type=pa.binary()), pa.array(bits, type=pa.binary())], names=["id", "n", "digest", "tokens", "bits"]))
            yield from done

    path = scratch_path(spark, "shingle-sets")
    texts.mapInArrow(releasing_map(describe), SETS).write.parquet(path)
    sets = spark.read.schema(SETS).parquet(path)
    n = slices or set_slices(sets)
    parts = sets.where("tokens is not null").select(
        F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int").alias("slice"), "id", "n", "digest", "tokens", "bits")
    none = np.empty(0, dtype=np.uint64)

    def first_tokens(table):
        # also asks, with count 0, for the tokens beyond the prefixes: a token is frequent in all slices or in none
        part = _Part(table, percent, none)
        keys, which = np.unique(part.tokens, return_inverse=True)
        return keys, np.bincount(which, weights=part.chosen, minlength=len(keys)).astype(np.int64)

    frequent = X.shared_keys(parts, n, first_tokens, least=hot + 1).withColumn("kind", F.lit(0))

    def keys_in(replies, kind):
        rows = [p for p, k in zip(replies["payload"].to_pylist(), replies["kind"].to_pylist()) if k == kind]
        return X.unpack(rows, X.KEY_COUNT)[1][0]

    def ask(key, table, replies):
        if not table.num_rows:
            return X.asked(0, np.empty(0, np.int32), [])
        return X.ask_counts(key[0].as_py(), *_Part(table, percent, keys_in(replies, 0)).asks(), n)

    asks = parts.groupBy("slice").cogroup(frequent.groupBy("slice")).applyInArrow(releasing(ask), X.ASKED)
    replies = frequent.unionByName(X.count_keys(asks).withColumn("kind", F.lit(1)))

    def send(key, table, replies):
        rows = []
        if table.num_rows:
            part = _Part(table, percent, keys_in(replies, 0))
            live = part.chosen & np.isin(part.tokens, keys_in(replies, 1))
            doc, token = part.doc[live], part.tokens[live]
            start = ~part.hot[live] | part.dense[doc]
            kind = size_class(part.sizes)
            for c in np.unique(kind[doc]).tolist():
                own = np.nonzero(kind[doc] == c)[0]
                buckets = X.bucket_of(token[own], n).astype(np.int64)
                # a document and its bitmap go once to each bucket, however many of its tokens do
                both, member = np.unique(buckets * len(part.ids) + doc[own], return_inverse=True)
                to, which = both // len(part.ids), both % len(part.ids)
                blob = np.frombuffer(b"".join(part.table["bits"].take(pa.array(which)).to_pylist()), dtype=f"V{8 << c}")
                _, members = X.pack(to, [part.ids[which], part.sizes[which].astype("<u4"), blob])
                member = (member - np.searchsorted(to, buckets)).astype("<u4")
                names, records = X.pack(buckets, [token[own].astype("<u8"), member, start[own].astype("u1")])
                rows += [(int(b), c, m, r) for b, m, r in zip(names, members, records)]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table({"bucket": pa.array(columns[0], type=pa.int32()), "class": pa.array(columns[1], type=pa.int32()),
                         "members": pa.array(columns[2], type=pa.binary()), "records": pa.array(columns[3], type=pa.binary())})

    records = (parts.groupBy("slice").cogroup(replies.groupBy("slice"))
               .applyInArrow(releasing(send), "bucket int, class int, members binary, records binary"))
    path = scratch_path(spark, "candidates")
    records.groupBy("bucket").applyInArrow(releasing(_first_round(percent, star)), FOUND).write.parquet(path)
    found = spark.read.schema(FOUND).parquet(path)
    return texts, sets, found


def _classes(sets: DataFrame) -> DataFrame:
    """``(id, n, class_id)`` of every document; no class for an empty set."""
    classes = sets.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("class_id"))
    return sets.select("id", "n", "digest").join(classes, "digest", "left").drop("digest")


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85,
                hot: int = HOT, slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All links: ``(u, v)``, every pair of classes whose sets link, and the
    membership ``(id, n, class_id)``.  In a group of near copies their number
    grows with the square of the group; ``ngram_join`` finds the same
    components without listing them."""
    n = X.slice_count(docs.sparkSession, slices)
    texts, sets, found = _candidates(docs, id_col, text_col, shingle, percent, hot, 1 << 62, slices)
    known = texts.where("id is not null")
    return verified(found.select("u", "v"), known, n, shingle, percent).distinct(), _classes(sets)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85,
               hot: int = HOT, star: int = STAR, slices: int | None = None) -> DataFrame:
    """``(id, n_shingles, class_id, component_id)`` per input row: the smallest
    id with an equal set, and the smallest id reachable by links."""
    spark = docs.sparkSession
    n = X.slice_count(spark, slices)
    texts, sets, found = _candidates(docs, id_col, text_col, shingle, percent, hot, star, slices)
    known = texts.where("id is not null")
    links = verified(found.where("not family").select("u", "v"), known, n, shingle, percent)
    edges = found.where("family").select("u", "v")
    crowd = edges.select(F.col("u").alias("id")).union(edges.select("v")).distinct()
    links = links.unionByName(families(edges, sets_of(known, crowd, shingle), percent))
    members = _classes(sets)
    again = (members.where("id is not null and class_id is not null").groupBy("id")  # ids with several texts
             .agg(F.min("class_id").alias("u"), F.max("class_id").alias("v")).where("u <> v").select("u", "v"))
    reach = components(links.unionByName(again))
    named = F.col("id").isNotNull()
    return (members.join(reach.withColumnRenamed("node", "class_id"), "class_id", "left")
            .select("id", F.col("n").alias("n_shingles"), F.when(named, F.coalesce("class_id", "id")).alias("class_id"),
                    F.when(named, F.coalesce("component", "class_id", "id")).alias("component_id")))
