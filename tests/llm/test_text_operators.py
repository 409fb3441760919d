"""Row rules and edge cases of operators 1, 2, 8 and 9."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chirpwave.llm import signature_tree as S
from chirpwave.llm.components import components
from chirpwave.llm.decontaminate import decontaminate
from chirpwave.llm.fm_index import FMIndex
from chirpwave.llm.merge_dropout import MergeVocabulary, agenda_encode, decode, encode_texts, encode_words, piece_decode, piece_encode
from chirpwave.llm.ngram_join import ngram_join, ngram_links
from chirpwave.llm.substring_dedup import substring_dedup

from . import brute
from .conftest import ODD

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def _key(row):
    return tuple(str(x) for x in row)


def test_substring_dedup_odd_rows(odd):
    out = substring_dedup(odd)
    assert [f.name for f in out.schema["doc"].dataType] == odd.columns
    got = [tuple(r) for r in out.select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got, key=_key) == sorted(brute.dedup(ODD), key=_key)


def test_substring_dedup_empty(nothing):
    assert substring_dedup(nothing).collect() == []


def test_substring_dedup_random_against_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(6)]
    rows = [(i, " ".join(rng.choice(pool)[rng.randrange(30):] for _ in range(rng.randrange(1, 5)))) for i in range(60)]
    out = substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = [tuple(r) for r in out.select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got) == sorted(brute.dedup(rows))


def test_factors_point_at_earlier_equal_text(odd):
    texts = {i: brute.words(t) for i, t in ODD}
    seen = 0
    for r in substring_dedup(odd).select("doc.doc_id", "n_removed", "factors").collect():
        for f in r["factors"]:
            seen += 1
            assert f["source"] < r["doc_id"] and f["length"] >= 13
            own = texts[r["doc_id"]][f["start"]:f["start"] + f["length"]]
            assert own == texts[f["source"]][f["source_start"]:f["source_start"] + f["length"]]
    assert seen


def test_factor_boundaries_are_checked(spark):
    # the window across the seam of two sources occurs in a third one only
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[-6:] + b[:7])), (4, " ".join(a + b))]
    out = substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc.doc_id = 4").first()
    assert out["n_removed"] == 40 and {f["source"] for f in out["factors"]} == {1, 2, 3}


def test_a_factor_grows_past_a_window_held_earlier(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(2, " ".join(["x"] + words[50:63])), (7, " ".join(["a", "b"] + words)), (9, " ".join(["c"] + words + ["d"]))]
    out = substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc.doc_id = 9").first()
    assert [tuple(f) for f in out["factors"]] == [(1, 100, 7, 2)] and out["n_removed"] == 100


def test_factors_equal_a_plain_greedy_parse(spark):
    rng = random.Random(15)
    pool = [[rng.choice("abcdefghij") for _ in range(60)] for _ in range(5)]
    rows = []
    for i in range(50):
        words = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(pool)[rng.randrange(30):][:rng.randrange(5, 60)]
            words += part + [f"u{i}"] * rng.randrange(2)
        rows.append((i, " ".join(words)))
    earliest: dict[tuple, tuple] = {}
    want = {}
    for i, text in rows:  # by ascending id
        words = text.split()
        holder = [earliest.get(tuple(words[p:p + 13])) for p in range(len(words) - 12)]
        for p in range(len(words) - 12):
            earliest.setdefault(tuple(words[p:p + 13]), (i, p))
        factors, p = [], 0

        def grow(p):
            source, at = holder[p]
            end, q = p + 13, p + 1
            while q <= end and q < len(holder):
                if holder[q] == (source, at + q - p):
                    end = q + 13
                q += 1
            factors.append((p, end - p, source, at))
            return end

        while p < len(holder):
            if holder[p] is None:
                p += 1
                continue
            end = grow(p)
            p = end - 12  # the first window that reaches across
            if end < len(holder) and holder[end]:
                while p < end:  # seam
                    p = grow(p) - 12 if holder[p] else p + 1
                p = end
        want[i] = factors
    out = substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), slices=3)
    got = {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in out.select("doc.doc_id", "factors").collect()}
    assert got == want and sum(map(len, want.values())) > 50


def test_ngram_join_odd_rows(odd):
    got = {(r["id"], r["n_shingles"], r["component_id"]) for r in ngram_join(odd).collect()}
    reach = brute.near(ODD)
    assert got == {(i, len(brute.shingles(t)), reach.get(i)) for i, t in ODD}


def test_ngram_join_empty(nothing):
    assert ngram_join(nothing).collect() == []


@pytest.mark.parametrize("hot", [1000, 2])
def test_ngram_join_against_all_pairs(spark, hot):
    rng = random.Random(hot)
    rows = []
    for g in range(8):  # near copies, chains, a passage that all share
        base = [f"t{g}_{i}" for i in range(60)]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"r{rng.random()}"
            rows.append((len(rows), " ".join(w) + (" " + " ".join(f"common{i}" for i in range(12)) if g % 2 else "")))
    rng.shuffle(rows)
    got = {r["id"]: r["component_id"] for r in ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=hot).collect()}
    assert got == brute.near(rows)


def test_one_token_order_in_all_slices(spark):
    # texts of two passages that others share, and copies without the last word; a token that is in the prefix of
    # one slice's texts only lies behind the prefix of another's
    rng = random.Random(4)
    passages = [" ".join(f"p4_{k}_{i}" for i in range(6)) for k in range(14)]
    rows = []
    for _ in range(40):
        w = " ".join(rng.sample(passages, 2) + [f"own{rng.random()}"] * rng.randrange(0, 2)).split()
        rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(w[:-1]))]
    first = {}
    for i, text in rows:
        first.setdefault(frozenset(brute.shingles(text)), i)
    want = {(i, j) for a, i in first.items() for b, j in first.items() if i < j and 100 * len(a & b) >= 85 * len(a | b)}
    links, _ = ngram_links(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=2, slices=16)
    assert {tuple(r) for r in links.collect()} == want


def test_signature_tree_drops_no_possible_pair():
    rng = np.random.default_rng(1)
    sets, group = [], []
    for g in range(3):
        base = rng.integers(0, 2**63, 120).astype(np.uint64)
        for _ in range(40):
            drop = rng.integers(0, 12)
            sets.append(np.unique(np.concatenate([base[drop:], rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)])))
            group.append(g)
    bits = np.zeros((len(sets), 4), dtype=np.uint64)
    for i, s in enumerate(sets):
        for h in s:
            bits[i, int(h & np.uint64(255)) >> 6] |= np.uint64(1) << (h & np.uint64(63))
    sizes = np.array([len(s) for s in sets])
    levels = S.build(bits, sizes, np.arange(len(sets)), np.ones(len(sets), bool), np.array(group))
    got = {(i, j) for x, y in S.dual_traversal(levels, 85) for i, j in zip(x.tolist(), y.tolist())}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            x = len(np.intersect1d(sets[i], sets[j]))
            if group[i] == group[j] and 100 * x >= 85 * (sizes[i] + sizes[j] - x):
                assert (i, j) in got
    assert all(group[i] == group[j] and i < j for i, j in got)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7)], "u bigint, v bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 400: 400, 500: 400}
    assert components(edges.limit(0)).collect() == []


BENCH = [(1, "Theta, iota! kappa lambda mu nu xi omicron pi rho sigma tau and more words of an item"), (2, "short TEXT"), (2, "short text"),
         (3, None), (4, "..."), (None, "beta gamma delta"), (10, "mu nu xi omicron"), (11, "日本語")]


def test_decontamination_odd_rows(spark, odd):
    items = spark.createDataFrame(BENCH, "item_id bigint, text string")
    for chunk in (1 << 20, 40):  # one chunk, and several
        got = [tuple(r) for r in decontaminate(odd, items, chunk_bytes=chunk)
               .select("doc.doc_id", "n_words", "n_hit", "items", "contaminated").collect()]
        want = []
        for i, t in ODD:
            n, hit, ids = brute.hits(t, BENCH)
            want.append((i, n, hit, ids, hit > 0 and 20 * hit >= n))
        assert sorted(got, key=_key) == sorted(want, key=_key)


def test_decontamination_empty(spark, odd, nothing):
    items = spark.createDataFrame(BENCH, "item_id bigint, text string")
    assert decontaminate(nothing, items).collect() == []
    assert {r["n_hit"] for r in decontaminate(odd, items.limit(0)).collect()} == {0}


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 5, 400)
    index = FMIndex(text, sample=5)
    patterns = np.zeros((60, 6), dtype=np.int64)
    lengths = rng.integers(1, 7, 60)
    for p, n in zip(patterns, lengths):
        p[6 - n:] = rng.integers(1, 6, n)  # 5 is not in the text
    which, at = index.locate(*index.search(patterns, lengths))
    got = sorted(zip(which.tolist(), at.tolist()))
    want = [(k, i) for k, (p, n) in enumerate(zip(patterns, lengths)) for i in range(len(text) - n + 1)
            if (text[i:i + n] == p[6 - n:]).all()]
    assert got == sorted(want)


@pytest.fixture(scope="module")
def vocabulary():
    return MergeVocabulary.load(PIECES)


def test_without_dropout_equals_the_library(vocabulary):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for _, t in ODD if t and "▁" not in t and "  " not in t and t[0] != " "]  # no two markers in a row
    ids, offsets = encode_texts(pa.array(texts), np.zeros(len(texts), dtype=np.int64), vocabulary, 0.0, 0)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == model.encode(texts)


def test_array_agenda_equals_heap_agenda(vocabulary):
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshré日") for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    keys = np.arange(len(words), dtype=np.uint64) * np.uint64(977)
    flat, offsets = encode_words(words, keys, vocabulary, 0.3)
    symbols, at = vocabulary.symbols(words)
    for i in range(len(words)):
        ids = np.array(agenda_encode(symbols[at[i]:at[i + 1]].tolist(), int(keys[i]), vocabulary, 0.3), dtype=np.int64)
        assert vocabulary.byte_fallback(ids, np.array([0, len(ids)]))[0].tolist() == flat[offsets[i]:offsets[i + 1]].tolist()


def test_dropout_varies_by_seed_and_decodes(spark, odd, vocabulary):
    runs = [piece_encode(odd, PIECES, seed=s).select("doc.doc_id", "doc.text", "tokens", "n_tokens", "lossless") for s in (1, 1, 2)]
    rows = [{(r["doc_id"], r["text"]): r for r in run.collect()} for run in runs]
    assert rows[0] == rows[1] and rows[0] != rows[2]
    assert all(r["lossless"] for r in rows[0].values())
    assert rows[0][3, None]["tokens"] is None and rows[0][4, ""]["tokens"] == []
    back = piece_decode(runs[0].withColumn("text", F.lit("other")), PIECES).select("row.doc_id", "text").collect()
    assert sorted(map(tuple, back), key=_key) == sorted(ODD, key=_key)


def test_every_occurrence_draws_anew(spark, vocabulary):
    text, n = "segmentation", 2000
    rows = [(1, " ".join([text] * n)), (2, " ".join([text] * n))]
    out = {r["doc"]["doc_id"]: r["tokens"] for r in piece_encode(spark.createDataFrame(rows, "doc_id bigint, text string"), PIECES).collect()}
    assert out[1] != out[2]
    # as many forms as separate agendas give, each about as often
    symbols = vocabulary.symbols([text])[0].tolist()
    keys = np.random.default_rng(5).integers(0, 2**63, n).astype(np.uint64)
    want = [tuple(agenda_encode(symbols, int(k), vocabulary, 0.1)) for k in keys]
    flat, ends = encode_words([text], keys, vocabulary, 0.1, np.zeros(n, dtype=np.int64))
    assert [tuple(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])] == want
    for tokens in out.values():
        breaks = [i for i, x in enumerate(tokens) if vocabulary.bytes[x].startswith(b" ")] + [len(tokens)]
        got = [tuple(tokens[a:b]) for a, b in zip(breaks[:-1], breaks[1:])]
        assert len(got) == n and len(set(got)) > 8
        whole = max(set(want), key=want.count)
        assert abs(got.count(whole) - want.count(whole)) < 0.1 * n


def test_encoding_an_empty_table(nothing):
    assert piece_encode(nothing, PIECES).collect() == []


def test_decode_of_nothing(vocabulary):
    assert decode(np.empty(0, np.int64), np.zeros(3, np.int64), pa.array(vocabulary.bytes, type=pa.large_binary())) == [b"", b""]


def test_all_links_and_membership(spark):
    rng = random.Random(11)
    rows = []
    for g in range(4):
        base = [f"t{g}_{i}" for i in range(50)]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"r{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rows += [(100, rows[0][1]), (101, ""), (102, None)]
    links, members = ngram_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sets = {i: brute.shingles(t) for i, t in rows}
    classes = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets if sets[i]}
    assert {r["id"]: r["class_id"] for r in members.collect()} == {i: classes.get(i) for i in sets}
    reps = sorted(set(classes.values()))
    want = {(a, b) for a in reps for b in reps if a < b
            and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in links.collect()} == want


def test_family_links_span_the_components():
    from chirpwave.llm.ngram_join import family_links
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = [base]
    for _ in range(60):  # each loses and gains a few tokens of the base or of another copy
        old = sets[rng.integers(0, len(sets))]
        keep = rng.random(len(old)) > 0.05
        sets.append(np.unique(np.concatenate([old[keep], rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)])))
    sets += [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 50, 200)]
    parent = list(range(len(sets)))

    def find(parent, x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            x = len(np.intersect1d(sets[i], sets[j]))
            if 100 * x >= 85 * (len(sets[i]) + len(sets[j]) - x):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    got = list(range(len(sets)))
    for u, v in family_links(np.arange(len(sets)), sets, 85):
        x = len(np.intersect1d(sets[u], sets[v]))
        assert 100 * x >= 85 * (len(sets[u]) + len(sets[v]) - x)
        a, b = find(got, u), find(got, v)
        assert a != b  # no link more than needed
        got[max(a, b)] = min(a, b)
    assert [find(got, i) for i in range(len(sets))] == [find(parent, i) for i in range(len(sets))]


def test_crowded_groups_become_families(spark):
    rng = random.Random(21)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(90):  # most copies link with the base only
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"r{i}_{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(f"u{i}_{k}" for k in range(30))) for i in range(20)]
    got = {r["id"]: r["component_id"] for r in ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), star=8).collect()}
    assert got == brute.near(rows)


def test_large_families_are_led_before_blocks_are_paired(spark, monkeypatch):
    from chirpwave.llm import ngram_join as N
    monkeypatch.setattr(N, "BLOCK_SETS", 16)
    dealt = []
    monkeypatch.setattr(N, "_dealt", lambda marked, deal=N._dealt: dealt.append(deal(marked)) or dealt[-1])
    rng = random.Random(31)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"r{i}_{rng.random()}"
        if i % 40 == 0:  # not linked with the leaders, but with the next one
            w[100:] = [f"x{i}_{k}" for k in range(20)]
            rows.append((1000 + i, " ".join(w[:100] + [f"y{i}_{k}" for k in range(8)] + w[108:])))
        rows.append((i, " ".join(w)))
    got = {r["id"]: r["component_id"] for r in N.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), star=8).collect()}
    assert got == brute.near(rows)
    assert len(dealt) == 1 and 0 < dealt[0].count() < 6 * len(rows)  # in all pairs of blocks: 13 times each


def test_slices_follow_the_text_not_the_partitions(spark, monkeypatch):
    from chirpwave.llm import exchange as X
    monkeypatch.setattr(X, "SLICE_BYTES", 10_000)
    docs = spark.createDataFrame([(i, f"{i} " * 500) for i in range(100)] + [(None, None)], "doc_id bigint, text string")
    size = sum(len(r["text"]) for r in docs.collect() if r["text"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("2", "4"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert X.byte_slices(docs, "text") == -(-size // 10_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert X.byte_slices(docs.limit(0), "text") == 1 and X.byte_slices(docs, "text", 3) == 3


def test_set_slices_follow_the_shingles_not_the_partitions(spark, monkeypatch):
    from chirpwave.llm import ngram_join as J
    monkeypatch.setattr(J, "SLICE_SHINGLES", 500)
    sets = spark.createDataFrame([(i, 100, b"d", b"t" if i < 12 else None, b"") for i in range(20)], J.SETS)
    assert J.set_slices(sets) == 3  # of the 12 sets that take part
    assert J.set_slices(sets.limit(0)) == 1
    rng = random.Random(8)
    base = [[f"{b}_{i}" for i in range(60)] for b in range(4)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"r{rng.random()}" for w in rng.choice(base))) for i in range(80)]
    got = {r["id"]: r["component_id"] for r in ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), star=8).collect()}
    assert got == brute.near(rows)


def test_pairs_take_their_sets_in_one_join(spark):
    """Both sides of the pairs: texts are read, and sets shuffled, once; an id with several texts links by any."""
    from chirpwave.llm.ngram_join import verified
    words = [f"w{i}" for i in range(60)]
    texts = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words[30:])), (3, " ".join([*words, "x"])), (4, "a b c d e")]
    docs = spark.createDataFrame(texts, "id bigint, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 4), (1, 2)], "u bigint, v bigint")
    links = verified(pairs, docs, 4, 4, 85)
    assert links._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, links.distinct().collect())) == [(1, 2), (1, 3), (2, 3)]
