"""Line dedup against the plain rule."""

import hashlib

import pytest
from pyspark.sql import functions as F

from chirpwave.llm import line_dedup as L

SCHEMA = "doc_id bigint, text string, keep string, row int, lines string, n_lines int"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = {i: i + 32 for i in range(65, 91)}
COMMON = "All rights reserved by the example company."


def plain(rows, chars=20, docs=3):
    def key(line):
        return line.strip(BLANKS).translate(UPPER)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= chars:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (i is not None and i < gone.get(key(x), i))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, "k", 1, "l", 5) for i, t in rows], SCHEMA).repartition(parts)
    out = L.kept_lines(df, L.line_dedup(df))
    return sorted((tuple(r) for r in out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()), key=str)


def test_equals_plain_rule(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, COMMON), (5, f"x\n{COMMON}\ny\n{COMMON}"), (6, f"  {COMMON.upper()}\r\nshort"),
            (7, f"\t{COMMON}\x0b\n"), (8, COMMON), (8, f"other\n{COMMON}"), (8, COMMON),  # repeated ids: one document
            (None, COMMON), (None, COMMON), (None, None),
            (9, "only nineteen chars"), (10, "only nineteen chars"), (11, "only nineteen chars"),
            (12, "ÄÖÜ twenty code points"), (13, "äöü twenty code points"), (14, "ÄÖÜ TWENTY CODE POINTS"), (15, "ÄÖÜ twenty code points"),
            (16, "日本語" * 7), (17, "日本語" * 7), (18, " " + "日本語" * 7), (-5, COMMON), (2**63 - 1, "z" * 30), (-2**63, "z" * 30), (0, "z" * 30),
            (20, "two documents only, so it stays"), (21, "two documents only, so it stays"),
            (22, " " + COMMON), (23, COMMON + " ")]
    assert run(spark, rows) == plain(rows)


def test_long_documents_and_a_line_that_most_documents_hold(spark):
    long = "\n".join(f"line number {i % 900} of a long document" for i in range(20_000))
    rows = [(1, long), (2, long + "\nend"), (3, "start\n" + long), (4, "w" * 300_000 + "\n" + COMMON)]
    rows += [(100 + i, f"{COMMON}\nown line of document number {i}\n{COMMON}") for i in range(300)]
    assert run(spark, rows) == plain(rows)


def test_more_frequent_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT", 2)
    rows = [(i, "\n".join(f"this line is shared by many documents {j}" for j in range(9) if i % (j + 1) == 0)) for i in range(60)]
    assert run(spark, rows) == plain(rows)


def test_nothing(spark):
    assert run(spark, []) == [] and run(spark, [(None, None)]) == plain([(None, None)])


def test_bitmaps_hold_only_words_with_losses(spark):
    rows = [(i, "\n".join([COMMON] + [f"own line {i} {j} of this document" for j in range(200)] + [COMMON])) for i in range(4)]
    df = spark.createDataFrame([(i, t, "k", 1, "l", 5) for i, t in rows], SCHEMA)
    maps = {r["id"]: r for r in L.line_dedup(df).collect()}
    assert set(maps) == {0, 1, 2}
    assert [(w["word"], ~w["bits"]) for w in maps[0]["keep"]] == [(0, 1), (3, 1 << (201 % 64))]
    assert maps[0]["n_dropped"] == 2


def test_plan_is_native_and_range_partitioned(spark):
    df = spark.createDataFrame([(1, COMMON, "k", 1, "l", 5)], SCHEMA)
    lines = L.hashed_lines(df, "doc_id", "text", 20)
    whole = L.kept_lines(df, L.line_dedup(df))._jdf.queryExecution().toString()
    counted = L.frequent_keys(lines, 3)._jdf.queryExecution().toString()
    for python in ("PythonUDF", "InPandas", "InArrow", "PythonRDD"):
        assert python not in whole + counted
    physical = counted[counted.index("== Physical Plan =="):]
    assert "rangepartitioning" in physical
    # the window streams the range-partitioned rows as they are
    window = physical[physical.index("Window [row_number()"):].splitlines()
    assert "Exchange rangepartitioning" in "\n".join(window[1:4])


@pytest.mark.parametrize("docs", [1, 2, 5])
def test_other_limits(spark, docs):
    rows = [(i, "\n".join(f"tag {j}" for j in range(i))) for i in range(1, 8)]
    df = spark.createDataFrame([(i, t, "k", 1, "l", 5) for i, t in rows], SCHEMA)
    out = L.kept_lines(df, L.line_dedup(df, least_chars=3, least_docs=docs))
    got = out.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 3, docs)
