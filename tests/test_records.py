import json

from pyspark.sql import functions as F

from chirpwave.functions.records import enrich_json, parse_records, rejects, valid


def _parse(spark, values, fields):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    return parse_records(df, fields)


def test_int_field(spark):
    vals = ['{"t": 12}', '{"t": "12"}', '{"t": 12.9}', '{"t": -3.7}', '{}', '{"t": "abc"}', '{"t": null}']
    out = {r.key: (r.t, r._reject) for r in _parse(spark, vals, {"t": "int"}).collect()}
    assert out["0"] == (12, None)
    assert out["1"] == (12, None)
    assert out["2"] == (12, None)
    assert out["3"] == (-3, None)
    assert out["4"] == (None, "missing:t")
    assert out["5"][1] == "type:t"
    assert out["6"][1] == "missing:t"


def test_reject_reasons(spark):
    vals = ['{"text": "hi"}', '{"text": 5}', '{"tex', '[1, 2]', None, '{"other": 1}']
    p = _parse(spark, vals, {"text": "string"})
    assert [r.text for r in valid(p).collect()] == ["hi"]
    got = {r.key: r.reason for r in rejects(p).collect()}
    assert got == {"1": "type:text", "2": "malformed", "3": "malformed", "4": "malformed", "5": "missing:text"}


def test_enrich_keeps_fields(spark):
    src = '{"text":"hi","n":1.5,"a":[1,2],"o":{"k":null},"z":null,"sentiment":9}'
    df = spark.createDataFrame([(src,), ("not json",)], "v string")
    rows = df.select(enrich_json("v", "sentiment", F.lit(2)).alias("e")).collect()
    got = json.loads(rows[0].e)
    assert got == {"text": "hi", "n": 1.5, "a": [1, 2], "o": {"k": None}, "z": None, "sentiment": 2}
    assert rows[1].e is None


def test_enrich_splices_without_reencoding(spark):
    cases = ['{"b":"x\\u00e9","a":[1,2]}', '{}', '{ }\n', '{"t":"s"}  ', '{"sentiment":1,"z":2}', "[1]", "nope"]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    got = [r.e for r in df.select(enrich_json("v", "sentiment", F.lit(-2)).alias("e")).collect()]
    # new field: original text kept byte for byte, field appended
    assert got[0] == '{"b":"x\\u00e9","a":[1,2],"sentiment":-2}'
    assert got[1] == '{"sentiment":-2}'
    assert json.loads(got[2]) == {"sentiment": -2}
    assert got[3] == '{"t":"s","sentiment":-2}'
    # existing field: replaced, others kept
    assert json.loads(got[4]) == {"sentiment": -2, "z": 2}
    assert got[5] is None and got[6] is None
    nul = df.limit(1).select(enrich_json("v", "s", F.lit(None).cast("int")).alias("e")).first().e
    assert json.loads(nul) == {"b": "xé", "a": [1, 2], "s": None}


def test_field_names_with_dots_and_spaces(spark):
    vals = ['{"a.b": "x", "c d": 7}', '{"a": {"b": "nested"}, "c d": 1}']
    p = _parse(spark, vals, {"a.b": "string", "c d": "int"}).collect()
    assert (p[0]["a.b"], p[0]["c d"], p[0]._reject) == ("x", 7, None)
    assert p[1]._reject == "missing:a.b"


def test_cheap_post_rejects_equal_scored_rejects(spark):
    """post_rejects (input checks only) finds the same rows and reasons as
    scoring every post."""
    from chirpwave.plans import pipelines as P
    from chirpwave.plans.queries import corrupted_post_records
    from conftest import SF0001
    parsed = P.parse_posts(corrupted_post_records(spark, SF0001))
    cheap = {(r.key, r.reason) for r in P.post_rejects(parsed).select("key", "reason").collect()}
    full = {(r.key, r.reason) for r in rejects(P.score_posts(parsed)).select("key", "reason").collect()}
    assert cheap == full and len(cheap) > 0


def test_text_after_the_object_is_trailing(spark):
    from chirpwave.plans import pipelines as P
    good = ['{"text":"hi"}', ' \n{"text":"hi"}\t\r\n', '{"text":"a} b"}', '{ "text" : "hi" }']
    trailing = ['{"text":"hi"} trailing', '{"text":"hi"}{"text":"b"}', '{"text":"hi"}\x00', '{"text":"hi"},{"a":1}',
                '{"text":"hi"}],[{}', '{"text":"hi"}]', '{"text":"hi"} 1']
    bad = ["", " ", "null", "[1]", '"x"', '{"text":"hi"', '}{']
    df = spark.createDataFrame([(v,) for v in good + trailing + bad], "value string")
    got = {r.value: r._reject for r in parse_records(df, {"text": "string"}).collect()}
    assert all(got[v] is None for v in good)
    assert all(got[v] == "trailing" for v in trailing)
    assert all(got[v] == "malformed" for v in bad)
    for r in P.classify_posts(df).collect():
        if r._reject is None:
            assert json.loads(r.value)["sentiment"] == 0
        else:
            assert r.value in trailing + bad  # a rejected record leaves as it came
    assert df.where(F.col("value").isin(*trailing)).select(enrich_json("value", "s", F.lit(1)).alias("e")).where("e is not null").count() == 0


def test_a_string_the_parser_refuses_has_its_own_reason(spark):
    df = spark.range(1).select(F.concat(F.lit('{"text":"'), F.repeat(F.lit("x"), 20_100_000), F.lit('"}')).alias("value"))
    r = parse_records(df, {"text": "string"}).select("_reject", F.length("value").alias("n")).first()
    assert r._reject == "too_long" and r.n == 20_100_011
    fits = spark.range(1).select(F.concat(F.lit('{"text":"'), F.repeat(F.lit("x"), 19_900_000), F.lit('"}')).alias("value"))
    assert parse_records(fits, {"text": "string"}).select("_reject").first()[0] is None


def test_ids_of_any_kind_are_carried_and_none_is_needed(spark):
    from chirpwave.plans import pipelines as P
    vals = ['{"id":"a","text":"t","place_full_name":"Texas"}', '{"id":7,"text":"t","place_full_name":"Texas"}',
            '{"text":"t","place_full_name":"Texas"}', '{"id":null,"text":"t","place_full_name":"Texas"}']
    rows = P.parse_posts(spark.createDataFrame([(v,) for v in vals], "value string")).collect()
    assert [(r.id, r._reject) for r in rows] == [("a", None), ("7", None), (None, None), (None, None)]


def test_no_record_can_forge_the_seal(spark, monkeypatch):
    from chirpwave.functions import records as R
    used = []

    class Drawn:
        def __init__(self):
            self.hex = f"{len(used):032x}"
            used.append(self.hex)
    monkeypatch.setattr(R.uuid, "uuid4", Drawn)
    # a record that holds another query's seal, and one that holds a seal without ending where it should
    rows = [('{"text":"a"},"' + "f" * 32 + '"',), ('{"text":"b"},"x"],["',), ('{"text":"c"}',)]
    df = spark.createDataFrame(rows, "value string")
    got = {r["value"]: r["_reject"] for r in parse_records(df, {"text": "string"}, keep=()).collect()}
    assert [got[r[0]] for r in rows] == ["trailing", "trailing", None]
    assert len(used) == 1  # one seal a query
    parse_records(df, {"text": "string"}, keep=())
    assert len(set(used)) == 2
