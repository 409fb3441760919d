"""JSON records in and out.

Input records are JSON text (a Kafka ``value``).  Each record is parsed
once into a VARIANT; known fields are then pulled out by path.  A string
field must hold a JSON string (``{"text": 5}`` is rejected, not read as
``"5"``); an int field accepts a number (truncated) or a numeric string.
Records that fail are not dropped and do not fail the job: they carry a
reason and go to the reject output:

* ``malformed``: no JSON object (cut off, another kind of value, empty);
* ``trailing``: a JSON value followed by more text (a second object, words,
  a NUL); blanks around the object are allowed;
* ``too_long``: not readable, and longer than ``PARSER_CHARS`` characters.
  Spark's JSON parser refuses strings over 20,000,000 characters and no
  setting lifts that, so such a record keeps its whole ``value`` in the
  reject output under its own reason;
* ``missing:<field>`` and ``type:<field>`` of a required field.

Output records are ``to_json(struct(...))``.  Adding a field to an
arbitrary object (``add_json_field``) splices it into the original text,
or goes through ``MAP<STRING,VARIANT>`` when an existing field must be
replaced; every other field is kept either way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import with_computed

# Fixed value: the JSON whitespace characters.
JSON_BLANKS = " \t\n\r"

# Fixed value: Spark's JSON parser refuses longer strings.
PARSER_CHARS = 20_000_000

# The fields each analysis needs, and their kinds.  The id is
# carried along where a post has one, whatever its kind; no analysis needs it.
TEXT_FIELDS = {"text": "string"}
POST_FIELDS = {"text": "string", "place_full_name": "string"}
POST_EXTRAS = ("id",)
WEATHER_FIELDS = {"state": "string", "temperature": "int"}


def json_path(name: str) -> str:
    """Variant path of a top-level field; bracket form, so names with dots
    or spaces work."""
    return "$['" + name.replace("'", "\\'") + "']"


def json_int(text: Column) -> Column:
    """An int from the text of a JSON scalar: ``12`` -> 12, ``"12"`` -> 12,
    ``12.9`` -> 12 (truncated toward zero); anything else -> NULL."""
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def _whole_variant(value: Column, seal: str) -> Column:
    """The JSON value that makes up the whole text, in element 0 of an array.

    The parser stops after the first value and ignores what follows, so the
    text is parsed between ``[`` and a seal: only if the seal comes out as
    element 1 did the value end where the text ends."""
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit(f',"{seal}"]')))


def parse_records(records: DataFrame, fields: dict[str, str], value_col: str = "value",
                  keep: tuple[str, ...] = ("key", "timestamp"), keep_variant: bool = False,
                  extras: tuple[str, ...] = ()) -> DataFrame:
    """Parse the JSON ``value`` of each record into typed columns.

    ``fields`` maps required field name -> ``"string"`` or ``"int"``;
    ``extras`` are optional fields, read as text from any scalar and NULL
    when absent.  Adds ``_reject``: NULL for a good record, else the first
    reason found (see the module text).  Split with ``valid()`` /
    ``rejects()``.  Row-local: no shuffle, streaming-safe.
    ``keep_variant=True`` also returns the parsed record as ``_v`` so a
    later step (``add_json_field``) does not parse it again.

    The work is staged -- parse once, pull each field's sub-value once,
    then type and check it.  Spark does not merge a projection whose
    expensive result is used more than once, and the typed columns and
    reason leave through a generator fence (``with_computed``), so a later
    filter on ``_reject`` cannot push the parse into a second evaluation:
    every record is parsed exactly once (rejected ones once more, for the
    reason).
    """
    for kind in fields.values():
        if kind not in ("string", "int"):
            raise ValueError(f"unsupported field kind {kind!r}")
    cols = [k for k in keep if k in records.columns]
    value = F.col(value_col)
    seal = uuid.uuid4().hex  # drawn per query: no record can hold it
    staged = records.select(*cols, value, _whole_variant(value, seal).alias("_w"))
    sealed = ((F.try_variant_get("_w", "$[1]", "string") == seal)
              & F.try_variant_get("_w", "$[2]", "variant").isNull() & F.ltrim(value, F.lit(JSON_BLANKS)).startswith("{"))
    staged = staged.select(*cols, value_col, F.coalesce(sealed, F.lit(False)).alias("_whole"),
                           F.try_variant_get("_w", "$[0]", "variant").alias("_v"))
    staged = staged.select(*cols, value_col, "_whole", "_v", *[
        F.try_variant_get("_v", json_path(name), "variant").alias(f"_f{i}") for i, name in enumerate([*fields, *extras])])

    plain = F.try_parse_json(value)  # evaluated for unreadable records only
    unread = (F.when(plain.isNotNull() & F.ltrim(value, F.lit(JSON_BLANKS)).startswith("{"), F.lit("trailing"))
              .when(F.length(value) > PARSER_CHARS, F.lit("too_long")).otherwise(F.lit("malformed")))
    reason = F.when(~F.col("_whole"), unread)
    typed: dict[str, Column] = {}
    for i, (name, kind) in enumerate(fields.items()):
        sub = F.col(f"_f{i}")
        jtype = F.schema_of_variant(sub)
        text = F.try_variant_get(sub, "$", "string")
        reason = reason.when(sub.isNull() | (jtype == "VOID"), F.lit(f"missing:{name}"))
        if kind == "string":
            reason = reason.when(jtype != "STRING", F.lit(f"type:{name}"))
            typed[name] = text
        else:
            as_int = json_int(text)
            reason = reason.when(as_int.isNull(), F.lit(f"type:{name}"))
            typed[name] = as_int
    for i, name in enumerate(extras, len(fields)):
        typed[name] = F.try_variant_get(F.col(f"_f{i}"), "$", "string")
    # fenced, so a later filter on ``_reject`` does not re-run the parse
    fenced = with_computed(staged, **typed, _reject=reason)
    extra = ["_v"] if keep_variant else []
    return fenced.select(*cols, value_col, *extra, *[F.col(f"`{n}`") for n in typed], "_reject")


def valid(parsed: DataFrame) -> DataFrame:
    """Rows that parsed cleanly, without the bookkeeping columns."""
    return parsed.where(F.col("_reject").isNull()).drop("_reject")


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows that did not parse, with the reason in ``reason``."""
    return parsed.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reason")


def enrich_variant(v: Column | str, name: str, col: Column) -> Column:
    """The JSON text of parsed object ``v`` with field ``name`` set to
    ``col``; every other field, nested or null, is kept (key order is
    not).  NULL when ``v`` is not an object."""
    v = F.col(v) if isinstance(v, str) else v
    obj = v.try_cast("map<string,variant>")
    kept = F.map_filter(obj, lambda k, _: k != F.lit(name))
    added = F.create_map(F.lit(name), col.cast("variant"))
    return F.when(obj.isNull(), F.lit(None).cast("string")).otherwise(F.to_json(F.map_concat(kept, added)))


def add_json_field(value: Column | str, v: Column | str, name: str, col: Column) -> Column:
    """JSON object text ``value`` (parsed as ``v``) with field ``name`` set
    to ``col``, every other field kept.

    ``value`` must be exactly one JSON value (``parse_records`` rejects
    anything else), so its last non-blank character closes the object.
    When the object does not have the field yet, the encoded field is
    spliced in before that brace: the record is kept byte for byte
    and its (possibly long) other fields are not re-encoded -- about 3x
    cheaper than a round trip through a map.  Otherwise (the field must be
    replaced) it falls back to ``enrich_variant``.
    """
    value = F.col(value) if isinstance(value, str) else value
    v = F.col(v) if isinstance(v, str) else v
    absent = F.try_variant_get(v, json_path(name), "variant").isNull()
    encoded = F.to_json(F.struct(col.alias(name)), {"ignoreNullFields": "false"})   # {"name":...}
    field = encoded.substr(F.lit(2), F.length(encoded) - 2)                         # "name":...
    body = F.rtrim(value, F.lit(JSON_BLANKS))                                        # ends with '}'
    opening = F.rtrim(body.substr(F.lit(1), F.length(body) - 1), F.lit(JSON_BLANKS))
    # an object without fields ends with its own opening brace
    spliced = F.concat(opening, F.when(opening.endswith("{"), F.lit("")).otherwise(F.lit(",")), field, F.lit("}"))
    return F.when(absent & F.ltrim(value, F.lit(JSON_BLANKS)).startswith("{"), spliced).otherwise(enrich_variant(v, name, col))


def enrich_json(value: Column | str, name: str, col: Column) -> Column:
    """``add_json_field`` for JSON text: parses ``value`` first; NULL when
    the text is not exactly one JSON object."""
    value = F.col(value) if isinstance(value, str) else value
    seal = uuid.uuid4().hex
    whole = _whole_variant(value, seal)
    sealed = ((F.try_variant_get(whole, "$[1]", "string") == seal)
              & F.try_variant_get(whole, "$[2]", "variant").isNull())
    return F.when(sealed, add_json_field(value, F.try_variant_get(whole, "$[0]", "variant"), name, col))


def to_json_record(*cols: Column | str) -> Column:
    """A JSON object of the given (named) columns."""
    return F.to_json(F.struct(*cols))
