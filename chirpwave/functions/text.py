"""Text helpers (C7, C8, C9 and the sentence split of C12).

All are ``Column -> Column`` built from native functions and run row-locally
(no shuffle, no state) on batch tables and streams alike.  Higher-order
functions (``transform``, ``aggregate``) are evaluated by the JVM's
interpreter, not by generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token and sentence delimiters.
#  - raw mode splits on a single space, case kept;
#  - normal mode lower-cases and splits on runs of whitespace or a comma;
#  - sentences end at runs of . ! ? or a newline.
RAW_DELIMITER = " "
NORMAL_DELIMITER = r"[ \t\n\x0B\f\r]+|,"
SENTENCE_DELIMITER = r"[.!?\n]+"
# a token starting with '#': after the text start or a delimiter, up to the next delimiter
HASHTAG_NORMAL = r"(?<![^ \t\n\x0B\f\r,])#[^ \t\n\x0B\f\r,]*"
HASHTAG_RAW = r"(?<![^ ])#[^ ]*"
# characters stripped from both ends of a sentence
SENTENCE_PAD = " \t\x0b\f\r"
# characters stripped by a Java-style trim: every code point <= U+0020
JAVA_TRIM = r"\A[\x00-\x20]+|[\x00-\x20]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip every control character and space from both ends (Spark's
    ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), JAVA_TRIM, "")


def tokens(c: Column | str, mode: str = "normal") -> Column:
    """Split text into tokens: ``normal`` (lower-case, whitespace or comma)
    or ``raw`` (single space, case kept)."""
    c = _col(c)
    if mode == "normal":
        return F.split(F.lower(c), NORMAL_DELIMITER)
    if mode == "raw":
        return F.split(c, RAW_DELIMITER)
    raise ValueError(f"unknown tokenizer mode {mode!r}")


def hashtags(c: Column | str, mode: str = "normal") -> Column:
    """Array of the non-empty tokens of ``tokens(c, mode)`` that start
    with ``#`` (a bare ``#`` counts), in text order.

    Found with one regex scan -- a ``#`` at the start of the text or after
    a delimiter, up to the next delimiter -- instead of materialising every
    token of a long text; lower-casing the found tags equals tokenising
    the lower-cased text.  ~2x faster on whole documents, same result.
    """
    c = _col(c)
    if mode == "normal":
        return F.transform(F.regexp_extract_all(c, F.lit(HASHTAG_NORMAL), 0), lambda t: F.lower(t))
    if mode == "raw":
        return F.regexp_extract_all(c, F.lit(HASHTAG_RAW), 0)
    raise ValueError(f"unknown tokenizer mode {mode!r}")


def sentences(c: Column | str) -> Column:
    """Array of sentences, each stripped of surrounding blanks.

    A plain character-class split followed by a per-piece ``btrim`` is
    ~1.7x faster on long texts than one regex that also absorbs the
    blanks (which makes the regex engine try a match at every blank).
    """
    return F.transform(F.split(_col(c), SENTENCE_DELIMITER), lambda s: F.btrim(s, F.lit(SENTENCE_PAD)))


def longest_sentence(c: Column | str, guard: bool = True) -> Column:
    """The longest sentence by characters; the first one wins a tie.

    One ``aggregate`` over the split pieces keeps the longest so far, so no
    array of all trimmed pieces is built.  NULL for NULL or empty text
    (``guard=False`` leaves that test to the caller).
    """
    c = _col(c)
    pieces = F.split(c, SENTENCE_DELIMITER)

    def longer(best: Column, piece: Column) -> Column:
        s = F.btrim(piece, F.lit(SENTENCE_PAD))
        # a piece no longer than the best so far cannot win: it is not even trimmed
        return F.when((F.length(piece) > F.length(best)) & (F.length(s) > F.length(best)), s).otherwise(best)

    best = F.aggregate(pieces, F.lit(""), longer)
    if not guard:
        return best
    return F.when(c.isNull() | (F.length(c) == 0), F.lit(None).cast("string")).otherwise(best)
