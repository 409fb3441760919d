"""Operator 12: line dedup by range-partitioned hashes, on DataFrame functions only.

A line's key is the line without blanks at its ends, A-Z lower-cased; only
keys of ``least_chars`` code points or more count.  A key found in
``least_docs`` documents or more loses all its lines, except those of the
document with the largest id.

1. Every counting line becomes ``(key hash, ~id, position)``; ``~id`` sorts
   ids downwards without overflow.  Texts stay where they are.
2. The rows are range-partitioned by hash and document and sorted by hash,
   document and position.  The document belongs to the range, so a line that
   a third of all documents hold runs on over as many partitions as it needs.
   The sorted rows are streamed once: the first occurrence of a key in each
   document counts, partly summed where it is read.
3. Only keys of enough documents meet the lines again; lines outside the first
   document of their key go.  The ``HOT`` keys of most documents are broadcast
   (so many rows, whatever the input); their lines need no partner in the
   shuffled join and are spread over all its partitions, so that no key
   outside them can hold more than one line in ``HOT`` there.
4. What goes is folded into one keep bitmap per document: 64 lines a word, and
   words of which every line stays are left out.  ``line_dedup`` returns these
   bitmaps, no text; ``kept_lines`` applies them to the documents.

Defined cases: a null or empty text is one empty line; a row with a null id
keeps its lines and counts for nothing; rows that share an id are one document
for the count, and each keeps its own lines (equal rows alike); texts of any
length are read whole, their lines as rows; ties cannot occur, the largest id
decides; an empty table gives an empty result; the input row stays in the
struct ``doc``, so extra columns clash with nothing.  Keys are compared by
128-bit hashes.  Ids are integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rows import with_computed
from ..session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = 64
HOT = 1000


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased (``lower`` does
    just that to ASCII text, and faster)."""
    line = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def _row_key(text: Column) -> Column:
    """Tells rows that share an id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """``(h1, h2, back, row, pos)`` of every line that counts."""
    text = F.col(text_col)
    lines = docs.where(F.col(id_col).isNotNull() & (F.octet_length(text) >= least_chars)).select(
        F.bitwise_not(F.col(id_col).cast("bigint")).alias("back"), _row_key(text).alias("row"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    lines = lines.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= least_chars)
    keyed = lines.select("back", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "back", "row", "pos")


def frequent_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """``(h1, h2, n, first_back)`` of the keys of ``least_docs`` documents or more."""
    order = ["h1", "h2", "back"]
    ranged = lines.select(*order, "pos").repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    nth = F.row_number().over(Window.partitionBy(*order).orderBy("pos"))  # streams the sorted rows, no exchange
    firsts = ranged.withColumn("nth", nth).where("nth = 1")
    seen = firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("back").alias("first_back"))
    return seen.where(F.col("n") >= least_docs)


def dropped_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(back, row, pos)`` of the lines of frequent keys outside the first document."""
    hot = frequent.orderBy(F.desc("n"), "h1", "h2").limit(HOT).select("h1", "h2", F.col("first_back").alias("hot_back"))
    marked = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    is_hot = F.col("hot_back").isNotNull()
    # a hot line looks for a key that depends on itself and, found or not, answers by its own column
    spread = marked.select(F.when(is_hot, F.xxhash64("back", "row", "pos")).otherwise(F.col("h1")).alias("h1"), "h2",
                           "hot_back", "back", "row", "pos")
    met = spread.join(frequent.select("h1", "h2", "first_back"), ["h1", "h2"], "left")
    return met.where(F.col("back") > F.coalesce("hot_back", "first_back")).select("back", "row", "pos")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20,
               least_docs: int = 3) -> DataFrame:
    """``(id, row, n_dropped, keep)`` of every document that loses lines.
    ``keep`` holds ``(word, bits)``: bit b of word w says whether line
    64 * w + b stays; all lines of a word that is missing stay."""
    lines = hashed_lines(docs, id_col, text_col, least_chars)
    spark = docs.sparkSession
    path = scratch_path(spark, "frequent-lines")
    frequent_keys(lines, least_docs).write.parquet(path)
    dropped = dropped_lines(lines, spark.read.parquet(path))
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    # one exchange: rows dealt by document serve both groupings
    words = (dropped.repartition("back", "row")
             .groupBy("back", "row", F.expr(f"pos div {WORD}").cast("int").alias("word")).agg(F.bit_or(bit).alias("gone")))
    return words.groupBy("back", "row").agg(
        F.sum(F.bit_count("gone")).cast("bigint").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
    ).select(F.bitwise_not("back").alias("id"), "row", "n_dropped", "keep")


def kept_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, n_lines, n_dropped, keep, kept_text`` of every row of ``docs``."""
    text = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("bigint").alias("id"), _row_key(F.col(text_col)).alias("row"))
    joined = with_computed(rows.join(bitmaps, ["id", "row"], "left"), lines=F.split(text, "\n", -1))
    bits = F.sequence(F.lit(0), F.lit(WORD - 1))
    gone = F.flatten(F.transform("keep", lambda w: F.transform(
        F.filter(bits, lambda b: F.getbit(w["bits"], b) == 0), lambda b: w["word"] * WORD + b)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return joined.select("doc", F.size("lines").cast("bigint").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"), "keep",
                         F.when(F.col("keep").isNull(), text).otherwise(kept).alias("kept_text"))
