"""Line deduplication by overlapping windows of three lines.

Every run of three consecutive lines (trimmed, blank ones left out) is hashed.
Of a window that occurs more than once in the corpus the first occurrence stays,
by document id and position; the lines of every later one are covered.  Covered
positions of a document merge into spans, and their lines go.  Where a window overlaps its own first
occurrence (lines that repeat one after another) the lines of the first occurrence stay.  Blank lines stay.
A text of fewer than three lines has one window, all of its lines: it goes if an earlier text consists of the same lines.

The windows of a text are made within its row, so that only their hashes are
shuffled.  A window that a third of all documents hold is combined by each task
before the shuffle; the join back to its occurrences is one that Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import fresh, text_of, with_columns_last
from corate.session import materialize

BLANKS = " \t\n\x0b\x0c\r"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _solid(text: Column) -> Column:
    """The lines that are not blank: their numbers (from 0) and trimmed texts."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("no"), _trim(line).alias("line")))
    return F.filter(lines, lambda x: x["line"] != "")


def line_windows(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, print (a hash that tells texts apart), begin and end (line numbers) and the 128-bit key (h1, h2)."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("print"), _solid(text_of(text_col)).alias("solid")
    ).where(F.size("solid") > 0)

    def window(i: Column) -> Column:
        part = F.slice("solid", i, size)
        lines = F.transform(part, lambda x: x["line"])
        return F.struct(
            F.get(part, F.lit(0))["no"].alias("begin"),
            F.element_at(part, -1)["no"].alias("end"),
            F.xxhash64(F.size(part), lines).alias("h1"),
            F.xxhash64(F.lit(1), F.size(part), F.reverse(lines)).alias("h2"),
        )

    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("solid") - (size - 1)))
    return rows.select("id", "print", F.explode(F.transform(starts, window)).alias("w")).select("id", "print", "w.*")


def merged(spans: DataFrame) -> DataFrame:
    """id, print, spans: the spans (begin, end) of each text, overlapping ones as one."""
    by_doc = Window.partitionBy("id", "print").orderBy("begin", "end")
    reach = F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    return (
        spans.distinct()
        .withColumn("new", F.coalesce(F.col("begin") > reach, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(by_doc))
        .groupBy("id", "print", "span")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .groupBy("id", "print")
        .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    )


def covered_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per document with covered lines: id, print, spans and first_spans (arrays of begin and end line numbers).

    Lines of ``spans`` go but for those of ``first_spans``, first occurrences that a later one of theirs overlaps.
    """
    windows = line_windows(docs, id_col, text_col, size)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "print", "begin", "end")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    later = windows.join(repeated, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    later = materialize(later.select("id", "print", "begin", "end", "first"), "later-windows")
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("print") == F.col("first.print"))
    overlapped = later.where(own & (F.col("begin") <= F.col("first.end")))
    first = merged(overlapped.select("id", "print", F.col("first.begin").alias("begin"), F.col("first.end").alias("end")))
    spans = merged(later.select("id", "print", "begin", "end"))
    kept = first.select(F.col("id").alias("of"), F.col("print").alias("of_print"), F.col("spans").alias("first_spans"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print"))
    return spans.join(kept, same, "left").select("id", "print", "spans", F.coalesce("first_spans", F.array()).alias("first_spans"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with ``text_col`` without the covered lines, and n_lines (not blank), n_removed and spans.

    A text without lines that are not blank stays as it is; so does a null or empty one (null
    becomes empty).  Null ids come last in the order.  Rows that repeat an id and a text are one document: their
    windows count as one occurrence.  Input columns named like the added ones
    are replaced.  An empty table gives an empty result.
    """
    spans = covered_spans(docs, id_col, text_col, size).select(
        F.struct("id", "print").alias("of"), F.struct("spans", "first_spans").alias("found")
    )
    of, found, new = (fresh(c, docs) for c in ("_of", "_found", "_new"))
    spans = spans.select(F.col("of").alias(of), F.col("found").alias(found))
    text = text_of(text_col)
    same = docs[id_col].eqNullSafe(F.col(f"{of}.id")) & (F.xxhash64(text) == F.col(f"{of}.print"))
    joined = docs.join(spans, same, "left")
    touched = F.col(found).isNotNull()

    def within(no: Column, name: str) -> Column:
        return F.exists(F.col(f"{found}.{name}"), lambda s: no.between(s["begin"], s["end"]))

    def stays(line: Column, no: Column) -> Column:
        return (_trim(line) == "") | ~within(no, "spans") | within(no, "first_spans")

    lines = F.split(text, "\n")
    solid = F.size(F.filter(lines, lambda line: _trim(line) != ""))
    kept = F.filter(lines, stays)
    none = F.array().cast("array<struct<begin:int,end:int>>")
    result = with_columns_last(
        joined,
        {
            new: F.when(touched, F.array_join(kept, "\n")).otherwise(text),
            "n_lines": solid.cast("long"),
            "n_removed": F.when(touched, F.size(lines) - F.size(kept)).otherwise(F.lit(0)).cast("long"),
            "spans": F.coalesce(F.col(f"{found}.spans"), none),
        },
    ).drop(of, found)
    return result.withColumn(text_col, F.col(new)).drop(new)
