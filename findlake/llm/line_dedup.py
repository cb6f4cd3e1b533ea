"""Line dedup: three-line windows that occur earlier in the corpus are removed.

Lines are compared in their normal form (lower case, white space collapsed); blank lines are
skipped, so windows run over the lines that hold something. Every window of three consecutive lines
is hashed; of equal windows, in the order (doc_id, row key, position), the first stays and every
later one covers its three lines. Covered lines go, in whichever windows they are covered.

Defined results: a document with fewer than three such lines, an empty or a null text keeps all it
has (null becomes empty). Repeated rows (same id and text) count as one document and lose the same
lines; rows with the same id and other texts are documents of their own, in the order of their row
keys. A null id comes first. Blank lines stay. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, hash128, join_rows, let, normal_line, texts, written

WINDOW = 3


def numbered_lines(text: Column) -> Column:
    """Structs (place among all lines, normal form) of the lines that are not blank."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("i"), normal_line(line).alias("line")))
    return F.filter(lines, lambda x: x["line"] != "")


def windows(documents: DataFrame) -> DataFrame:
    """One row per window: hash ``a``, ``b``, its document and the places of its lines."""
    lines = documents.select("k", "doc_id", numbered_lines(F.col("text")).alias("lines"))
    starts = F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1))

    def window(j: Column) -> Column:
        part = F.slice("lines", j, WINDOW)
        return F.struct(hash128(F.array_join(part["line"], "\n")).alias("h"), part["i"].alias("places"))

    each = F.explode(F.transform(starts, window))
    rows = lines.where(F.size("lines") >= WINDOW).select("k", "doc_id", each.alias("w"))
    return rows.select("w.h.a", "w.h.b", "k", "doc_id", F.col("w.places").alias("places"))


def repeated_windows(found: DataFrame) -> DataFrame:
    """Hash and first occurrence of each window that occurs more than once."""
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", F.element_at("places", 1).alias("at"))
    seen = found.select("a", "b", place.alias("p"))
    seen = seen.groupBy("a", "b").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    return seen.where("first != last").select("a", "b", "first")


def covered_lines(documents: DataFrame) -> DataFrame:
    """Document and the places of its lines that later occurrences cover."""
    found = windows(documents)
    repeated = written(repeated_windows(found), "line-windows")
    here = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", F.element_at("places", 1).alias("at"))
    later = found.withColumn("here", here).join(repeated.hint("merge"), ["a", "b"]).where("here != first")
    return later.groupBy("k", "doc_id").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("covered"))


def kept_text(text: Column, covered: Column) -> Column:
    """The text without its covered lines."""
    lines = F.split(text, "\n")
    left = let(lines, lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), covered), lambda i: x[i]))
    return F.when(covered.isNull(), text).otherwise(F.array_join(left, "\n"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines`` (not blank), ``n_removed`` and the kept ``text`` of every document."""
    docs = texts(documents)
    joined = join_rows(docs, written(covered_lines(docs), "line-covered").hint("merge"))
    return joined.select(
        "doc_id",
        F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))).cast("bigint").alias("n_lines"),
        F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("bigint").alias("n_removed"),
        kept_text(F.col("text"), F.col("covered")).alias("text"),
    )
