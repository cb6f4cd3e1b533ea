"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findlake.session import materialize, remove_folder, shared_dir

# The characters that separate words.
SPACE = r"\x20\x09-\x0D"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    return materialize(df, f"llm-{purpose}")


def written_for_now(df: DataFrame, purpose: str) -> tuple[DataFrame, Callable[[], None]]:
    """The same, and a function that removes the files once all that read them is written itself."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), lambda: remove_folder(spark, path)


def texts(documents: DataFrame, *columns: str) -> DataFrame:
    """Row key ``k``, ``doc_id``, the whole ``text`` (null: empty) and ``columns``; nothing else.

    ``k`` hashes id and text, so rows with the same id and different texts stay apart and repeated
    rows count as one document. Joins use ``k`` together with ``doc_id``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.xxhash64("doc_id", text).alias("k"), "doc_id", text.alias("text"), *columns)


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the row key (a null ``doc_id`` equals a null one); key columns come from the left.

    Give ``right`` a hint where the plan should not depend on its size.
    """
    other = right.withColumnsRenamed({"k": "_right_k", "doc_id": "_right_id"})
    joined = left.join(other, (F.col("k") == F.col("_right_k")) & F.col("doc_id").eqNullSafe(F.col("_right_id")), how)
    return joined.drop("_right_k", "_right_id")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text: maximal runs of characters that are not white space."""
    trimmed = F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, rf"[{SPACE}]+"))


def normal_line(line: Column) -> Column:
    """Lower-cased, white space collapsed and trimmed: lines that look alike are one line."""
    return F.trim(F.regexp_replace(F.lower(line), rf"[{SPACE}]+", " "))


def hash128(value: Column) -> Column:
    """Two independent 64-bit hashes: at 10^11 lines a single one would collide."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def with_row(documents: DataFrame) -> DataFrame:
    """``k``, ``doc_id``, ``text`` and the whole row as ``whole``, whatever its columns are called."""
    text = F.coalesce(documents["text"], F.lit(""))
    key = F.xxhash64(documents["doc_id"], text)
    return documents.select(F.struct("*").alias("whole"), key.alias("k"), documents["doc_id"].alias("doc_id"), text.alias("text"))
