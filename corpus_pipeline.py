"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, written as Parquet and read again. All but the last give
the columns of their input. Null texts count as empty ones; rows with a null id, repeated rows and
columns of any other name pass through as they are, unless a stage's decision concerns them:

* quality: rejected documents go, lines that too many documents of a source share go from the others;
* line dedup: covered lines go, the document stays, if need be with an empty text;
* near-dedup: of each group the row with the smallest id stays (null ids last, then by text hash), of
  repeated rows one;
* decontamination: ids go of which any text covers a benchmark item;
* packing: the pieces of what is left and their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findlake.llm import line_dedup, packing, quality_rules, simhash_anchors, string_tiling
from findlake.llm.common import join_rows, texts, with_row, written
from findlake.llm.queries import table, tokenizer_path


def _rewritten(rows: DataFrame, text: Column) -> DataFrame:
    """The whole rows with another text; ``n_chars`` follows it where there is one."""
    whole = F.col("whole").withField("text", text)
    kind = rows.schema["whole"].dataType
    if "n_chars" in kind.fieldNames():
        whole = whole.withField("n_chars", F.length(text).cast(kind["n_chars"].dataType))
    return rows.select(whole.alias("whole")).select("whole.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.judged(docs).where("kept").select("k", "doc_id", "removed").dropDuplicates(["k", "doc_id"])
    rows = join_rows(with_row(docs), verdicts.hint("merge"), "inner")
    return _rewritten(rows, quality_rules.without_lines(F.col("text"), F.col("removed")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    covered = written(line_dedup.covered_lines(texts(docs)), "line-covered")
    rows = join_rows(with_row(docs), covered.hint("merge"))
    return _rewritten(rows, line_dedup.kept_text(F.col("text"), F.col("covered")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = written(simhash_anchors.representatives(simhash_anchors.groups(docs)), "representatives")
    kept = kept.withColumnsRenamed({"k": "_k", "doc_id": "_id"})
    rows = with_row(docs).join(kept.hint("merge"), F.col("k") == F.col("_k"))
    rows = rows.where(F.col("doc_id").eqNullSafe(F.col("_id")))
    nth = F.row_number().over(Window.partitionBy("k", "doc_id").orderBy("k"))
    return rows.withColumn("nth", nth).where("nth = 1").select("whole.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = string_tiling.contaminated(docs, table(spark, sf_dir, "benchmark"))
    found = written(found.select(F.col("doc_id").alias("_id")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]), "left_anti")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", sequences),
]

# Tokenization and packing have no SQL form; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
