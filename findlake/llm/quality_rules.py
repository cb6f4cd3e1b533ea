"""Quality rules: counts inside each text, then lines that too many documents of a host share.

Line frequency: a line in its normal form that more different texts of a host hold than the limit is
shared, and a shared line is removed if that many *different documents* hold it. Copies are not different
documents (they are left to the deduplication): exact ones are one text, and near ones are told by their
other lines. A line that is not shared is a variant if a quarter or more of its blocks of four words (in
lines under twelve words, of its thirds; in lines over forty, of its tenths) stand in more texts than the limit, beside shared lines; else it is
the text's own. A text whose own lines hold ``MIN_OWN_WORDS`` words counts as a different document, under
the smallest hash of those blocks of its own lines that are not so frequent. It does not matter how
little of the text that is, so hosts with hardly anything but boilerplate count too. A document that
keeps too small a share of its words is rejected.

Defined results: a null or empty text has no words and fails the base rules. A null host is a host
of its own. Repeated rows (same id and text) are copies, and get the same verdict; a null id is an
id. No rows give no rows. Columns other than id, text and host are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, join_rows, let, normal_line, texts, words, written

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A line in more different documents of one host than this is boilerplate.
MAX_DOCS_PER_LINE = 20
# A document must keep this share of its words.
MIN_KEPT_PERCENT = 30
BLOCK_WORDS = 4
MOST_BLOCKS = 10
# A line is a variant if this share of its blocks is frequent.
MIN_VARIANT_PERCENT = 25
# Words that a text's own lines must hold if it counts as a different document.
MIN_OWN_WORDS = 4


def covered_by_repeats(tokens: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words in windows that the text holds twice or more, the first one included."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            def twin(x: Column, j: Column) -> Column:
                before = F.coalesce(F.get(p, j - 1)["h"] == x["h"], F.lit(False))
                after = F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))
                return F.when(before | after, x["i"])

            return F.sort_array(F.array_compact(F.transform(p, twin)))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        total = F.aggregate(
            let(pairs, places),
            start,
            lambda s, i: F.struct((s["n"] + i + window - F.greatest(s["end"], i)).alias("n"), (i + window).alias("end")),
            lambda s: s["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(0)

    hashes = F.transform(F.sequence(F.lit(1), F.size(tokens) - window + 1), lambda i: F.xxhash64(F.slice(tokens, i, window)))
    return F.when(F.size(tokens) > window, let(hashes, covered)).otherwise(0)


def base_counts(documents: DataFrame) -> DataFrame:
    """Key and the counts of each text, with the verdict of the base rules."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            covered_by_repeats(w).cast("bigint").alias("n_repeat_words"),
        )

    counted = documents.select(
        "k",
        "doc_id",
        let(words(F.col("text")), of_words).alias("w"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )
    counted = counted.select("k", "doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def line_hash(line: Column) -> Column:
    return F.md5(normal_line(line))


def line_blocks(tokens: Column) -> Column:
    """Hashes of the different blocks of words, one after the other, of a line."""
    n = F.size(tokens)
    step = F.greatest(F.least(F.ceil(n / 3), F.lit(BLOCK_WORDS)), F.ceil(n / MOST_BLOCKS)).cast("int")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), n, step), lambda i: F.xxhash64(F.slice(tokens, i, step))))


def document_lines(documents: DataFrame) -> DataFrame:
    """One row per line that is not blank: ``host``, hash of the whole text ``t``, hash ``line``, its
    place ``i`` and ``n`` words, whether it is the ``first`` such line of the document, its ``blocks``."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))

    def facts(line: Column, i: Column) -> Column:
        def of(form: Column) -> Column:
            return let(
                F.split(form, " "),
                lambda w: F.struct(F.md5(form).alias("line"), i.alias("i"), F.size(w).alias("n"), line_blocks(w).alias("blocks")),
            )

        return let(normal_line(line), of)

    def flagged(p: Column) -> Column:
        def new(x: Column, j: Column) -> Column:
            before = F.get(p, j - 1)["line"]
            return x.withField("first", before.isNull() | (before != x["line"]))

        return F.transform(p, new)

    pairs = let(F.sort_array(F.transform(lines, facts)), flagged)
    each = documents.select("k", "doc_id", "host", F.xxhash64("text").alias("t"), F.explode(pairs).alias("p"))
    return each.select("k", "doc_id", "host", "t", "p.i", "p.line", "p.n", "p.first", "p.blocks")


def of_host(rows: DataFrame, other: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other`` on the host (a null one equals a null one) and ``columns``."""
    other = other.withColumnsRenamed({c: f"_{c}" for c in ("host", *columns)})
    same = F.col("host").eqNullSafe(F.col("_host"))
    for c in columns:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return rows.join(other, same, how).drop("_host", *[f"_{c}" for c in columns])


def in_many_texts(rows: DataFrame, column: str, max_docs: int) -> DataFrame:
    """``host`` and ``column`` where more than ``max_docs`` different texts of the host hold it."""
    texts_of = rows.select("host", column, "t").distinct().groupBy("host", column).agg(F.count("*").alias("texts"))
    return texts_of.where(F.col("texts") > max_docs).select("host", column)


def evidence(lines: DataFrame, hits: DataFrame, max_docs: int) -> DataFrame:
    """``host`` and hash ``t`` of the texts with a shared line (``hits``) and enough words of their own,
    with their ``mark``."""
    # One document stands for all with its text.
    chosen = F.min(F.struct("k", "doc_id")).alias("one")
    held = hits.groupBy("host", "t").agg(chosen, F.collect_set("line").alias("shared")).select("one.k", "one.doc_id", "shared")
    theirs = join_rows(lines.where("first"), held, "inner")
    narrow = theirs.select("host", "t", F.xxhash64("line").alias("l"), "n", "blocks", F.array_contains("shared", F.col("line")).alias("is_shared"))
    theirs = written(narrow, "lines-beside-shared")
    # Blocks of shared lines are frequent as they are; one row for each text and block of the other lines.
    blocks = theirs.where("NOT is_shared").select("host", "t", "l", "n", F.explode("blocks").alias("block"))
    of_shared = theirs.where("is_shared").select("host", "l", "blocks").dropDuplicates(["host", "l"])
    of_shared = of_shared.select("host", F.explode("blocks").alias("block"))
    often = written(in_many_texts(blocks, "block", max_docs).unionByName(of_shared).distinct(), "frequent-blocks")
    met = of_host(blocks, often.withColumn("often", F.lit(True)), "block", how="left")
    is_often = F.col("often").isNotNull()
    each = met.groupBy("host", "t", "l", "n").agg(
        F.count(F.lit(1)).alias("blocks"), F.count_if(is_often).alias("frequent"), F.min(F.when(~is_often, F.col("block"))).alias("block")
    )
    own = each.where(100 * F.col("frequent") < MIN_VARIANT_PERCENT * F.col("blocks"))
    own = own.groupBy("host", "t").agg(F.min("block").alias("mark"), F.sum("n").alias("own"))
    return own.where(F.col("own") >= MIN_OWN_WORDS).select("host", "t", "mark")


def frequent_lines(lines: DataFrame, hits: DataFrame, max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """``host`` and ``line`` of the shared lines in more than ``max_docs`` different documents of the host."""
    marked = of_host(hits.select("host", "t", "line").distinct(), evidence(lines, hits, max_docs), "t")
    marks = marked.select("host", "line", "mark").distinct().groupBy("host", "line").agg(F.count("*").alias("marks"))
    return marks.where(F.col("marks") > max_docs).select("host", "line")


def removed_lines(documents: DataFrame, max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """Key, hashes of the lines to remove and the words they hold, for documents that lose any."""
    lines = written(document_lines(documents), "document-lines")
    shared = written(in_many_texts(lines.where("first"), "line", max_docs), "shared-lines")
    hits = written(of_host(lines.select("k", "doc_id", "host", "t", "i", "line", "n"), shared, "line"), "shared-places")
    frequent = written(frequent_lines(lines, hits, max_docs), "frequent-lines")
    hit = of_host(hits, frequent, "line")
    places = hit.groupBy("k", "doc_id").agg(F.collect_set(F.struct("i", "line", "n")).alias("p"))
    total = F.aggregate("p", F.lit(0), lambda n, x: n + x["n"])
    return places.select("k", "doc_id", F.array_distinct(F.col("p")["line"]).alias("removed"), total.alias("removed_words"))


def judged(documents: DataFrame, host: str = "source", max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """Key, counts, ``base_failed``, ``n_removed_words``, hashes of the ``removed`` lines, ``kept``."""
    docs = texts(documents, F.col(host).alias("host"))
    removed = written(removed_lines(docs, max_docs), "removed-lines")
    joined = join_rows(base_counts(docs), removed)
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    kept = ~F.col("base_failed") & (100 * left >= MIN_KEPT_PERCENT * F.col("n_words"))
    return joined.withColumn("n_removed_words", F.coalesce("removed_words", F.lit(0)).cast("bigint")).withColumn("kept", kept)


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hash is in ``removed`` (null: none)."""
    left = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(removed, line_hash(x)))
    return F.when(removed.isNull(), text).otherwise(F.array_join(left, "\n"))
