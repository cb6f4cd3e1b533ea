"""The operators applied to the whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import html_blocks, license_scan, line_dedup, nb_svm, packing, prefix_trie, quality_rules, secret_index, simhash_anchors, string_tiling, substring_dedup, token_align, url_filter
from .common import written

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return nb_svm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL. The list to block: URLs that a campaign link (``utm_...``) brought in."""
    pages = table(spark, sf_dir, "pages")
    campaign = pages.where(r"url rlike '[?&]utm_[^#]*'").select("url")
    return url_filter.judge(pages, campaign, URL_RULES)


def op3_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the base rules and public token formats."""
    rules = secret_index.BASE_RULES + secret_index.MORE_RULES
    return secret_index.digest(secret_index.scan(table(spark, sf_dir, "documents"), rules), rules, len(secret_index.BASE_RULES))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and line frequency of every document."""
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that earlier documents hold in runs of three."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash_anchors.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 400-byte repeats leave of every document."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return string_tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    return token_align.aligned(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    turns = written(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie.nodes(prefix_trie.paths(prefix_trie.with_borrowed_starts(turns)))


def op13_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_nb_svm": op1_nb_svm,
    "op2_url_filter": op2_url_filter,
    "op3_secret_index": op3_secret_index,
    "op4_simhash_anchors": op4_simhash_anchors,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_blocks": op7_html_blocks,
    "op8_packing": op8_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_string_tiling": op10_string_tiling,
    "op11_token_align": op11_token_align,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_license_automaton": op13_license_automaton,
}
