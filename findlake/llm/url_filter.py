"""URL filter: allow and block rules, then a list of URLs behind a blocked Bloom filter.

The list is hashed into blocks of four 64-bit words; a listed URL sets one bit in each word of one
block. A URL whose four bits are not all set is certainly not listed and needs no exact look-up;
the others are joined with the list itself, which removes the false positives.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is
never listed. URLs are compared whole, whatever their length. Repeated URLs get a row each. An empty list blocks nothing; an empty table gives no
rows. Columns of the input other than the id and the URL are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 4
WORD_BITS = 64
# A filter up to this size is sent to every executor; a larger one is joined by block.
BROADCAST_BYTES = 32 << 20


# What follows the first ``://`` of column ``url``; null where there is none.
AFTER_SCHEME = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END"


def host_of(rest: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(rest: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(rest: Column, host: Column, path: Column, dropped: str = r"utm_[^=&]*|ref") -> Column:
    """The form under which URLs are listed: no scheme, no default port, no fragment, no closing
    slash, no tracking parameters (names matching ``dropped``), parameters in order; null for no URL."""
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~p.rlike(rf"^({dropped})(=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    site = F.regexp_replace(host, r":(80|443)$", "")
    page = F.regexp_replace(path, r"/+$", "")
    return F.when(rest.isNotNull(), F.concat(site, page, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def parsed(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """Id, ``host``, ``path`` and the canonical form ``listed_as`` of each URL."""
    urls = pages.select(F.col(id_column), F.col("url")).select(id_column, F.expr(AFTER_SCHEME).alias("rest"))
    urls = urls.select(id_column, "rest", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path"))
    form = canonical(F.col("rest"), F.col("host"), F.col("path"))
    return urls.select(id_column, "host", "path", form.alias("listed_as"))


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    A rule is ``host/path``; it fits its host and all subdomains where the path starts with its
    own. Of equally long rules the one with the longer host wins, then the blocking one.
    """
    order = sorted(rules, key=lambda r: (-len(r[1]), r[1].index("/") * -1, r[0] != "block"))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in reversed(order):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _bits(form: Column) -> list[Column]:
    """One bit in each word of the block."""
    h = F.xxhash64(F.lit("bit"), form)
    at = [F.shiftrightunsigned(h, 6 * j).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for j in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), a) for a in at]


def _block(form: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(form), F.lit(blocks))


def bloom_blocks(items: int, bits_per_item: int) -> int:
    return max(1, -(-items * bits_per_item // (WORDS * WORD_BITS)))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, w0..w3) of the filter of column ``listed_as``."""
    form = F.col("listed_as")
    bits = listed.select(_block(form, blocks).alias("block"), *[b.alias(f"w{j}") for j, b in enumerate(_bits(form))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)])


def possible(urls: DataFrame, bloom: DataFrame, blocks: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``urls`` whose ``listed_as`` may be in the list; no listed one is missing."""
    form = F.col("listed_as")
    if blocks * 8 * (WORDS + 2) <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    probe = urls.where(form.isNotNull()).withColumn("block", _block(form, blocks))
    hit = None
    for j, bit in enumerate(_bits(form)):
        here = F.col(f"w{j}").bitwiseAND(bit) != 0
        hit = here if hit is None else hit & here
    return probe.join(bloom, "block").where(hit).select(*urls.columns)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[tuple[str, str]],
    id_column: str = "page_id",
    bits_per_item: int = 16,
) -> DataFrame:
    """Id, ``host``, ``path``, ``rule``, ``verdict`` and ``listed`` of every URL.

    ``listed`` holds the URLs to block in a column ``url``. Rules come first; a URL that none fits
    is blocked if its canonical form is listed, and allowed otherwise.
    """
    forms = written(parsed(listed.select(F.lit(0).alias("id"), "url"), "id").where("listed_as is not null").select("listed_as").distinct(), "url-list")
    blocks = bloom_blocks(forms.count(), bits_per_item)
    bloom = written(bloom_filter(forms, blocks), "url-bloom")
    urls = parsed(pages, id_column).withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    open_urls = urls.where("found is null")
    candidates = possible(open_urls.select("listed_as"), bloom, blocks).distinct()
    truly = written(candidates.join(forms, "listed_as", "left_semi"), "url-hits").withColumn("listed", F.lit(True))
    plain = [id_column, "host", "path"]
    by_rule = urls.where("found is not null").select(*plain, "found.rule", "found.verdict", F.lit(False).alias("listed"))
    by_list = open_urls.join(truly, "listed_as", "left").select(
        *plain,
        F.lit(None).cast("string").alias("rule"),
        F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )
    return by_rule.unionByName(by_list)
