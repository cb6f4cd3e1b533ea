"""Secret scan through a trigram index.

Each rule's regex yields a Boolean query over trigrams: alternatives, in each of which every trigram
must be present wherever the rule matches. The index holds, for all trigrams of all queries, which
documents contain them (in lower case); intersecting the postings gives the few documents that
can match a rule, and only those are verified with the regex. A rule with an alternative that
requires no trigram (a run of hex digits) is matched against every text.

Defined results: a null or empty text has no spans. Positions are code points, the end exclusive;
spans are ordered by start, then by the order of the rules, then by end. Matches of one rule never
overlap, those of different rules may. A very long text is matched whole, and placing its matches takes
time that follows their number. Repeated rows get equal results each; a null id stays null.
No rows give no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_rows, let, texts, written

# Candidates up to this size are sent to every executor; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
CANDIDATE_BYTES = 96
# Matches whose lengths are added up one by one.
SPAN_BLOCK = 64
MAX_ALTERNATIVES = 64
MAX_CLASS = 6


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts if its ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Public token formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _broken(found: set) -> set:
    """Alternatives (required trigrams, text just matched) after something that can be anything."""
    return {(need | _trigrams(tail), "") for need, tail in found}


def _class(items: list) -> set[str] | None:
    """The lower-case characters a small class stands for; None for a large or negated one."""
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MAX_CLASS:
            chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return chars if len(chars) <= MAX_CLASS else None


def _walk(nodes, found: set) -> set:
    for kind, value in nodes:
        if kind is op.LITERAL:
            found = {(need, tail + chr(value).lower()) for need, tail in found}
        elif kind is op.IN:
            chars = _class(value)
            found = _broken(found) if chars is None else {(need, tail + c) for need, tail in found for c in chars}
        elif kind is op.SUBPATTERN:
            found = _walk(value[3], found)
        elif kind is op.ATOMIC_GROUP:
            found = _walk(value, found)
        elif kind is op.BRANCH:
            found = set().union(*(_walk(branch, found) for branch in value[1]))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, part = value
            if (least, most) == (0, 1):
                found = found | _walk(part, found)
            else:
                for _ in range(min(least, 8)):
                    found = _walk(part, found)
                if least > 8 or most is op.MAXREPEAT or most > least:
                    found = _broken(found)
        elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):
            found = _broken(found)
        if len(found) > MAX_ALTERNATIVES:
            found = _broken(found)
        if len(found) > MAX_ALTERNATIVES:  # weaker, never wrong
            found = {(frozenset.intersection(*(need for need, _ in found)), "")}
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of required lower-case trigrams; None if the rule can match without any."""
    ends = _broken(_walk(parser.parse(pattern), {(frozenset(), "")}))
    alternatives = {need for need, _ in ends}
    if frozenset() in alternatives:
        return None
    return sorted((a for a in alternatives if not any(b < a for b in alternatives)), key=sorted)


def postings(documents: DataFrame, trigrams: list[str]) -> DataFrame:
    """Rows (trigram number, key): which documents contain which of ``trigrams``."""
    low = F.lower("text")
    numbered = F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    return documents.select("k", "doc_id", low.alias("low")).select(F.explode(F.array_compact(numbered)).alias("t"), "k", "doc_id")


def candidates(documents: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """Key and the numbers of the ``rules`` that the postings leave possible."""
    trigrams = sorted(set().union(*(need for alternatives in queries.values() for need in alternatives)))
    at = {t: i for i, t in enumerate(trigrams)}
    index = written(postings(documents, trigrams), "trigrams")
    wanted = [
        F.struct(F.lit(rule).alias("rule"), F.lit(number).alias("alternative"), F.lit(len(need)).alias("need"), F.lit(at[t]).alias("t"))
        for rule, alternatives in queries.items()
        for number, need in enumerate(alternatives)
        for t in sorted(need)
    ]
    wanted = documents.sparkSession.range(1).select(F.inline(F.array(*wanted)))
    both = index.distinct().join(wanted, "t").groupBy("k", "doc_id", "rule", "alternative", "need").agg(F.count("*").alias("have"))
    return both.where("have = need").groupBy("k", "doc_id").agg(F.collect_set("rule").alias("rules"))


def block_sums(sizes: Column) -> Column:
    """For every block of ``SPAN_BLOCK`` sizes what those before it add up to."""

    def over(sums: Column) -> Column:
        return F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, 1, b), F.lit(0), lambda n, x: n + x))

    starts = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / SPAN_BLOCK).cast("int"))
    each = F.transform(starts, lambda b: F.aggregate(F.slice(sizes, b * SPAN_BLOCK + 1, SPAN_BLOCK), F.lit(0), lambda n, x: n + x))
    return F.when(F.size(sizes) > 0, let(each, over)).otherwise(F.array().cast("array<int>"))


def matches(text: Column, rule: Rule, order: int) -> Column:
    """Structs (start, order, end) of the rule's matches, from left to right."""

    def placed(found: Column) -> Column:
        # Lengths of what is between and of the matches, in turn; blocks of them are added up first, so that
        # a text with very many matches costs little more than their number.
        sizes = F.transform(found["all"], lambda m, i: F.length(F.get(found["between"], i)) + F.length(m))
        return let(
            F.struct(sizes.alias("sizes"), block_sums(sizes).alias("blocks"), found["all"].alias("all"), found["checked"].alias("checked")), spans_of
        )

    def spans_of(s: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            block = F.floor(i / SPAN_BLOCK).cast("int")
            inside = F.slice(s["sizes"], block * SPAN_BLOCK + 1, i - block * SPAN_BLOCK + 1)
            end = F.get(s["blocks"], block) + F.aggregate(inside, F.lit(0), lambda n, x: n + x)
            found = F.struct((end - F.length(m)).alias("start"), F.lit(order).alias("order"), end.alias("end"))
            return F.when(F.length(F.get(s["checked"], i)) >= rule.least, found)

        return F.array_compact(F.transform(s["all"], span))

    pattern = F.lit(rule.pattern)
    found = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("checked"),
        F.split(text, rule.pattern).alias("between"),
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    return F.when(text.rlike(_quick(rule)), let(found, placed)).otherwise(none)


def _quick(rule: Rule) -> str:
    """A pattern that every text with a counting match contains, cheap to try first."""
    if rule.group == 0 and rule.pattern.endswith("+") and rule.pattern.startswith("["):
        return f"{rule.pattern[:-1]}{{{rule.least}}}"
    return rule.pattern


def scan(documents: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc_id`` and the ``found`` spans (start, order of the rule, end) of every document."""
    docs = texts(documents)
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    possible = written(candidates(docs, {i: q for i, q in queries.items() if q}), "secret-candidates")
    if possible.count() * CANDIDATE_BYTES <= BROADCAST_BYTES:
        possible = F.broadcast(possible)
    joined = join_rows(docs, possible)
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    each = []
    for i, rule in enumerate(rules):
        spans = matches(F.col("text"), rule, i)
        if queries[i]:
            spans = F.when(F.array_contains("rules", i), spans).otherwise(none)
        each.append(spans)
    return joined.select("doc_id", F.sort_array(F.concat(*each)).alias("found"))


def spans_text(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...], base: int) -> DataFrame:
    """Counts and a checksum of the spans of the first ``base`` rules, and the text of all spans."""
    of_base = F.filter("found", lambda s: s["order"] < base)

    def count(order: int) -> Column:
        return F.size(F.filter("found", lambda s: s["order"] == order)).cast("bigint")

    counts = [count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(rules[:base])]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(of_base, rules), 256).alias("base_sha256"),
        spans_text(F.col("found"), rules).alias("spans"),
    )
