"""Text functions of findings and reports, all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(value: Column) -> Column:
    """The string itself, or NULL when it is empty: chain with ``coalesce`` for "a or b"."""
    return F.nullif(value, F.lit(""))


def finding_key(file_path: Column, line_number: Column, rule_id: Column, title: Column) -> Column:
    """Identity of a finding across tools. A missing part reads ``None``."""
    none = F.lit("None")
    return F.md5(
        F.concat_ws(
            ":",
            F.coalesce(file_path, none),
            F.coalesce(line_number.cast("string"), none),
            F.coalesce(rule_id, none),
            F.coalesce(title, none),
        )
    )


def html_escape(text: Column) -> Column:
    # The five HTML escapes; the ampersand must go first.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def ellipsis(text: Column, limit: int) -> Column:
    """First ``limit`` characters, with dots when something was cut off (a display rule)."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def location(file_path: Column, line_number: Column, zero_line: bool = False) -> Column:
    """``path`` or ``path:line``. Reports drop line 0, the CI log (``zero_line``) keeps it."""
    shown = line_number.isNotNull() if zero_line else F.coalesce(line_number, F.lit(0)) != 0
    return F.when(shown, F.concat(file_path, F.lit(":"), line_number.cast("string"))).otherwise(file_path)


def sarif_rule_name(title: Column) -> Column:
    """A title as an identifier of at most 128 characters. Characters are replaced one for one,
    so those beyond the limit need no look."""
    name = F.regexp_replace(F.substring(title, 1, 128), r"[^\p{L}\p{N}_]", "_")
    name = F.when(name.rlike(r"^\p{Nd}"), F.concat(F.lit("_"), name)).otherwise(name)
    return F.when(truthy(title).isNull(), "unknown").otherwise(F.substring(name, 1, 128))


def sarif_message(title: Column, description: Column, resource: Column) -> Column:
    message = F.concat_ws(
        " | ",
        title,
        F.when((description != "") & (description != title), description),
        F.when(resource != "", F.concat(F.lit("Resource: "), resource)),
    )
    return F.substring(message, 1, 4096)


# --- fixed values: tags by the first tool family whose word is in the tool's name -------------
TAG_FAMILIES = [
    (["terraform"], ["terraform", "infrastructure-as-code"]),
    (["cloudformation", "cfn"], ["cloudformation", "infrastructure-as-code"]),
    (["secret", "gitleaks"], ["secrets", "credentials"]),
    (["bandit", "python"], ["python"]),
    (["npm", "snyk"], ["dependencies", "supply-chain"]),
]
# ---------------------------------------------------------------------------------------------


def sarif_tags(tool: Column, severity: Column) -> Column:
    """Array of tags: ``security``, the tool's family, the severity."""
    name = F.lower(tool)
    family = F
    for words, tags in TAG_FAMILIES:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(name, F.lit(word))
        family = family.when(hit, F.array(*map(F.lit, tags)))
    return F.concat(
        F.array(F.lit("security")),
        family.otherwise(F.array().cast("array<string>")),
        F.when(severity != "", F.array(F.concat(F.lit("severity-"), F.lower(severity)))).otherwise(
            F.array().cast("array<string>")
        ),
    )
