"""Severity scales: tool words to the five levels, and levels to the scales of the reports."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from findlake.functions.text import truthy
from findlake.model import SEVERITIES

# --- fixed values: words of each tool, and the level they stand for --------------------------
GENERIC_WORDS = {
    "critical": "CRITICAL",
    "high": "HIGH",
    "medium": "MEDIUM",
    "low": "LOW",
    "info": "INFO",
    "informational": "INFO",
    "warning": "MEDIUM",
    "error": "HIGH",
}
PYLINT_WORDS = {
    "fatal": "CRITICAL",
    "error": "HIGH",
    "warning": "MEDIUM",
    "refactor": "LOW",
    "convention": "INFO",
}
BANDIT_WORDS = {"high": "HIGH", "medium": "MEDIUM", "low": "LOW"}
SNYK_WORDS = {"critical": "CRITICAL", "high": "HIGH", "medium": "MEDIUM", "low": "LOW"}

# Words looked for inside a check name, by level; the first level with a hit wins.
CHECK_NAME_WORDS = {
    "CRITICAL": [
        "public", "exposed", "secret", "password", "credential", "0.0.0.0/0",
        "open to internet", "publicly accessible",
    ],
    "HIGH": [
        "encryption", "kms", "ssl", "tls", "https", "iam", "policy", "permission", "wildcard",
        "mfa", "root account", "admin",
    ],
    "MEDIUM": [
        "logging", "log", "monitoring", "cloudtrail", "cloudwatch", "versioning", "backup",
        "retention", "audit",
    ],
    "LOW": ["tag", "name", "description", "metadata"],
}
TERRAFORM_EXTRA_HIGH = "imdsv2"

SARIF_LEVELS = {"CRITICAL": "error", "HIGH": "error", "MEDIUM": "warning", "LOW": "note", "INFO": "note"}
SARIF_SCORES = {"CRITICAL": "9.0", "HIGH": "7.0", "MEDIUM": "5.0", "LOW": "3.0", "INFO": "1.0"}
EMOJI = {
    "CRITICAL": ":red_circle:",
    "HIGH": ":orange_circle:",
    "MEDIUM": ":yellow_circle:",
    "LOW": ":white_circle:",
}
# ---------------------------------------------------------------------------------------------


def _lookup(key: Column, table: dict, default: str | int) -> Column:
    """Value of a small fixed table; other keys and NULL take the default."""
    pairs = ", ".join(f"{word!r}, {value!r}" for word, value in table.items())
    return F.coalesce(F.element_at(F.expr(f"map({pairs})"), key), F.lit(default))


def severity_from_string(word: Column) -> Column:
    return _lookup(F.lower(word), GENERIC_WORDS, "INFO")


def pylint_severity(message_type: Column) -> Column:
    return _lookup(F.lower(message_type), PYLINT_WORDS, "INFO")


def bandit_severity(word: Column) -> Column:
    return _lookup(F.lower(word), BANDIT_WORDS, "MEDIUM")


def snyk_severity(word: Column) -> Column:
    return _lookup(F.lower(word), SNYK_WORDS, "MEDIUM")


def checkov_severity(own: Column, check_name: Column, terraform: bool) -> Column:
    """The check's own severity if it states one, else by the words of its name."""
    name = F.lower(F.coalesce(check_name, F.lit("")))
    by_name = F
    for level, words in CHECK_NAME_WORDS.items():
        if terraform and level == "HIGH":
            words = [*words, TERRAFORM_EXTRA_HIGH]
        by_name = by_name.when(name.rlike("|".join(re.escape(w) for w in words)), level)
    return F.when(truthy(own).isNotNull(), severity_from_string(own)).otherwise(by_name.otherwise("MEDIUM"))


def severity_rank(severity: Column) -> Column:
    """INFO 0 up to CRITICAL 4; unknown words count as INFO."""
    return _lookup(severity, {level: rank for rank, level in enumerate(SEVERITIES)}, 0)


def sarif_level(severity: Column) -> Column:
    return _lookup(severity, SARIF_LEVELS, "note")


def sarif_score(severity: Column) -> Column:
    return _lookup(severity, SARIF_SCORES, "1.0")


def emoji(severity: Column) -> Column:
    return _lookup(severity, EMOJI, ":white_circle:")
