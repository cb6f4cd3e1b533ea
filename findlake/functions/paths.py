"""Path functions: normal forms, exclusion, and names derived from paths."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Directory part, '' for a top-level file."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def normal_path(path: Column) -> Column:
    """POSIX normal form without ``..`` resolution: no empty or ``.`` segments, '' becomes '.',
    exactly two leading slashes are kept; back-slashes then become slashes. Paths that are in
    normal form already, the usual case, only pay one pattern test."""
    parts = F.array_remove(F.array_remove(F.split(path, "/"), ""), ".")
    lead = F.when(path.rlike("^//([^/]|$)"), "//").when(path.startswith("/"), "/").otherwise("")
    joined = F.concat(lead, F.array_join(parts, "/"))
    odd = path.rlike(r"//|/$|(^|/)\.(/|$)|^$")
    full = F.when(odd, F.coalesce(F.nullif(joined, F.lit("")), F.lit("."))).otherwise(path)
    return F.replace(full, F.lit("\\"), F.lit("/"))


def path_excluded(path: Column, patterns: Sequence[str]) -> Column:
    """True if a pattern is a substring of the normalised path; a pattern with ``**`` is also
    tried without it. A missing path is never excluded. ``patterns`` come from the job's
    configuration, so they are a short list of literals, not data. They are tested as one
    alternation of quoted texts, so the path is normalised once per row."""
    wanted: list[str] = []
    for pattern in patterns:
        pattern = pattern.strip()
        wanted.append(pattern)
        if "**" in pattern:
            wanted.append(pattern.replace("**/", "").replace("**", ""))
    if not wanted:
        return F.lit(False)
    any_pattern = "|".join(re.escape(p) for p in dict.fromkeys(wanted))
    return F.coalesce(normal_path(path).rlike(any_pattern), F.lit(False))


def strip_scan_root(path: Column, root: str | Column) -> Column:
    """Path relative to the scan root, if it lies under it."""
    size = F.lit(len(root)) if isinstance(root, str) else F.length(root)
    inside = F.ltrim(F.substr(path, size + 1), F.lit("/"))
    return F.when(path.startswith(root), inside).otherwise(path)


# --- fixed values: prefixes removed from report paths, one after the other --------------------
SARIF_PREFIXES = ["/repo/", "/github/workspace/", "./"]
# ---------------------------------------------------------------------------------------------


def sarif_path(path: Column) -> Column:
    for prefix in SARIF_PREFIXES:
        path = F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    return F.ltrim(path, F.lit("/"))


def image_tag(relative_dir: Column, prefix: str | Column = "scan-") -> Column:
    """Image name for a Dockerfile's directory; the repository root is called ``root``."""
    safe = F.regexp_replace(F.lower(relative_dir), r"[^\p{L}\p{N}-]", "-")
    safe = F.btrim(safe, F.lit("-"))
    name = F.when(relative_dir.isin("", "."), "root").otherwise(safe)
    return F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, name, F.lit(":latest"))


def repo_name(given: Column, remote_url: Column, path: Column) -> Column:
    """The given name, else the last segment of the remote URL without ``.git``, else the path."""
    last = F.substring_index(F.rtrim(F.btrim(remote_url, F.lit(" \t\r\n")), F.lit("/")), "/", -1)
    from_url = F.regexp_replace(last, r"\.git$", "")
    return F.coalesce(F.nullif(given, F.lit("")), F.nullif(from_url, F.lit("")), path)
