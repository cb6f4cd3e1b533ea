from findlake.functions.paths import (
    basename,
    dirname,
    image_tag,
    normal_path,
    path_excluded,
    repo_name,
    sarif_path,
    strip_scan_root,
)
from findlake.functions.severity import (
    bandit_severity,
    checkov_severity,
    emoji,
    pylint_severity,
    sarif_level,
    sarif_score,
    severity_from_string,
    severity_rank,
    snyk_severity,
)
from findlake.functions.text import (
    ellipsis,
    finding_key,
    html_escape,
    location,
    sarif_message,
    sarif_rule_name,
    sarif_tags,
    truthy,
)

__all__ = [
    "bandit_severity",
    "basename",
    "checkov_severity",
    "dirname",
    "ellipsis",
    "emoji",
    "finding_key",
    "html_escape",
    "image_tag",
    "location",
    "normal_path",
    "path_excluded",
    "pylint_severity",
    "repo_name",
    "sarif_level",
    "sarif_message",
    "sarif_path",
    "sarif_rule_name",
    "sarif_score",
    "sarif_tags",
    "severity_from_string",
    "severity_rank",
    "snyk_severity",
    "strip_scan_root",
    "truthy",
]
