from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from findlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Raw report rows of one tool from texts: raw("tflint", text, ...)."""
    from findlake.model import RAW_REPORTS

    def make(tool, *outputs, scan="s", target=".", code=0, stderr=""):
        rows = [(scan, tool, target, i, code, out, stderr) for i, out in enumerate(outputs)]
        return spark.createDataFrame(rows, RAW_REPORTS)

    return make


@pytest.fixture(scope="session")
def findings(spark):
    """Findings from dicts; what is not given takes a plain value."""
    from findlake.model import FINDINGS

    def make(*rows):
        plain = {"scan_id": "s", "tool": "tfsec", "severity": "HIGH", "rule_id": "R1", "title": "t", "description": "d",
                 "file_path": "a.tf", "line_number": 1, "metadata": "{}"}
        full = [{**plain, "seq": i, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r.get(c) for c in FINDINGS.fieldNames()) for r in full], FINDINGS)

    return make
