"""The library never moves data rows through the driver or through Python."""

from __future__ import annotations

import pathlib
import re

PACKAGE = pathlib.Path(__file__).resolve().parents[1] / "sparecast"

FORBIDDEN = {
    r"\.collect\(": "collect",
    r"\.toPandas\(": "toPandas",
    r"\.rdd\b": "RDD API",
    r"\budf\(|pandas_udf|mapInPandas|applyInPandas": "Python UDF",
    r"\.localCheckpoint\(": "localCheckpoint",
    r"\.crossJoin\(": "cross join",
    r"\.take\(|\.head\(|\.tail\(": "row fetch",
}

# One-row aggregates read on the driver, by design: cut points (a few numbers),
# the first and last month an upload touches, row counts, a table's folder and the command line's
# one-row accuracy report.
ALLOWED_FIRST = {"running.py", "session.py", "publish.py", "cli.py", "sinks.py"}


def _sources():
    for path in sorted(PACKAGE.rglob("*.py")):
        if "llm" in path.relative_to(PACKAGE).parts:  # has rules and tests of its own
            continue
        yield path, path.read_text()


def test_no_driver_side_data_paths():
    found = []
    for path, text in _sources():
        code = "\n".join(line.split("#", 1)[0] for line in text.splitlines())
        for pattern, what in FORBIDDEN.items():
            if re.search(pattern, code):
                found.append(f"{path.name}: {what}")
        if ".first()" in code and path.name not in ALLOWED_FIRST:
            found.append(f"{path.name}: first()")
    assert not found, found


def test_fixed_values_are_declared_once():
    text = (PACKAGE / "functions" / "expressions.py").read_text()
    assert "Fixed values" in text
    for name in ("FORECAST_WEIGHTS", "BACKTEST_WEIGHTS", "CATEGORY_OF_PAIR", "COVERAGE_CUT_PER_MILLE"):
        assert name in text
