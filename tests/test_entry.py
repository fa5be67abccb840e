"""The entry module without the optional packages: the planning queries load, the operators are left out with a warning."""

from __future__ import annotations

import pathlib
import subprocess
import sys

import pytest

ROOT = str(pathlib.Path(__file__).resolve().parents[1])


@pytest.mark.parametrize("package", ["regex", "numpy", "pyarrow"])
def test_planning_queries_need_no_optional_package(package):
    code = (f"import sys, warnings; sys.path.insert(0, {ROOT!r}); sys.modules[{package!r}] = None\n"
            "with warnings.catch_warnings(record=True) as said:\n"
            "    warnings.simplefilter('always')\n"
            "    import __spark_entry__ as e\n"
            "from sparecast.plans.queries import registry\n"
            "assert set(e.queries()) == set(registry()) and set(e.oracle_sql()) == set(registry())\n"
            f"import os; assert any({package!r} in str(w.message) for w in said) or not os.path.isdir(os.path.join({ROOT!r}, 'sparecast', 'llm'))\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
