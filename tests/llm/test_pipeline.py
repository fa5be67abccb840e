"""The pipeline stage by stage, and what a session without the subpackage still offers."""

import collections
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from sparecast.llm.common import BATCH_BYTES, stored

from . import brute

ROOT = Path(__file__).resolve().parents[2]


def _texts(rows):
    return collections.Counter((r.doc_id, r.text) for r in rows.collect())


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, sf), str(tmp_path / name))
        kept[name] = rows
        assert rows.columns[: len(columns)] == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "benchmark_free", "tokens"]

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r.doc_id for r in kept["quality"].collect()}
    good, poor = ([i for i, q in labels.items() if q == k] for k in (1, 0))
    assert sum(i in left for i in good) >= 0.97 * len(good) and sum(i in left for i in poor) <= 0.35 * len(poor)

    best = {}
    for i, t in _texts(kept["quality"]):
        best[brute.lower(t)] = max(i, best.get(brute.lower(t), -1))
    assert {i for i, _ in _texts(kept["exact"])} == set(best.values())

    before = sorted(_texts(kept["exact"]))
    assert {i for i, _ in _texts(kept["near"])} == {c for _, c in brute.near(before)}

    before = sorted(_texts(kept["near"]))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {i for (i, _), x in zip(before, brute.contamination(before, items)) if not x[-1]}
    assert {i for i, _ in _texts(kept["benchmark_free"])} == clean

    last = kept["tokens"].collect()
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in last) and len(last) == len(clean)


def test_odd_rows_and_empty_tables(spark, odd, empty, sf):
    for docs in (odd, empty):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf)
            assert rows.columns[: len(docs.columns)] == docs.columns
            rows.count()


def test_entry_without_the_subpackage():
    """With the llm folders and the pipeline hidden, the other queries are still there."""
    code = (
        "import sys\n"
        "class Hidden:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('sparecast.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Hidden())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 41 and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "sparecast").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "sparecast").parts:
            assert "llm" not in path.read_text(), path


def test_stages_bound_their_batches(spark, sf):
    for name, stage in corpus_pipeline.STAGES[-2:]:
        session = spark.newSession()
        stage(session, session.read.parquet(f"{sf}/documents.parquet"), sf)
        assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == BATCH_BYTES, name
