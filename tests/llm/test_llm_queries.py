"""Registered queries of the operators: names, SQL counterparts, and a library that does without them."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import assert_same, duck

import corpus_pipeline
from cartage.llm.queries import ORACLES, QUERIES


def test_all_operators_are_registered():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "bpe"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), duck(sf_dir).execute(ORACLES[name]))


def test_entry_points_do_without_the_operators(tmp_path):
    root = Path(__file__).parents[2]
    for part in root.iterdir():
        if part.name not in ("corpus_pipeline.py", "cartage", "tests", ".git"):
            (tmp_path / part.name).symlink_to(part)
    (tmp_path / "cartage").mkdir()
    for part in (root / "cartage").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "cartage" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; assert e.queries() and not any(q.startswith('op') for q in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
