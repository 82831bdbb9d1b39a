"""The entry without the training-data package, or without a library that only this package needs."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]
SCRIPT = """
import json, sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


@pytest.mark.parametrize("blocked", ["basketflow.llm", "corpus_pipeline", "ahocorasick", "sentencepiece"])
def test_retail_queries_need_no_training_library(blocked):
    from querybook.queries import QUERIES

    run = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=TOP, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, oracles = json.loads(run.stdout.splitlines()[-1])
    assert queries == oracles == sorted(QUERIES)
    if blocked in ("ahocorasick", "sentencepiece") and (TOP / "basketflow" / "llm").exists():
        assert "left out" in run.stderr
