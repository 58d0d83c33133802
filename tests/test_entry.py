"""The driver contract with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(blocked: str) -> set[str]:
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, oracles = run.stdout.strip().splitlines()[-2:]
    assert set(oracles.split()) <= set(queries.split())
    return set(queries.split())


def test_entry_without_the_subpackage():
    from semestra.standins import registry

    for blocked in ("semestra.llm", "semestra.llm.registry", "corpus_pipeline"):
        assert names(blocked) == set(registry.QUERIES)
