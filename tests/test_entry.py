import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/", 2)[0]


@pytest.mark.parametrize("missing", ["userflow.llm", "corpus_pipeline", "numpy"])
def test_base_queries_stand_without_the_optional_part(missing):
    """As where it is deleted, or where a package that only it needs is not installed."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, oracles, optional = run.stdout.split()
    assert queries == oracles and int(queries) > 60 and optional == "False"
