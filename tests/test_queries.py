"""Every query with SQL against DuckDB on the smallest tables; the entry point; imports."""

import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

from tidepool.plans.queries import ORACLE_SQL, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_the_llm_part(tmp_path):
    """The rest of the library imports where the llm folders and the pipeline are gone."""
    for f in ("tidepool", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{f}", tmp_path / f) if f != "tidepool" else os.makedirs(tmp_path / f)
    for f in os.listdir(f"{ROOT}/tidepool"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/tidepool/{f}", tmp_path / "tidepool" / f)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op1') for k in q) and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    script = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); {code}"
    with open(f"{ROOT}/__spark_entry__.py") as f:
        (tmp_path / "__spark_entry__.py").unlink()
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    assert subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True).returncode == 0
