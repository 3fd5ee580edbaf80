import duckdb
import pytest

import __spark_entry__ as E
from locus.plans import catalog

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["country", "total_cases"] and 0 < len(rows) <= 5


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def norm(v):
    return f"{v:.6f}" if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    res = duck.execute(E.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


def test_the_rest_works_without_the_optional_part(tmp_path):
    """An empty ``locus/llm`` folder, as an uninstall may leave it."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/locus", tmp_path / "locus", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    (tmp_path / "locus" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as E; print(sorted(E.queries()) == sorted(E.catalog.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert done.stdout.strip().endswith("True"), done.stderr
