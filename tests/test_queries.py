"""Every query of the catalogue against its SQL in DuckDB; those without SQL must give rows."""

import os

import duckdb
import pytest

from cartolith.plans import CATALOGUE
from cartolith.sources.derived import TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    plain = lambda v: "NULL" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) if isinstance(v, (str, bool)) or not hasattr(v, "__index__") else f"{int(v):.6f}"
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query(spark, oracle, name):
    query, sql = CATALOGUE[name]
    got = query(spark, DATA).toPandas()
    if sql is None:
        assert len(got) > 0
        return
    want = oracle.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_queries_without_the_text_folder(tmp_path):
    """The entry module and the rest of the package don't need the text folder."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/cartolith", tmp_path / "cartolith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.FLAGSHIP in e.queries() and not any(n.startswith('op') for n in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
