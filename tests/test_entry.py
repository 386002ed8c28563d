"""Driver contract: entry runs, every query has an oracle, and a sample agrees with DuckDB at sf0.001."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_every_query_has_an_oracle():
    own = set(E.queries()) - set(E.CORPUS_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.CORPUS_QUERIES)
    assert len(own) >= 50


def test_a_missing_library_of_the_corpus_operators_costs_only_them():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), len(e.CORPUS_QUERIES))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(E.__file__), check=True).stdout.split()
    own = len(set(E.queries()) - set(E.CORPUS_QUERIES))
    assert out == [str(own), str(own), "0"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 30
    assert df.count() > 0


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 9)
        if hasattr(x, "as_tuple"):
            return float(x)
        return x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["estab_standardize", "links_standardize", "gdp_standardize", "qry04_estab_breakdown",
                                  "qry01_headcount", "snk07_infer_types", "src01_read_cp1252", "lkp04_orphans"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)
