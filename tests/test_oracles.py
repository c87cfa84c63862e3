"""Every library query against its SQL form in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from genoweave.plans import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return tuple(v)
        if v is None or (not isinstance(v, str) and pd.isna(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    columns = sorted(frame.columns)
    return sorted((tuple(cell(v) for v in r) for r in frame[columns].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    ours, theirs = catalogue.queries()[name](spark, sf_dir).toPandas(), con.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_every_query_without_sql_is_known():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"gr_mcl", "gr_mcl_backindex", "gr_dag_chain", "pl_graph_clusters", "pl_synteny_spans", "pl_figure"}
