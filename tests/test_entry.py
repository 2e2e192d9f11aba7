import duckdb

import __spark_entry__ as E
from revline.sources.testdata import TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) == 16


def test_every_query_has_an_oracle():
    from revline.queries import CATALOGUE

    # the optional training-data queries may lack one
    assert set(CATALOGUE) <= set(E.oracle_sql()) <= set(E.queries())


def test_oracles_run_on_duckdb():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(sql).fetchall()


def test_a_few_queries_match_their_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("q_recommendations", "q_dim_date", "q_stage_reviews", "q_sentiment_documents"):
        sdf = E.queries()[name](spark, SF_SMALL)
        cols = sorted(sdf.columns)
        srows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
        res = con.execute(E.oracle_sql()[name])
        ocols = [d[0] for d in res.description]
        idx = [ocols.index(c) for c in cols]
        orows = sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())
        assert srows == orows, name
