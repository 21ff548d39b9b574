"""The registered queries against their SQL, and the pipeline, on the smallest tables."""

import collections
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL
from tabulon.llm import catalog

sys.path.insert(0, ROOT)
import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(catalog.oracle_sql()[name]).df()
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()[list(want.columns)]

    def rows(df):
        return collections.Counter(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))

    assert rows(got) == rows(want)


def test_pipeline_stages(spark):
    """Each stage against what it must keep of its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], SF_SMALL)
        if name != "bpe":
            assert out.columns == docs.columns
        seen.append(spark.createDataFrame(out.collect(), out.schema))
    clean, lines, near, mix, tokens = ([r for r in d.collect()] for d in seen[1:])
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("toxic = 0").collect()}
    assert toxic <= {r["doc_id"] for r in clean}  # labelled clean documents stay
    assert collections.Counter(r["doc_id"] for r in lines) == collections.Counter(r["doc_id"] for r in clean)
    assert {r["doc_id"] for r in near} <= {r["doc_id"] for r in lines}
    assert {r["doc_id"] for r in mix} <= {r["doc_id"] for r in near}
    assert len(tokens) == len(mix) and all(r["n_tokens"] == len(r["ids"]) for r in tokens)
