"""The registered queries against their SQL, and the pipeline's stages, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tillstar.llm.queries import ORACLE, QUERIES
from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    r = duck(SF).execute(ORACLE[name])
    cols = [d[0] for d in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(x) for x in df.collect()])[0] == digest(cols, r.fetchall())[0]


def test_url_templates_with_unlike_branches_match_sql(spark, tmp_dir):
    """Branches that stay literal, a rejected one, deep paths and urls of no host."""
    pages = [(i, f"http://{['A', 'b'][i % 2]}.net/{['news', 'wiki', 'casino', 'x/y/casino'][i % 4]}/v{i % 5}/{i}") for i in range(400)]
    pages += [(500, None), (501, "no host"), (502, "http://b.net"), (503, "http://b.net/" + "a/" * 12 + "7"),
              (504, "https://www.example.org/en/12/3"), (505, "http://shop.com/de/1?q#f")]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_dir}/pages.parquet")
    labels = [(i, 0 if i % 4 >= 2 else 1, 1 if i % 40 == 0 else 0) for i in range(0, 400, 3)] + [(None, 0, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    df = QUERIES["op9_url_templates"](spark, tmp_dir)
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_dir}/{t}.parquet/*.parquet')")
    r = con.execute(ORACLE["op9_url_templates"])
    cols = [d[0] for d in r.description]
    assert digest(df.columns, [tuple(x) for x in df.collect()])[0] == digest(cols, r.fetchall())[0]
    assert df.where("verdict = 'block' and rule is null").count() > 0
    assert df.where("template like '%/casino/%'").count() > 0


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, columns = docs.count(), docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns and 0 < docs.count() <= before
    assert labels.where("toxic = 0").join(docs, "doc_id", "left_semi").count() > 0.6 * labels.where("toxic = 0").count()
    assert corpus_pipeline.run(spark, SF).count() > 0
