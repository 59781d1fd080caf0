"""The registered queries, their SQL, and the pipeline."""

from __future__ import annotations

import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import DOC, awkward, docs  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from millrun.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    found = entry.queries()
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in found and QUERIES.keys() <= found.keys()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", ["language_id_pages", "op4_surrogates", "op6_toxicity", "op8_language_id"])
def test_query_returns_every_row(spark, name):
    rows = spark.read.parquet(f"{SF}/{'pages' if 'pages' in name else 'documents'}.parquet").count()
    assert entry.queries()[name](spark, SF).count() == rows


def test_pipeline_stages_on_awkward_documents(spark, tmp_path):
    one = "the first of several words that stand here for a text and go on for more than twenty words so that it can repeat somewhere else"
    rows = [r for r in awkward()] + [(300, f"{one} alpha beta gamma"), (301, f"other start {one}"), (302, "mail me at joe.doe77@mail.example.com please")]
    df = docs(spark, rows, clash=True)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        out.write.parquet(path := str(tmp_path / name))
        if name != "packing":
            assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
        df = spark.read.parquet(path)
        kept[name] = df.collect()
    texts = {r.doc_id: r.text for r in kept["language_id"]}
    assert not texts.keys() & {1, 2, 3}
    ids = {r.doc_id for r in kept["simhash"]}
    assert 6 in ids and not ids & {7}
    assert next(r for r in kept["substrings"] if r.doc_id == 301).text == "other start"
    assert next(r for r in kept["substrings"] if r.doc_id == 301).n_chars == len("other start")
    assert next(r for r in kept["substrings"] if r.doc_id == 300).text == rows[-3][1]
    assert "joe.doe77@" not in next(r for r in kept["surrogates"] if r.doc_id == 302).text
    packed = defaultdict(int)
    for r in kept["packing"]:
        packed[r.sequence_id] += r.length
    assert {r.doc_id for r in kept["packing"]} == {r.doc_id for r in kept["surrogates"]} and max(packed.values()) <= 2048


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_run_over_a_table(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100
