import importlib.util
from pathlib import Path

import duckdb
import pytest

from blendwise.llm import pii, simhash
from blendwise.llm.queries import ORACLE_SQL, QUERIES, QUALITY_THRESHOLD
from helpers import AWKWARD, documents
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages():
    path = Path(__file__).parents[2] / "corpus_pipeline.py"
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_stages_take_effect(spark, stages):
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in stages.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "PII", "packing"]
    kept = stages.quality(spark, docs, SF)
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    lines = stages.lines(spark, kept, SF)
    assert lines.columns == columns and lines.count() == kept.count()
    assert lines.agg(F.sum("n_chars")).first()[0] < kept.agg(F.sum("n_chars")).first()[0]
    assert lines.where("n_chars <> length(text)").count() == 0
    near = stages.near_duplicates(spark, docs, SF)
    found = simhash.simhash_components(docs, 3, 2)
    want = {r[0] for r in found.where("doc_id = component_id").select("doc_id").collect()}
    assert near.columns == columns and sorted(r.doc_id for r in near.collect()) == sorted(want) and len(want) < docs.count()
    clean = stages.personal_data(spark, docs, SF)
    assert clean.columns == columns and clean.count() == docs.count()
    assert all(not pii.base_spans(r.text) for r in clean.collect())
    packed = stages.packed(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_stages_on_awkward_rows(spark, stages):
    docs = documents(spark, AWKWARD)
    near = [r.doc_id for r in stages.near_duplicates(spark, docs, SF).collect()]
    assert len([i for i in near if i is not None]) == len({i for i in near if i is not None}) and None not in near
    nameless = documents(spark, [(None, "only here at all"), (1, "quite another text than that")])
    assert sorted(map(str, [r.doc_id for r in stages.near_duplicates(spark, nameless, SF).collect()])) == ["1", "None"]
    for _, stage in stages.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, docs, SF).count()


def test_groups_that_share_their_smallest_id_each_keep_a_row(spark, stages):
    one, other = "red apples grow on the old tree near the river", "twelve blue boats sail over the cold northern sea"
    docs = documents(spark, [(1, one), (2, one), (1, other), (3, other), (None, "last words of nobody at all here"), (None, "last words of nobody at all here")],
                     row_key="k", chosen="c", component=4, none=5)
    kept = stages.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.text, r.doc_id) for r in kept.collect()) == sorted([(one, 1), (other, 1), ("last words of nobody at all here", None)])


def test_run(spark, stages):
    out = stages.run(spark, SF)
    assert out.count() > 0 and out.columns[:2] == ["doc_id", "start"]
    assert stages.ORACLE_SQL is None and QUALITY_THRESHOLD == 0.3


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = sorted(con.execute(ORACLE_SQL[name]).fetchall(), key=str)
    assert sorted(map(tuple, QUERIES[name](spark, SF).collect()), key=str) == want


def test_queries_are_named_by_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
