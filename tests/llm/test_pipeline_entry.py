import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from wardline.llm import decontam, queries, secrets
from wardline.llm.common import stored, table

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{i}" for i in range(1, 14)} == {re.match(r"op\d+", n)[0] for n in names if re.match(r"op\d+_", n)}
    assert "pipeline" in names and set(queries.LLM_ORACLE) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def test_stages_take_effect(spark, stages):
    first = table(spark, SF, "documents")
    toxic, near, clean, safe, mixed = stages
    for s in stages[:4]:
        assert s.columns == first.columns
    counts = [x.count() for x in (first, toxic, near)]
    assert counts == sorted(counts, reverse=True)
    assert not decontam.contamination_report(clean, table(spark, SF, "benchmark")).where("contaminated").count()
    assert not secrets.secret_report(safe).where("n_assign + n_access + n_hex > 0").count()
    assert safe.where(F.col("n_chars") != F.length("text")).count() == 0
    assert {"copy_no", "shuffle_key"} <= set(mixed.columns)
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in safe.collect()}


def test_clean_documents_pass_unchanged(spark, stages):
    """What no stage objects to is in the result with its text."""
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    near = {r["doc_id"] for r in stages[1].collect()}
    bad = {r["doc_id"] for r in decontam.contamination_report(table(spark, SF, "documents"), table(spark, SF, "benchmark")).where("contaminated").collect()}
    bad |= {r["doc_id"] for r in secrets.secret_report(table(spark, SF, "documents")).where("spans <> ''").collect()}
    kept = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    for i in near - bad:
        assert kept[i] == texts[i]


def test_run_equals_the_stages(spark, stages):
    got = sorted((r["doc_id"], r["copy_no"], r["text"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["copy_no"], r["text"]) for r in stages[-1].collect())


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_jaccard_join", "op7_substring_dedup", "op8_mixing", "op9_chat_format", "op10_quality_rules",
                                  "op12_source_divergence", "op13_lexical_search"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    mine = queries.LLM_QUERIES[name](spark, SF).toPandas()
    sql = con.execute(queries.LLM_ORACLE[name]).df()
    cols = sorted(mine.columns)
    assert cols == sorted(sql.columns)
    rows = lambda d: sorted(map(repr, d[cols].astype(object).itertuples(index=False, name=None)))
    assert rows(mine) == rows(sql)


def test_rest_works_without_this_part(tmp_path):
    """With both folders and the pipeline gone, the entry still imports."""
    import os
    import shutil
    import subprocess
    import sys

    repo = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(repo, "wardline"), tmp_path / "wardline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(repo, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) >= 40"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
