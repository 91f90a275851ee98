"""The pipeline stage by stage, and the registry with and without the optional subpackage."""

from __future__ import annotations

import hashlib
import os
import subprocess
import sys

import corpus_pipeline as cp
import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    from opinio.llm.common import materialise
    from opinio.llm.decontam import decontaminate
    from opinio.llm.simhash import simhash_groups

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        if name == "secrets":  # the smallest tables have none
            rows = [(10_000 + i, f'plain words and token = "{hashlib.sha1(bytes([i])).hexdigest()}" in the text', "en", "s", 77) for i in range(5)]
            docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
        out = materialise(stage(spark, docs, SF), "t")
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            kept = {r["doc_id"] for r in out.collect()}
            before = {r["doc_id"] for r in docs.collect()}
            assert kept <= before and out.count() == len(kept)
            if name == "toxicity":
                assert 0.8 * len(before) < len(kept)
            if name == "simhash":
                groups = simhash_groups(docs)
                assert kept == {r["component_id"] for r in groups.collect()}
            if name == "decontamination":
                hit = {r["doc_id"] for r in decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
                assert kept == before - hit and hit
            if name == "secrets":
                assert kept == before
                text = " ".join(r["text"] for r in out.collect())
                assert text.count('token = "[SECRET]"') == 5
        else:
            assert out.count() == docs.count() and out.where("not decodes").count() == 0
        docs = out


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (None, "same words here", "en", "s", 15), (None, "same words here", "en", "s", 15), (1, "", "en", None, 0),
            (2, "Same words here", "en", "s", 15), (2, "Same words here", "en", "s", 15), (3, "quite another text", None, "s", 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = cp.drop_near_copies(spark, docs, SF)
    assert sorted((r["doc_id"] for r in near.collect()), key=str) == [1, 2, 3]
    more = [(2, "a wholly different text of the same id", "en", "s", 15), (3, "quite another text", "de", "s", 18), (None, "words of no document", "en", "s", 9)]
    near = cp.drop_near_copies(spark, docs.unionByName(spark.createDataFrame(more, docs.schema)).repartition(5), SF)
    assert sorted(map(tuple, near.collect()), key=str) == [(1, "", "en", None, 0), rows[4], more[0], rows[6], more[2]]
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).count() <= len(rows)


def test_decontamination_drops_no_other_document_of_the_same_id(spark):
    leak = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r["text"] or "").split()) > 12)
    rows = [(i, t, "en", "s", len(t)) for i in (None, 7) for t in (leak, "a clean text of its own", "another clean text")] + [(None, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.drop_benchmark_copies(spark, docs, SF).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in docs.collect() if r["text"] != leak)


def test_decontamination_equals_its_sql(spark):
    from opinio.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    name = "op2_decontaminate"
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.fetchall())


def test_registry_without_the_subpackage(tmp_path):
    for name in ("opinio", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name)
    probe = ("import sys; sys.modules['opinio.llm'] = None\nimport __spark_entry__ as e\n"
             "assert not [q for q in e.queries() if q.startswith('op') and q[2].isdigit() or q == 'pipeline'] and len(e.queries()) > 50; print('ok')")
    done = subprocess.run([sys.executable, "-c", probe], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.stdout.strip().endswith("ok"), done.stderr[-1500:]


def test_nothing_outside_imports_the_subpackage():
    for top, _, files in os.walk(os.path.join(ROOT, "opinio")):
        if "llm" in top.split(os.sep):
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(top, f)) as src:
                    assert "opinio.llm" not in src.read()
