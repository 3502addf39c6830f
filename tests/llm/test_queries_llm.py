"""The registered queries of this subpackage on the small tables, with SQL where there is any, and the pipeline."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from docketry.llm import perplexity, registry

from .conftest import prose
from .test_line_dedup import brute as brute_lines
from .test_minhash import survivors
from .test_models import brute_metrics


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, tmp_path, documents, name):
    out = registry.QUERIES[name](spark, sf_dir)
    out.write.parquet(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    if name in ("op1_simhash", "op2_quality_rules", "op4_line_dedup", "op5_sharding", "op7_quality", "op8_language", "op9_mixing", "op12_fill_in_middle", "op13_exact_dedup"):
        assert Counter(r["doc_id"] for r in rows.select("doc_id").collect()) == Counter(d[0] for d in documents)
    if name in registry.ORACLES:
        con = duckdb.connect()
        for table in ("documents", "conversations"):
            path = f"{sf_dir}/{table}.parquet"
            con.sql(f"create view {table} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
        sql, got, cols = registry.ORACLES[name], f"'{tmp_path}/out/*.parquet'", ", ".join(sorted(out.columns))
        assert con.sql(f"(select {cols} from ({sql})) except all (select {cols} from {got})").fetchall() == []
        assert con.sql(f"select count(*) from ({sql})").fetchall()[0][0] == rows.count()


def test_all_queries_are_registered(spark):
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_stages_against_brute_force(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]

    kept = stages["quality_rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    verdicts = {r["doc_id"]: r["kept"] for r in perplexity.judge(docs).collect()}
    base = {d[0] for d in documents if (m := brute_metrics(d[1]))[0] >= 20 and 100 * m[4] <= 30 * m[0]}
    left = [tuple(r) for r in kept.select("doc_id", "text", "lang", "source").collect()]
    assert {r[0] for r in left} == {i for i, k in verdicts.items() if k} <= base
    assert len(left) > 0.95 * len(base)

    kept = kept.cache()
    deduped = stages["line_dedup"](spark, kept, sf_dir)
    assert deduped.columns == docs.columns
    want = Counter((i, t) for i, t, _, _ in brute_lines(left))
    assert Counter((r["doc_id"], r["text"]) for r in deduped.collect()) == want
    assert all(r["n_chars"] == len(r["text"]) for r in deduped.collect())

    deduped = deduped.cache()
    single = stages["near_dedup"](spark, deduped, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in deduped.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == survivors(rows)
    assert single.columns == docs.columns

    single = single.cache()
    mixed = stages["mixing"](spark, single, sf_dir)
    assert mixed.columns == docs.columns
    assert set(Counter(r["doc_id"] for r in mixed.collect()).values()) <= {1, 2}
    packed = stages["packing"](spark, mixed, sf_dir)
    ends = packed.groupBy("doc_id", "doc_tokens").sum("length").collect()
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert all(r["sum(length)"] == r["doc_tokens"] * copies[r["doc_id"]] for r in ends)


def test_stages_take_odd_rows(spark, make_docs, odd_rows, sf_dir):
    plain = make_docs(odd_rows).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, plain, sf_dir)
        assert out.count() >= 0
        if name != "packing":
            assert out.columns == plain.columns
        assert stage(spark, plain.limit(0), sf_dir).count() == 0


CLASHES = ("low", "high", "__dk_lang", "band_lang", "draw", "target", "source_size", "n_dropped", "log_perplexity", "base_failed", "n_words", "digest", "lines", "bands", "hashes", "weight", "raw.name")


def test_stages_give_back_columns_of_clashing_names(spark, make_docs, odd_rows, sf_dir):
    clean = [(5000 + i, prose(60, i), "en", "ab"[i % 2]) for i in range(30)]
    docs = make_docs(odd_rows + clean)
    docs = docs.select("*", *[F.lit(f"kept {c}").alias(c) for c in CLASHES])
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    want = {"x", *(f"kept {c}" for c in CLASHES)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        rows = out.select(*[f"`{c}`" for c in extra]).distinct().collect()
        assert len(rows) == 1 and set(rows[0]) == want, name
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_the_rest_does_not_import_this_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "docketry")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as lines:
                    assert not any("llm" in x and "import" in x for x in lines), f
