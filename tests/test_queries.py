"""Every registered query against its SQL oracle, and a stream against the batch plan."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from docketry.functions import fuzzy
from docketry.plans import bindings, registry
from docketry.sources import evidence
from docketry.streaming import monitor

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.sql(f"create view {name} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf_dir, tmp_path, name):
    out = registry.QUERIES[name](spark, sf_dir)
    out.write.parquet(str(tmp_path / "out"))
    if name not in registry.ORACLES:
        assert spark.read.parquet(str(tmp_path / "out")).count() >= 0
        return
    sql, got = registry.ORACLES[name], f"'{tmp_path}/out/*.parquet'"
    columns = ", ".join(f'"{c}"' for c in sorted(out.columns))
    assert sorted(duck.sql(sql).columns) == sorted(out.columns)
    for a, b in ((f"({sql})", got), (got, f"({sql})")):
        left = duck.sql(f"(select {columns} from {a}) except all (select {columns} from {b})").fetchall()
        assert left == [], left[:3]


def test_documents_are_typed_as_by_sql_beside_odd_letters(spark, tmp_path):
    """Letters that ``upper`` makes several of, those that are one in ASCII, and white space that engines don't agree on."""
    odd = "\u00df\u0149\u01f0\u1e96\u1e97\u1e98\u1e99\u1e9a\ufb00\ufb01\ufb02\ufb03\ufb04\ufb05\ufb06\u1e9e\u0131\u017f\u0130\u212a\u00e9\u0390\u1f80\u0587\x0b\x0c\r\x1c\x85\u00a0\u2028\0'k"
    forms = ("{}|b", "a|{}", "m@{}.de", "m@a.{}", "{}!!", "a{}!!", "copyr{}ght", "licen{}edunder", "pa{}{}portimage", "a\n{}manual correction\nb\ncopyright", "a\nmanual{}correction\nb\ncopyright", "a\nf{}led\nb\ncopyright")
    texts = [form.replace("{}", c) for form in forms for c in odd]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = dict(con.execute(registry.ORACLES["doc_type_cascade"]).fetchall())
    got = {r["doc_id"]: r["doc_type"] for r in registry.QUERIES["doc_type_cascade"](spark, str(tmp_path)).collect()}
    assert [(texts[i], want[i], got[i]) for i in want if got[i] != want[i]] == [] and len(got) == len(texts)
    assert set(want.values()) == {"licence", "shout", "mail", "table", "passport_image", "unknown"}


def test_damaged_names_are_pulled_back(spark, sf_dir):
    found = registry.QUERIES["snap_fuzzy"](spark, sf_dir)
    assert found.where("snapped = p_name").count() > 0.9 * found.count()


def test_identities_against_plain_clustering(spark, sf_dir):
    cases = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        cases.setdefault(r["conv_id"], []).append(" ".join(r["text"].split(" ")[:2]))
    got = {r["conv_id"]: r["n_names"] for r in registry.QUERIES["identity_conflict"](spark, sf_dir).collect()}
    assert got == {case: fuzzy.identities(names) for case, names in cases.items()}


def test_stream_of_a_cache_equals_the_batch(spark, sf_dir, tmp_path):
    pages = bindings.conversation_pages(spark, sf_dir).select("case_id", F.col("number").cast("int").alias("number"), "doc_type", "lines", "source", "ocr_lines", "hidden_text", "second_lines")
    pages = pages.withColumn("case_id", F.col("case_id").cast("string"))
    evidence.write_cache(pages.where("case_id % 2 = 0"), str(tmp_path / "cache"))
    evidence.write_cache(pages.where("case_id % 2 = 1"), str(tmp_path / "cache"))
    totals = monitor.totals_by_type(evidence.stream_cache(spark, str(tmp_path / "cache"), files_per_trigger=1))
    query = totals.writeStream.outputMode("complete").format("memory").queryName("totals").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state"))
    query.start().awaitTermination()
    batch = monitor.totals_by_type(evidence.read_cache(spark, str(tmp_path / "cache")))
    assert sorted(map(str, spark.table("totals").collect())) == sorted(map(str, batch.collect()))


def test_trailing_rate(spark):
    polls = spark.createDataFrame([(1, "2024-01-01 00:00:00", 0), (2, "2024-01-01 00:00:30", 10)], "id int, at string, n long").withColumn("at", F.col("at").cast("timestamp"))
    assert [r["per_minute"] for r in monitor.trailing_rate(polls, "at", "n").orderBy("id").collect()] == [None, 20.0]


def test_windows_slide(spark):
    events = spark.createDataFrame([("2024-01-01 00:30:00", "a"), ("2024-01-01 00:50:00", "a")], "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted(r["n"] for r in monitor.windowed_counts(events, "ts", "k", "1 hour", "30 minutes").collect()) == [2, 2]


def test_entry_works_without_the_training_data_operators(tmp_path):
    """A copy of the repository without those folders, with and without the pipeline, still registers and benches the rest."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = str(tmp_path / "copy")
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".*_cache"))
    code = "import __spark_entry__ as e, bench; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    for drop in (None, "corpus_pipeline.py"):
        if drop and os.path.exists(f"{copy}/{drop}"):
            os.remove(f"{copy}/{drop}")
        ran = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": copy}, capture_output=True, text=True, timeout=120)
        assert ran.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLES)), "False"], ran.stderr


@pytest.mark.parametrize("missing", ["xxhash", "tokenizers", "zstandard"])
def test_entry_works_without_an_optional_package(tmp_path, missing):
    """The registries are built where a package of the training-data operators isn't installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(tmp_path / "sitecustomize.py", "w") as f:
        f.write(f"import sys\nsys.modules[{missing!r}] = None\n")
    code = "import __spark_entry__ as e; print(set(e.queries()) >= set(e.registry.QUERIES), set(e.oracle_sql()) >= set(e.registry.ORACLES))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == ["True", "True"], ran.stderr
