"""Running numbers, trailing rates and order statistics over split keys, and lookups that skip."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docketry.operators import order
from docketry.sources import evidence
from docketry.streaming import monitor

from .test_streams import plain_rates


def test_numbers_of_split_keys(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, at long, id long")
    got = order.numbered(df.repartition(6), ["k"], ["at", "id"], "n").collect()
    want, seen = {}, {}
    for k, _, i in sorted(rows, key=lambda r: r[1:]):
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert {r["id"]: r["n"] for r in got} == want
    assert order.numbered(df.limit(0), ["k"], ["at"], "n").count() == 0
    whole = order.numbered(df, [], ["at", "id"], "n")
    assert sorted(r["n"] for r in whole.collect()) == list(range(1, 3001))


@pytest.mark.parametrize("block", [60, 100, 100_000])
def test_rates_of_one_key_in_blocks(spark, block):
    polls = [("a", at, i) for i, at in enumerate(sorted(random.Random(2).randrange(3000) for _ in range(900)))]
    df = spark.createDataFrame(polls, "k string, s long, id long").withColumn("at", F.timestamp_seconds("s"))
    got = {r["id"]: r["per_minute"] for r in monitor.trailing_rate(df.repartition(5), "at", None, ["k"], ties=["id"], block=block).collect()}
    want = plain_rates(polls)
    assert got.keys() == want.keys()
    assert all((got[i] is None) == (rate is None) and (rate is None or abs(got[i] - rate) < 1e-9) for i, (_, rate) in want.items())


def test_no_task_has_more_than_its_share(spark, monkeypatch):
    """One key of 20,000 rows over four partitions: what each part of the sort has, and each block of the window."""
    events = spark.range(20_000).select(F.timestamp_seconds(F.col("id") * 3).alias("at"), "id").repartition(4)
    written = {}
    keep = order.materialised

    def kept(df, name, *rest):
        written[name] = keep(df, name, *rest)
        return written[name]

    monkeypatch.setattr(order, "materialised", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rated = monitor.trailing_rate(events, "at", ties=["id"], block=2000)
        assert rated.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["count"] for r in written["placed"].groupBy("__dk_part").count().collect()]
    assert len(parts) == 4 and max(parts) < 0.4 * 20_000
    assert "__dk_in" in rated._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("pivots", [3, 31])
def test_order_statistics(spark, pivots):
    rng = random.Random(3)
    values = {
        "long": [rng.randrange(50) for _ in range(400)], "double": [rng.choice([rng.random(), 0.5, float("inf"), -1e300]) for _ in range(300)],
        "string": [rng.choice(["a", "é", "z", "😀", "", "\uffee"]) for _ in range(300)], "date": [datetime.date(2020, 1, 1) + datetime.timedelta(rng.randrange(9)) for _ in range(99)],
        "decimal(20,2)": [Decimal(rng.randrange(1000)) / 100 for _ in range(200)], "timestamp": [datetime.datetime(2020, 1, 1, i % 24, i % 60) for i in range(50)],
    }
    for kind, of in values.items():
        df = spark.createDataFrame([(v,) for v in [*of, None]], f"v {kind}").repartition(3)
        plain = sorted(of, key=order._sortable)
        for share in (0.0, 0.5, 0.95, 1.0) if pivots == 31 else (0.95,):
            assert order.order_statistic(df, "v", share, pivots=pivots) == plain[min(int(len(of) * share), len(of) - 1)], (kind, share)
    assert order.order_statistic(df, "v", least=1000) is None and order.order_statistic(df.limit(0), "v") is None
    assert str(order.order_statistic(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"), "v", 0.6)) == "nan"


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    pages = spark.range(40_000).select(F.format_string("MIB-%06d", F.expr("id div 4")).alias("case_id"), (F.col("id") % 4).cast("int").alias("number"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("text"))
    path = str(tmp_path / "cases")
    evidence.write_case_table(pages, path, group_bytes=200_000)
    for case, n in (("MIB-005000", 4), ("MIB-999999", 0), ("MIB-005000x", 0)):
        found = evidence.find_case(spark, path, case)
        assert found.count() == n
        found = evidence.find_case(spark, path, case).select("text")
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        scans = [plan]
        while scans and "Scan" not in scans[0].nodeName():
            node = scans.pop(0)
            scans += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                scans.append(node.executedPlan())
        read = scans[0].metrics().apply("numOutputRows").value()
        assert read <= 1500 and (n == 0 or read >= n), (case, read)
    some = spark.createDataFrame([("MIB-000001",), ("MIB-000001",), ("MIB-009999",)], "case_id string")
    assert evidence.find_cases(spark, path, some).count() == 8
