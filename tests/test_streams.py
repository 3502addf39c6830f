"""Growing files, the sink that has rows once, and rates kept as state."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.streaming import monitor, rates, sink, tail


def append(path, data):
    with open(path, "ab") as f:
        f.write(data)


def run(spark, path, base, part_bytes=tail.PART_BYTES):
    lines = tail.tail(spark, str(path), part_bytes)
    sink.start(lines, str(base)).awaitTermination()
    return sorted(tuple(r) for r in sink.read_once(spark, str(base), lines.schema).collect())


@pytest.mark.parametrize("part_bytes", [1, 7, 1 << 20])
def test_parts_have_each_line_once(tmp_path, part_bytes):
    """Also lines longer than a part, empty ones, and parts that begin at a line break."""
    rng = random.Random(4)
    lines = [b"x" * rng.choice([0, 1, 2, 6, 7, 8, 50]) for _ in range(200)]
    path = str(tmp_path / "f")
    append(path, b"".join(x + b"\n" for x in lines) + b"cut")
    end = tail.grown(path)
    assert end == {path: sum(len(x) + 1 for x in lines)}
    for start in (0, len(lines[0]) + 1):
        got = [x for part in tail.parts({path: start}, end, part_bytes) for x in tail.read_lines(pafs.LocalFileSystem(), part)]
        assert [x for _, x in got] == lines[bool(start) :]
        assert [at for at, _ in got] == np.cumsum([0, *(len(x) + 1 for x in lines)])[bool(start) : -1].tolist()


def test_long_lines_across_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "_BLOCK", 5)
    path = str(tmp_path / "f")
    append(path, b"a" * 23 + b"\n\n" + b"b" * 5 + b"\n" + b"c" * 12)
    assert tail.grown(path) == {path: 31}
    got = [x for part in tail.parts({}, tail.grown(path), 4) for x in tail.read_lines(pafs.LocalFileSystem(), part)]
    assert got == [(0, b"a" * 23), (24, b""), (25, b"b" * 5)]


def test_a_growing_file_gives_each_line_once(spark, tmp_path):
    """Between triggers files grow and appear, the query is started anew, a line is cut and ended later."""
    folder, base = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    one, two = str(folder / "one"), str(folder / "two")
    append(one, "erste Zeile é\nsecond\nthi".encode())
    append(str(folder / "_hidden"), b"no\n")
    assert [r[2] for r in run(spark, folder, base)] == ["erste Zeile é", "second"]
    assert [r[2] for r in run(spark, folder, base)] == ["erste Zeile é", "second"]
    append(one, b"rd\n\nfif")
    append(two, b"other\n")
    want = [(one, 0, "erste Zeile é"), (one, 15, "second"), (one, 22, "third"), (one, 28, ""), (two, 0, "other")]
    assert run(spark, folder, base, part_bytes=3) == want
    append(one, b"th\n")
    assert run(spark, folder, base) == sorted([*want, (one, 29, "fifth")])
    with open(two, "wb") as f:
        f.write(b"x\n")
    with pytest.raises(Exception, match="got shorter"):
        run(spark, folder, base)


def record(case, kinds, hidden=""):
    page = lambda i, k: {"number": i, "doc_type": k, "lines": ["x"] if i else [], "source": "ocr" if k == "a" else "text", "hidden_text": hidden}
    return json.dumps({"case_id": case, "pages": [page(i, k) for i, k in enumerate(kinds)]}).encode() + b"\n"


def test_running_profile_of_a_tailed_cache(spark, tmp_path):
    """Broken lines are skipped; totals of the stream are those of the batch plan at every point."""
    path, base = str(tmp_path / "cache.jsonl"), str(tmp_path / "out")
    append(path, record("A", "ab") + b"{broken\n\n" + record("B", "a", " told ") + record("C", "bbb")[:20])
    totals = monitor.running_profile(tail.tail_records(spark, path))
    for packets, pages, hidden in ((2, 3, 1), (4, 7, 1)):
        sink.start(totals, base, "complete").awaitTermination()
        got = sink.read_once(spark, base, totals.schema, last=True).first()
        assert (got["packets"], got["pages"], got["injected_packets"], got["empty_pages"]) == (packets, pages, hidden, packets)
        append(path, record("C", "bbb")[20:] + record("D", "a"))
    batch = monitor.profile(spark.createDataFrame([("A", "ocr"), ("A", "text"), ("B", "ocr")], "case_id string, source string").select(
        "*", F.lit("a").alias("doc_type"), F.array().cast("array<string>").alias("lines"), F.array().cast("array<string>").alias("ocr_lines"), F.array().cast("array<string>").alias("second_lines"), F.lit("").alias("hidden_text")))
    assert set(batch.columns) == set(totals.columns)


class Killed(Exception):
    pass


@pytest.mark.parametrize("when", ["half", "written", "published"])
def test_a_killed_batch_is_run_again(spark, tmp_path, when):
    """Killed while its rows are written, before its manifest, and after it: no row is lost or there twice."""
    source, base = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    append(str(source / "f"), b"".join(b"%d\n" % i for i in range(50)))
    killed = []

    def dying(batch, number):
        if number == 1 and not killed:
            killed.append(when)
            if when == "half":
                batch.limit(3).write.parquet(f"{base}/batch-000000000001-left")
            elif when == "written":
                batch.write.parquet(f"{base}/batch-000000000001-left")
            else:
                sink.write_once(base)(batch, number)
            raise Killed
        sink.write_once(base)(batch, number)

    def go():
        lines = tail.tail(spark, str(source), 16)
        query = lines.writeStream.option("checkpointLocation", f"{base}/_state").trigger(availableNow=True).foreachBatch(dying).start()
        query.awaitTermination()

    go()
    append(str(source / "f"), b"".join(b"%d\n" % i for i in range(50, 120)))
    with pytest.raises(Exception, match="Killed"):
        go()
    append(str(source / "f"), b"".join(b"%d\n" % i for i in range(120, 130)))
    go()  # the batch that was killed, with the bytes that it had
    go()
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("line", T.StringType())])
    assert sorted(int(r["line"]) for r in sink.read_once(spark, base, schema).collect()) == list(range(130))
    assert sink.sweep(spark, base) == (when != "published")
    assert sink.read_once(spark, base, schema).count() == 130
    assert not sink.publish(spark, base, 1, "another")


def test_an_empty_sink(spark, tmp_path):
    assert sink.read_once(spark, str(tmp_path / "none"), T.StructType([T.StructField("a", T.LongType())])).count() == 0
    assert sink.sweep(spark, str(tmp_path / "none")) == 0


def plain_rates(polls, n=60):
    out, seen = {}, {}
    for key, at, tie in sorted(polls, key=lambda p: p[1:]):
        seen.setdefault(key, []).append(at)
        last = seen[key][-n:]
        out[tie] = (len(seen[key]), (len(last) - 1) / (last[-1] - last[0]) * 60 if last[-1] > last[0] else None)
    return out


def test_rates_across_batches(spark, tmp_path):
    """Batches after one another equal one pass; late polls are told and leave the state alone; ties follow their tie."""
    rng = random.Random(6)
    polls = [(rng.choice("ab"), rng.randrange(0, 4000), i) for i in range(600)]
    polls.sort(key=lambda p: (p[1], p[2]))
    source, base = tmp_path / "in", str(tmp_path / "out")
    schema = "k string, at timestamp, id long"
    frame = lambda rows: spark.createDataFrame([(k, at, i) for k, at, i in rows], "k string, at long, id long").withColumn("at", F.timestamp_seconds("at"))
    steps = [polls[:70], polls[70:71], polls[71:400], polls[400:]]
    late = [("a", polls[69][1] - 1, 9001), ("b", -5, 9002)]
    for i, step in enumerate(steps):
        frame(step + (late if i == 2 else [])).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        rated = rates.trailing_rates(stream, "at", "k", "id", reference=4.0)
        sink.start(rated, base).awaitTermination()
    got = {r["id"]: r for r in sink.read_once(spark, base, rated.schema).collect()}
    want = plain_rates(polls)
    assert {i for i, r in got.items() if r["late"]} == {9001, 9002} and got[9001]["per_minute"] is None and got[9002]["n"] is None
    state = {}
    for k, _, i in polls:
        n, rate = want[i]
        assert got[i]["n"] == n and (got[i]["per_minute"] is None) == (rate is None)
        if rate is None:
            assert got[i]["alert"] is None and not got[i]["changed"]
            continue
        assert abs(got[i]["per_minute"] - rate) < 1e-9
        alert = abs(rate - 4.0) / 4.0 > 0.2
        assert got[i]["alert"] == alert and got[i]["changed"] == (alert != state.get(k, False))
        state[k] = alert


def test_trigger_every_so_often(spark, tmp_path):
    append(str(tmp_path / "f"), b"a\n")
    query = sink.start(tail.tail(spark, str(tmp_path / "f")), str(tmp_path / "out"), every="1 second")
    try:
        for n, more in ((1, b"b\n"), (2, b"")):
            for _ in range(60):
                if os.path.exists(tmp_path / "out" / "_manifests") and len(sink.committed(spark, str(tmp_path / "out"))) >= n:
                    break
                query.processAllAvailable()
            append(str(tmp_path / "f"), more)
        query.processAllAvailable()
    finally:
        query.stop()
    lines = sink.read_once(spark, str(tmp_path / "out"), T.StructType([T.StructField("line", T.StringType())]))
    assert sorted(r["line"] for r in lines.collect()) == ["a", "b"]
