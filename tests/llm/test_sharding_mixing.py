from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from docketry.llm import mixing, sharding

from .conftest import prose


def test_every_row_gets_one_place(make_docs, odd_rows):
    got = sharding.external_shuffle(make_docs(odd_rows), shards=4, bucket_bytes=500).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((i, t) for i, t, *_ in odd_rows)
    assert sorted(r["position"] for r in got) == list(range(len(odd_rows)))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_order_follows_the_seed_alone(make_docs):
    rows = [(i, prose(5, i), "en", "a") for i in range(200)]
    order = lambda df, **k: [r["doc_id"] for r in sharding.external_shuffle(df, bucket_bytes=2000, **k).orderBy("position").collect()]
    a, b = order(make_docs(rows, 2)), order(make_docs(rows, 7))
    assert a == b != order(make_docs(rows), seed=8)
    assert a != sorted(a)


def test_a_cell_beyond_memory_is_shuffled_in_pieces(make_docs):
    rows = [(1, "same text", "en", "a")] * 300 + [(2, "other", "en", "a")] * 5
    got = sharding.external_shuffle(make_docs(rows), bucket_bytes=64).collect()
    assert sorted(r["position"] for r in got) == list(range(305))


@pytest.mark.parametrize("bounds", [{"bucket_bytes": 300}, {"bucket_bytes": 300, "task_bytes": 1000}, {"task_bytes": 100}])
def test_bounds_follow_the_bytes(make_docs, bounds):
    rows = [(i, prose(5, i), "en", "a") for i in range(200)]
    got = sharding.external_shuffle(make_docs(rows), **bounds).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((i, t) for i, t, *_ in rows)
    assert [r["position"] for r in got] == list(range(200))  # tasks have runs of positions, in order


def test_a_shards_files_are_in_slot_order(spark, make_docs, tmp_path):
    rows = [(i, prose(5, i), "en", "a") for i in range(200)]
    sharding.write_shards(sharding.external_shuffle(make_docs(rows), shards=3, bucket_bytes=500), str(tmp_path / "out"))
    found = 0
    for shard in range(3):
        files = sorted((tmp_path / "out" / f"shard={shard}").glob("part-*.parquet"))
        slots = [s for f in files for s in pq.read_table(f)["slot"].to_pylist()]
        assert len(files) > 1 and slots == list(range(len(slots)))
        found += len(slots)
    assert found == 200


def test_empty(make_docs):
    assert sharding.external_shuffle(make_docs([])).count() == 0
    assert mixing.mix(make_docs([])).count() == 0


def water_filling(sizes, share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def test_targets(spark, make_docs, odd_rows):
    rows = odd_rows + [(100 + i, prose(40, i), "en", f"s{i % 5}") for i in range(60)] + [(900, "", "en", "wordless")]
    mixed = mixing.mix(make_docs(rows)).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")])
    want = water_filling(sizes)
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixed}
    assert {s: v[0] for s, v in got.items()} == dict(sizes)
    assert all(got[s][1] == pytest.approx(want[s]) for s in want)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert len(mixed) == len(rows) and all(0 <= r["copies"] <= 2 for r in mixed)
    for r in mixed:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1)


def test_sources_come_near_their_targets_as_one_draw_does(make_docs):
    """Within four standard deviations of independent trials with the fraction as their probability."""
    rows = [(i, prose(10 + i % 30, i), "en", f"s{i % 4}") for i in range(4000)]
    taken, target, spread = defaultdict(int), {}, defaultdict(float)
    for r in mixing.mix(make_docs(rows)).collect():
        rate = r["target"] / r["source_size"]
        taken[r["source"]] += int(r["size"]) * r["copies"]
        target[r["source"]] = r["target"]
        spread[r["source"]] += (rate % 1) * (1 - rate % 1) * int(r["size"]) ** 2
    assert all(abs(taken[s] - target[s]) <= 4 * spread[s] ** 0.5 + 1e-6 for s in target)
    assert all(abs(taken[s] / target[s] - 1) < 0.08 for s in target)


def test_a_document_has_the_chance_of_its_fraction(make_docs):
    """Over seeds, each document is drawn as often as its source's fraction says, whatever its size."""
    rows = [(i, prose(1 + i, i), "en", f"s{i % 3}") for i in range(30)]
    docs, drawn, rate = make_docs(rows, partitions=1), defaultdict(int), {}
    for seed in range(40):
        for r in mixing.decide(docs, seed=seed).collect():
            rate[r["doc_id"]] = r["target"] / r["source_size"]
            drawn[r["doc_id"]] += r["copies"] - int(rate[r["doc_id"]])
    assert all(abs(drawn[i] / 40 - x % 1) < 4.5 * (0.25 / 40) ** 0.5 for i, x in rate.items())


def test_emit(make_docs):
    rows = [(i, prose(10, i), "en", "a") for i in range(50)]
    docs = make_docs(rows)
    mixed = mixing.mix(docs)
    out = mixing.emit(mixed)
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({r["doc_id"]: r["copies"] for r in mixed.collect() if r["copies"]})
    assert "text" in out.columns and "copies" not in out.columns


def test_sources_beyond_the_broadcast_bound(make_docs, monkeypatch):
    rows = [(i, prose(10, i), "en", f"s{i}") for i in range(40)] + [(99, "a b", "en", None)]
    want = {r["doc_id"]: (r["target"], r["copies"]) for r in mixing.mix(make_docs(rows)).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3)
    assert {r["doc_id"]: (r["target"], r["copies"]) for r in mixing.mix(make_docs(rows)).collect()} == want
