"""Shards against a plain walk through the sorted records."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from millrace.llm import sharding
from millrace.llm.sharding import Shards
from millrace.llm.words import saved

DOCS = "doc_id long, text string, shard int, h long, size int, range int, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], DOCS).repartition(4)


def digits(text, n):
    return int(hashlib.md5(text.encode()).hexdigest()[:n], 16)


def plain_shards(rows, how):
    records = sorted(((digits(t or "", 15), digits("" if i is None else str(i), 10), i, t) for i, t in rows), key=lambda r: r[:2])
    sizes = [len((t or "").encode()) + 8 for _, _, _, t in records]
    total = sum(sizes)
    weight = Counter()
    for r, s in zip(records, sizes):
        weight[r[0]] += s
    out, before, slots, begins = [], 0, Counter(), {}
    for (h, _, i, t), s in zip(records, sizes):
        begins.setdefault(h, before)
        middle = 2 * before + s if weight[h] * how.shards * how.slack > total else 2 * begins[h] + weight[h]
        shard = min(middle * how.shards // (2 * total), how.shards - 1)
        out.append((i, s, zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        before += s
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice(("é", "one", "two", "three", "漢字")) for _ in range(n))
    found = [(i, prose(rng.randint(1, 60))) for i in range(3000)]
    hot, large = prose(40), prose(4000)
    found += [(3000 + i, hot) for i in range(1500)] + [(5000, large), (5001, large)]
    found += [(6000 + i, found[i % 7][1]) for i in range(30)] + [(7, found[7][1])] * 3
    return found + [(None, found[2][1]), (None, None), (6100, None), (6101, ""), (6102, " ")]


@pytest.mark.parametrize("how", [Shards(), Shards(shards=5, ranges=2, samples=1, slack=1), Shards(shards=7, range_bytes=2000, samples=2)])
def test_places_are_those_of_a_plain_walk(spark, rows, how):
    found = sharding.sharded(frame(spark, rows), how)
    assert Counter(map(tuple, found.select("row.doc_id", "size", "text_crc32", "shard", "slot").collect())) == plain_shards(rows, how)
    assert Counter((r.row.doc_id, r.row.text) for r in found.collect()) == Counter(rows)
    assert found.schema["row"].dataType.names == [c.split()[0] for c in DOCS.split(", ")]


def test_sizes_are_near_equal_and_light_copies_stay_together(spark, rows):
    how = Shards(shards=12, slack=20)
    found = sharding.sharded(frame(spark, rows), how, carried=["text"]).collect()
    filled, where = Counter(), {}
    for r in found:
        filled[r.shard] += r.size
        where.setdefault(r.row.text or "", set()).add(r.shard)
    goal = sum(filled.values()) / how.shards
    large = max(r.size for r in found)
    assert sorted(filled) == list(range(12)) and all(abs(x - goal) <= large + goal / how.slack for x in filled.values())
    copies = Counter()
    for r in found:
        copies[r.row.text or ""] += r.size
    assert all(len(where[t]) == 1 for t, b in copies.items() if b * how.slack <= goal)


@pytest.mark.parametrize("seed", range(3))
def test_no_range_is_overfull(spark, rows, seed):
    how = Shards(shards=6, ranges=10, samples=2, seed=seed)
    keys = saved(sharding.keyed(frame(spark, rows), "doc_id", "text", ["doc_id"]), "keys").select("h", "u", "size")
    total = sum(r.size for r in keys.collect())
    bounds = sharding.sampled_ranges(keys, total, how)
    ranges = sharding._measured(keys, bounds)
    assert sum(r.bytes for r in ranges) == total and len(ranges) > 30
    assert all(r.bytes - r.largest <= 2 * total / 60 for r in ranges)
    assert [(r.low.h, r.low.u) for r in ranges] == sorted((r.low.h, r.low.u) for r in ranges)
    assert all((a.high.h, a.high.u) < (b.low.h, b.low.u) for a, b in zip(ranges, ranges[1:]))
    assert any(u != sharding.WHOLE for _, u in bounds)


def test_copies_without_ids_are_parted_too(spark):
    rows = [(1, "the same text")] * 900 + [(2, "another")]
    how = Shards(shards=4, ranges=4)
    found = sharding.sharded(frame(spark, rows), how)
    assert Counter(map(tuple, found.select("row.doc_id", "size", "text_crc32", "shard", "slot").collect())) == plain_shards(rows, how)
    assert max(Counter(r.shard for r in found.collect()).values()) < 240


def test_no_records_and_one(spark):
    assert sharding.sharded(frame(spark, [])).collect() == []
    (one,) = sharding.sharded(frame(spark, [(1, "a")]), carried=["doc_id"]).collect()
    assert (one.row.doc_id, one.size, one.text_crc32, one.shard, one.slot) == (1, 9, zlib.crc32(b"a"), 12, 0)


def test_written_shards_hold_their_slots_in_order(spark, rows, tmp_path):
    found = sharding.sharded(frame(spark, rows), Shards(shards=3), carried=["doc_id", "text"])
    sharding.write_shards(found, str(tmp_path / "out"))
    for shard in range(3):
        files = sorted((tmp_path / "out" / f"shard={shard}").glob("*.parquet"))
        slots = [r.slot for f in files for r in spark.read.parquet(str(f)).collect()]
        assert slots == list(range(len(slots))) and len(slots) == found.where(f"shard = {shard}").count()
