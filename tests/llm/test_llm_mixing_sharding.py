"""Operators 2 and 3."""

from __future__ import annotations

import re
import zlib

import pytest

from playmart.llm import kd_sharding, mixing


def water_fill(sizes: dict, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed, left = 1.5 * sum(sizes.values()), {}, set(order)
    while left:
        share = (total - sum(fixed.values())) / sum(w[s] for s in left)
        over = {s for s in left if share * w[s] > 2 * sizes[s]}
        if not over:
            return fixed | {s: share * w[s] for s in left}
        fixed |= {s: 2.0 * sizes[s] for s in over}
        left -= over
    return fixed


def test_targets_and_copies(spark, unique_docs):
    rows = unique_docs.collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    by_source = {}
    for r in rows:
        by_source[r.source] = by_source.get(r.source, 0) + size[r.doc_id]
    want = water_fill(by_source)
    out = mixing.copies(mixing.sized(unique_docs)).collect()
    assert len(out) == len(rows)
    taken = {}
    for r in out:
        assert r.size == size[r.doc_id] and r.source_size == by_source[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    largest = max(size.values())
    assert all(abs(taken[s] - want[s]) <= max(0.1 * want[s], largest) for s in want)
    again = {r.doc_id: r.copies for r in mixing.copies(mixing.sized(unique_docs.repartition(5))).collect()}
    assert again == {r.doc_id: r.copies for r in out}
    mixed = mixing.mix(spark, unique_docs)
    assert mixed.columns == unique_docs.columns
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {r.doc_id: r.copies for r in out if r.copies}


def test_mix_of_nothing(spark, no_docs):
    assert mixing.copies(mixing.sized(no_docs)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, "x y", None)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.size, r.copies) for r in mixing.copies(mixing.sized(empty)).collect()}
    assert got[1] == (0, 0) and got[None][0] == 2


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_balance_and_keep_equal_texts(spark, docs, rows, shards):
    out = kd_sharding.numbered(kd_sharding.shard(docs, shards)).collect()
    assert len(out) == len(rows)
    load, slots, group = {}, {}, {}
    for r in out:
        load[r.shard] = load.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = {}
    for _, t, *_ in rows:
        sizes[t or ""] = sizes.get(t or "", 0) + len((t or "").encode()) + 1
    for r in out:
        group.setdefault((r.k1, r.k2), set()).add(r.shard)
    assert all(len(s) == 1 for s in group.values()) and len(group) == len(sizes)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(load) <= set(range(shards))
    if shards > 1:
        assert max(load.values()) - min(load.values()) <= 2 * max(sizes.values())
    crc = {(r.doc_id, r.size): r.text_crc32 for r in out}
    assert crc == {(d, len((t or "").encode()) + 1): zlib.crc32((t or "").encode()) for d, t, *_ in rows}


def test_shards_of_nothing_and_of_one_text(spark, no_docs):
    assert kd_sharding.numbered(kd_sharding.shard(no_docs)).count() == 0
    same = spark.createDataFrame([(i, "same") for i in range(20)], "doc_id long, text string")
    assert len({r.shard for r in kd_sharding.shard(same).collect()}) == 1
