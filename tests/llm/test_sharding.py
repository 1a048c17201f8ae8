import zlib

import numpy as np

from flowmedallion.llm import sharding
from flowmedallion.llm.queries import QUERIES
from flowmedallion.llm.sharding import pack, shard_rows


def check(rows, docs):
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (d for d, _ in docs)))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op10_sharding"](spark, folder).collect()
    slots = check(rows, docs)
    text = dict(docs)
    bytes_ = np.zeros(40)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert r["size"] == len(data) + 16 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        bytes_[r.shard] += r["size"]
    assert set(slots) == set(range(40)) and bytes_.max() < 1.04 * bytes_.mean() and bytes_.min() > 0.96 * bytes_.mean()


def test_groups_stay_together_and_hot_ones_are_cut(spark, monkeypatch):
    docs = [(i, f"text {i} " + "x" * (i % 50)) for i in range(600)] + [(1000 + i, f"pair {i % 100}") for i in range(200)]
    docs += [(2000 + i, "the same everywhere") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = shard_rows(frame, shards=4).collect()
    check(rows, docs)
    text, places = dict(docs), {}
    for r in rows:
        places.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(places["the same everywhere"]) > 1 and all(len(p) == 1 for t, p in places.items() if t.startswith("pair"))
    monkeypatch.setattr(sharding, "CELL", 40)  # many cells on three levels
    monkeypatch.setattr(sharding, "SPLIT", 4)
    cells = shard_rows(frame, shards=4).collect()
    check(cells, docs)
    sizes = np.bincount([r.shard for r in cells], [r["size"] for r in cells])
    assert sizes.max() < 1.03 * sizes.mean()


def test_pack_takes_the_highest_product():
    room = np.array([[1.0, 1.0, 1.0], [0.5, 2.0, 1.0]])
    assert pack(np.array([[0.1, 0.0, 0.0], [0.0, 0.0, 0.1], [0.0, 0.0, 0.1]]), room).tolist() == [0, 0, 1]


def test_odd_rows(odd_docs, no_docs):
    rows = shard_rows(odd_docs).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sorted((r["size"], r.text_crc32) for r in rows)[:3] == [(16, 0)] * 3
    assert shard_rows(no_docs).count() == 0


def test_groups_that_fit_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 7)  # rows are numbered in many pieces
    docs = [(i, f"text {i} " + "x" * (i % 50)) for i in range(600)] + [(2000 + i, "half a shard") for i in range(150)]
    docs += [(3000 + i, "more than a shard") for i in range(500)]
    rows = shard_rows(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), shards=4).collect()
    check(rows, docs)
    text, places = dict(docs), {}
    for r in rows:
        places.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all((len(p) > 1) == (t == "more than a shard") for t, p in places.items())
    sizes = np.bincount([r.shard for r in rows], [r["size"] for r in rows])
    assert sizes.max() < 1.03 * sizes.mean()


def test_groups_without_room_are_cut():
    room = np.ones((2, 3))  # three groups of 0.6 fit in two shards only in parts
    found = sharding.spans(np.full((3, 3), 0.6), np.array([600, 600, 600]), room)
    assert [(g, n) for g, _, n, _ in found[:2]] == [(0, 600), (1, 600)] and sum(n for g, _, n, _ in found[2:]) == 600 and len(found) == 5
    assert np.abs(room[0] - room[1]).max() < 0.21
