import random

import numpy as np
import pytest
import xxhash

from flowmedallion.llm import simhash
from flowmedallion.llm.components import components
from flowmedallion.llm.queries import QUERIES


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_classes(prints, bits=3):
    """Print -> smallest index in its class."""
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def test_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    prints = [brute_print(text) for _, text in docs]
    roots = brute_classes(prints)
    rows = {r.doc_id: r for r in QUERIES["op5_simhash_near_dedup"](spark, sf_dir).collect()}
    for (doc_id, _), own, root in zip(docs, prints, roots):
        assert rows[doc_id].fingerprint == f"{own:016x}" and rows[doc_id].component_id == docs[root][0]


@pytest.mark.parametrize("chunk, share", [(4000, 16), (8, 1)])
def test_links_of_random_clusters(spark, monkeypatch, chunk, share):
    monkeypatch.setattr(simhash, "CHUNK", chunk)  # 8: every key of a cluster is cut into chunks
    monkeypatch.setattr(simhash, "SHARE", share)
    draw = random.Random(4)
    prints = {draw.getrandbits(64) for _ in range(150)}
    for _ in range(12):  # chains that drift apart link by link
        own = draw.getrandbits(64)
        for _ in range(20):
            prints.add(own)
            for bit in draw.sample(range(64), draw.choice((1, 2, 3, 4))):
                own ^= 1 << bit
    prints = sorted(prints)
    frame = spark.createDataFrame([(i, simhash.signed(p)) for i, p in enumerate(prints)], "doc_id long, fp long").repartition(7)
    out = {r.doc_id: r.component_id for r in simhash.classes(frame).collect()}
    assert [out[i] for i in range(len(prints))] == brute_classes(prints)


def test_pivot_filter_keeps_every_link():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, 30).astype(np.uint64)
    prints = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(9)]))
    pivots = draw.integers(0, 1 << 63, 8).astype(np.uint64)
    near = np.bitwise_count(prints ^ pivots[0]).astype(int)
    order = np.argsort(near, kind="stable")
    prints, near = prints[order], near[order]
    found = {tuple(p) for p in simhash.linked_within(np.zeros(len(prints)), prints, near, pivots, 3).tolist()}
    assert found == {(i, j) for j in range(len(prints)) for i in range(j) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 3}


def test_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 460)] + [(5, 5), (None, 3)]
    edges += [(b, a) for a, b in edges[:20]] + [(900, k) for k in range(1000, 1200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    seen = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen[x] = start
                todo += near[x]
    assert out == seen
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicate_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r.fp == 0]
    assert len(empty) == 4 and {r.component_id for r in empty} == {2}  # null, empty and blank texts
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "6", "7", "None"]
    assert simhash.keep_first(no_docs).count() == 0 and simhash.near_duplicate_classes(no_docs).count() == 0
