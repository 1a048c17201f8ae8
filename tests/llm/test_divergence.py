import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmedallion.llm import divergence as D
from flowmedallion.llm.queries import QUERIES, SQL


def brute(rows, min_docs=30, top=50):
    groups, docs = {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.setdefault((lang, source), Counter()).update(words)
        docs.setdefault(lang, Counter()).update(set(words))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = sum(own.values(), Counter())

        def shares(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (size + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def corpus(groups, docs, words, seed):
    draw = random.Random(seed)
    vocabulary = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}é" for k in range(words)]
    rows = []
    for _ in range(docs):
        own = min(int(draw.expovariate(0.5)), groups - 1) if draw.random() < 0.7 else draw.randrange(groups)
        some = draw.sample(vocabulary[own * 3 % words // 2 :], min(12, words // 2))
        rows.append((draw.choice(("x", "x", "y")), f"s{own}", " ".join(draw.choice(some) for _ in range(draw.randrange(60)))))
    return rows


@pytest.mark.parametrize("tile, block, leaf", [(256, 4096, 8), (3, 5, 2), (16, 40, 4), (5, 4096, 8)])
def test_tiles_and_blocks(spark, monkeypatch, tile, block, leaf):
    for name, value in (("TILE", tile), ("BLOCK", block), ("LEAF", leaf), ("ENTRIES", 50), ("CELLS", 7)):
        monkeypatch.setattr(D, name, value)
    rows = corpus(21, 500, 60, tile) + [("z", "alone", "one two"), ("z", "other", None), ("w", "single", "a b")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    found = sorted(tuple(r) for r in D.audit(docs, min_docs=9, top=4).collect())
    expected = brute(rows, 9, 4)
    assert found == expected and len(expected) > 400
    assert ("z", "alone", "pair", "other", 0, 1) in found and not any(r[0] == "w" for r in found)


def test_joint_walk_against_all_cells():
    draw = np.random.default_rng(4)
    for side, width in ((8, 8), (16, 64), (32, 32)):
        trees, dense = [], []
        for _ in range(2):
            full = draw.random((side, width)) < 0.02
            full[:, width // 2 :] &= draw.random((side, 1)) < 0.1
            row, column = np.nonzero(full)
            count, sizes = draw.integers(1, 90, len(row)), draw.integers(1, 10**6, side)
            trees.append(D.Quadtree(row, column, count, sizes, side, width))
            table = np.zeros((side, width), dtype=np.int64)
            table[row, column] = count
            dense.append(np.stack([D.shares(t, np.full(width, s)) for t, s in zip(table, sizes)]))
        expected = np.abs(dense[0][:, None] - dense[1][None]).sum(axis=2)
        assert (D.joint_walk(*trees, False) == expected).all()
        own = np.abs(dense[0][:, None] - dense[0][None]).sum(axis=2)
        assert (np.triu(D.joint_walk(trees[0], trees[0], True)) == np.triu(own)).all()


def test_shares_are_exact(spark):
    draw = random.Random(1)
    cases = [(0, 5), (0, 10**15), (10**12, 10**12 + 5), (8 * 10**15, 8 * 10**15 + 5)] + [(draw.randrange(10**13), 10**13 + draw.randrange(10**12)) for _ in range(50)]
    rows = spark.createDataFrame(cases, "c long, n long").select("c", "n", D.share(F.col("c"), F.col("n")).alias("p")).collect()
    for r in rows:
        exact = 1 + 10**9 * (r.c + 5) // r.n
        assert r.p == exact and D.shares(np.array([r.c]), np.array([r.n]))[0] == exact


def test_query(spark, sf_dir):
    rows = [(r.lang, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_source_divergence"](spark, sf_dir).collect()) == brute(rows)
    assert "op13_source_divergence" in SQL


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    found = sorted(tuple(r) for r in D.audit(odd_docs.withColumn("term", F.lit(1)).withColumn("rank", F.lit(2)), min_docs=1, top=5).collect())
    assert found == brute(rows, 1, 5) and D.audit(no_docs).count() == 0
