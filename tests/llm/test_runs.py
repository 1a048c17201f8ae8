import hashlib
import random
import zlib

import numpy as np
import pytest

from flowmedallion.llm.queries import QUERIES
from flowmedallion.llm.runs import agreement, recompress, runs_of, with_runs


def brute(words):
    """(start, length, period) of every run, by start and period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(6, 4 * q):
                found.setdefault((start, end + q - start), q)
            start = max(end, start + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(draw):
    """Words with repetitions of all kinds: within each other, side by side, overlapping."""
    few, parts = draw.choice((1, 2, 3, 5, 50)), []
    for _ in range(draw.randrange(6)):
        part = [draw.randrange(few) for _ in range(draw.randrange(1, 8))]
        parts += part * draw.randrange(1, 9) if draw.random() < 0.7 else part
        if draw.random() < 0.3:
            parts = parts + parts
    return parts


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed):
    draw = random.Random(seed)
    for _ in range(40):
        texts = [np.array(periodic(draw), dtype=np.int64) for _ in range(draw.randrange(1, 12))]
        text, *columns = (x.tolist() for x in runs_of(texts))
        found = {}
        for k, *run in zip(text, *columns):
            found.setdefault(k, []).append(tuple(run))
        assert [found.get(k, []) for k in range(len(texts))] == [brute(t.tolist()) for t in texts]


def test_fibonacci_and_binary_words():
    one, other = [0], [0, 1]
    while len(other) < 400:
        one, other = other, other + one
    draw = random.Random(3)
    texts = [np.array(t) for t in (other, [draw.randrange(2) for _ in range(700)], [7] * 500, [0, 1] * 300 + [0])]
    text, *columns = (x.tolist() for x in runs_of(texts))
    found = list(zip(text, *columns))
    assert found == [(k, *run) for k, t in enumerate(texts) for run in brute(t.tolist())]
    assert (2, 0, 500, 1) in found and (3, 0, 601, 2) in found


def test_agreement_on_the_grammar():
    draw = np.random.default_rng(5)
    words = np.concatenate([[9], np.repeat(draw.integers(0, 3, 300), draw.integers(1, 6, 300)), draw.integers(0, 2, 300), [10]])
    levels = recompress(words)
    assert len(levels[-1].child) == 2 and any(not x.pairs for x in levels) and any(x.pairs for x in levels)
    i, j = draw.integers(1, len(words), (2, 4000))
    i, j = i[i != j], j[i != j]
    plain, mirrored = words.tolist(), words.tolist()[::-1]
    for sequence, found in ((plain, agreement(levels, i, j)), (mirrored, agreement([x.mirrored() for x in levels], i, j))):
        for a, b, n in zip(i.tolist(), j.tolist(), found.tolist()):
            assert sequence[a : a + n] == sequence[b : b + n]
            assert max(a, b) + n == len(words) or sequence[a + n] != sequence[b + n]


def brute_query(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs)).hexdigest(),
    )


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        own = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert own == brute_query(r.doc_id, docs[r.doc_id])


def test_odd_rows(spark, odd_docs, no_docs):
    out = with_runs(odd_docs.withColumnRenamed("at", "runs"))
    assert out.columns.count("runs") == 1 and out.count() == odd_docs.count()
    assert all(r.collapsed == "" and r.runs == [] for r in out.filter("text is null or trim(text) = ''").collect())
    assert with_runs(no_docs).count() == 0
    texts = ["a b " * 3, "a b " * 4, "x " * 5, "x\t" * 6, "é é " * 6, "q " + "w e r " * 2000 + "z", "la " * 100_000]
    rows = with_runs(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)).collect()
    found = {r.text: ([tuple(x) for x in r.runs], r.collapsed) for r in rows}
    assert [found[t] for t in texts] == [
        ([], "a b a b a b"), ([(0, 8, 2)], "a b"), ([], "x x x x x"), ([(0, 6, 1)], "x"), ([(0, 6, 1)], "é é"),
        ([(1, 6000, 3)], "q w e r z"), ([(0, 100_000, 1)], "la"),
    ]
