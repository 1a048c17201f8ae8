import numpy as np
import pytest

from flowmedallion.llm.quality import BASE, STATISTICS, fit_rules, judge, keep_good, learn, text_statistics
from flowmedallion.llm.queries import QUERIES


def brute(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


@pytest.mark.parametrize(
    "text",
    [None, "", "  \n", "a", "a a a a", "x y z x y z q", "é ü b c d", "one\none\n\none \n", "#a *b$ <|> x\x0by\x0cz", "a b c a b d a b c"],
)
def test_statistics(text):
    assert text_statistics(None if text is None else text.encode())[:5] == brute(text)


def test_learns_separable_rules():
    draw = np.random.default_rng(3)
    x = draw.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.2) & (x[:, 2] > 0.5))
    rules = learn(x, bad, ["symbol_share", "mean_word", "echo_share"])
    hit = np.zeros(len(x), dtype=bool)
    for rule in rules.rules:
        inside = np.ones(len(x), dtype=bool)
        for c in rule:
            value = x[:, ["symbol_share", "mean_word", "echo_share"].index(c.name)]
            inside &= (value > c.cut) if c.above else (value <= c.cut)
        hit |= inside
    assert len(rules.rules) >= 2 and (hit == bad).mean() > 0.97


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_quality_rules"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        got = tuple(r[name] for name in BASE)
        assert got == brute(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op1_quality_rules"](spark, folder).join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in judged]) > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (None, 0), (6, None), (9, 0)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        kept = keep_good(odd_docs, given)
        assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {4}
        assert keep_good(no_docs, given).count() == 0
    out = judge(odd_docs, fit_rules(odd_docs, labels))
    assert out.count() == odd_docs.count() and set(STATISTICS) < set(out.columns)
    empty = out.filter("text is null or doc_id = 3").collect()
    assert all(r[name] == 0 for r in empty for name in STATISTICS) and not any(r.kept for r in empty)
