import hashlib
import random

import pytest
from pyspark.sql import functions as F

from flowmedallion.llm import sketches as S
from flowmedallion.llm.queries import QUERIES, SQL


def brute(text, kept=S.KEPT):
    words = (text or "").lower().encode().split()
    shingles = {b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    return sorted({hashlib.md5(s).hexdigest()[:12] for s in shingles})[:kept]


def brute_near(a, b, kept=S.KEPT):
    union = sorted({*a, *b})[:kept]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def test_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    rows = {r.doc_id: r for r in QUERIES["op12_document_fingerprints"](spark, sf_dir).collect()}
    assert len(rows) == len(docs) and "op12_document_fingerprints" in SQL
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        cut, r = len(text) // 4, rows[doc_id]
        changed = text[: len(text) - cut] + following[:cut]
        own, other = brute(text), brute(changed)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(own), "".join(other))
        assert (r.near_edited, r.near_next) == (brute_near(own, other), brute_near(own, brute(following)))


@pytest.mark.parametrize("per_range", [1, 7, 1000])
def test_next_rows_across_ranges(spark, monkeypatch, per_range):
    monkeypatch.setattr(S, "RANGE_ROWS", per_range)
    draw = random.Random(2)
    ids = draw.sample(range(-500, 10**12), 60) + [3, 3, 3]
    rows = [(i, f"text {draw.randrange(10**6)}") for i in ids] + [(3, None), (None, "lone"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = S.with_next_text(docs, "doc_id", "text", {"size": F.char_length}).collect()
    order = sorted((i, t or "") for i, t in rows if i is not None)
    expected = [(i, t, len(t), f, len(f)) for (i, t), (_, f) in zip(order, order[1:] + order[:1])]
    found = [(r.doc_id, r.text, r["size"], r.next_text, r.next_size) for r in out]
    assert sorted(x for x in found if x[0] is not None) == sorted(expected)
    assert sorted(x for x in found if x[0] is None) == [(None, "", 0, None, None), (None, "lone", 4, None, None)]


def test_parts_and_groups_merge(spark):
    draw = random.Random(8)
    texts = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.choice((0, 3, 40, 400)))) for _ in range(30)]
    rows = [(k % 3 if k % 5 else None, t) for k, t in enumerate(texts)]
    made = spark.createDataFrame(rows, "part int, text string").repartition(4).withColumn("own", S.sketch(F.col("text")))
    groups = {r.part: r.own for r in S.merge_groups(made, ["part"], "own").collect()}
    for part in (0, 1, 2, None):
        assert groups[part] == sorted({h for p, t in rows if p == part for h in brute(t, 10**9)})[: S.KEPT]
    two = spark.createDataFrame([(texts[2], texts[3])], "a string, b string")
    assert two.select(S.merged(S.sketch(F.col("a")), S.sketch(F.col("b")))).first()[0] == sorted({*brute(texts[2]), *brute(texts[3])})[: S.KEPT]


def test_estimates(spark):
    words = [f"v{k}" for k in range(9000)]
    cases = [(words, words), (words, words[:4500]), (words[:4500], words), (words[:60], words[30:90]), ([], words), (words, []), ([], [])]
    frame = spark.createDataFrame([(" ".join(a), " ".join(b)) for a, b in cases], "a string, b string")
    a, b = S.sketch(F.col("a")), S.sketch(F.col("b"))
    rows = frame.select(S.resemblance(a, b).alias("j"), S.containment(a, b).alias("c"), S.distinct_shingles(a).alias("n")).collect()
    for (one, other), r in zip(cases, rows):
        x, y = ({" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in (one, other))
        assert abs(r.j - (len(x & y) / len(x | y) if x | y else 1)) < 0.13
        assert abs(r.c - (len(x & y) / len(x) if x else 1)) < 0.2 and abs(r.n - len(x)) <= 0.3 * len(x)
    assert rows[3].n == 56 and rows[3].c == 26 / 56  # small texts are exact


def test_odd_rows(odd_docs, no_docs):
    rows = S.fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r.sketch for r in rows if not r.text.strip()] == [[]] * 4
    assert all((r.next_text is None) == (r.doc_id is None) for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
    assert next(r for r in rows if r.doc_id == 7).next_text == "The same words come twice here."
    assert S.fingerprints(no_docs).count() == 0
    assert S.merge_groups(S.fingerprints(no_docs), ["doc_id"], "sketch").count() == 0


def test_only_dataframe_functions(spark, sf_dir):
    plan = QUERIES["op12_document_fingerprints"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
