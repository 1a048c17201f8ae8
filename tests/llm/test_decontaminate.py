import random
import re

from flowmedallion.llm.decontaminate import contained_items, item_shingles, keep_clean
from flowmedallion.llm.queries import QUERIES, SQL


def brute(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def test_random_overlaps(spark):
    draw = random.Random(6)
    word = lambda: f"w{draw.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(draw.choice((3, 5, 6, 9, 20, 70))))) for i in range(40)]
    docs = []
    for d in range(80):
        parts = [[word() for _ in range(draw.randrange(60))]]
        for _ in range(draw.randrange(3)):
            words = draw.choice(items)[1].split()
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = word()
            parts.append(words)
        docs.append((d, ("\n" if d % 2 else " ... ").join(" ".join(p).upper() if d % 3 else " ".join(p) for p in parts)))
    out = contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    expected = {}
    for d, text in docs:
        for i, item in items:
            need, have = brute(item), brute(text)
            if need and 10 * len(need & have) >= 8 * len(need):
                expected[d, i] = (len(need), len(need & have))
    assert len(expected) > 20 and {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in out} == expected


def test_sketch_cannot_be_missed(spark):
    items = spark.createDataFrame([(n, " ".join(f"x{n}k{k}" for k in range(n + 4))) for n in range(1, 70)], "item_id long, text string")
    for r in item_shingles(items).groupBy("item_id").agg({"n": "max", "lead": "min", "need": "min"}).collect():
        n = r["max(n)"]
        assert n == r.item_id and r["min(lead)"] >= 1 and r["min(need)"] == n - n // 5


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "has words too"), (4, "A row, without an ID has words too!"), (None, "x")], "item_id long, text string")
    found = contained_items(odd_docs, items).collect()
    assert [(r.doc_id, r.item_id, r.n_found) for r in found] == [(None, 4, 4)]
    kept = keep_clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert keep_clean(odd_docs, items.limit(0)).count() == odd_docs.count() and keep_clean(no_docs, items).count() == 0


def test_registered():
    assert "op7_benchmark_decontamination" in QUERIES and "op7_benchmark_decontamination" in SQL


def brute_any(item, text):
    words, own = ([w for w in re.split(r"[\W_]+", (t or "").lower()) if w] for t in (item, text))
    k = min(5, len(words))
    need = {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    have = {" ".join(own[i : i + k]) for i in range(len(own) - k + 1)} if words else set()
    return (len(need), len(need & have)) if need and 10 * len(need & have) >= 8 * len(need) else None


def small_case(spark):
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(25)}"
    items = [(i, " ".join(word() for _ in range(draw.choice((1, 2, 3, 4, 4, 5, 8))))) for i in range(30)] + [(None, "w1 w2 w3 w4 w5 w6"), (98, None), (99, " ")]
    docs = [(d, " ".join(word() for _ in range(draw.randrange(120)))) for d in range(40)] + [(7, "four words only here, w1 w2 w3 w4 w5 w6"), (None, items[0][1])]
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    return docs, items, frames


def test_short_items(spark, tmp_path):
    docs, items, frames = small_case(spark)
    out = contained_items(*frames, short_items=True).collect()
    expected = {(d, t, i): found for d, t in docs for i, item in items if (found := brute_any(item, t))}
    texts = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in out}
    assert texts == {(d, i, *found) for (d, _, i), found in expected.items()} and len(expected) > 60
    assert any(i is None for _, _, i in expected) and any(d is None for d, _, _ in expected)
    frames[0].write.parquet(str(tmp_path / "documents.parquet"))
    frames[1].write.parquet(str(tmp_path / "benchmark.parquet"))
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    rows = connection.execute(SQL["op7_benchmark_decontamination"]).fetchall()
    same = {r[:4] for r in rows if r[0] is not None and r[1] is not None}
    assert same == {x for x in texts if x[0] is not None and x[1] is not None and x[0] != 7} | {r[:4] for r in rows if r[0] == 7}


def test_documents_meet_the_sketch_alone(spark, monkeypatch):
    """Without the sketch's hashes nothing is found; and tables beyond the bound are joined by shuffle with the same rows."""
    from flowmedallion.llm import decontaminate

    _, _, frames = small_case(spark)
    whole = sorted(map(str, contained_items(*frames).drop("key").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, contained_items(*frames).drop("key").collect())) == whole and whole
    plain = decontaminate.item_shingles
    monkeypatch.setattr(decontaminate, "item_shingles", lambda *a, **k: plain(*a, **k).selectExpr("*", "false as none").drop("sketched").withColumnRenamed("none", "sketched"))
    assert contained_items(*frames).count() == 0
