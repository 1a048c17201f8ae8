import inspect

import numpy as np
import pytest
import sentencepiece
from test_decontaminate import brute as shingles
from test_quality import brute as statistics
from test_simhash import brute_classes, brute_print

import __spark_entry__ as entry
import corpus_pipeline
from flowmedallion.llm.queries import QUERIES, SQL, piece_model


def test_eleven_queries_are_registered():
    names = entry.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 11)) and names["pipeline"] is corpus_pipeline.run
    assert set(SQL) <= set(QUERIES) and all(len(inspect.signature(run).parameters) == 2 for run in QUERIES.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "test_items", "pieces"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], sf_dir).write.parquet(f"{folder}/{name}")
        kept.append(spark.read.parquet(f"{folder}/{name}"))
    return [(frame.columns, {r.doc_id: r for r in frame.collect()}) for frame in kept]


def test_stages_keep_columns_and_rows(stages):
    columns, before = stages[0]
    for names, rows in stages[1:-1]:
        assert names == columns and set(rows) < set(before) | {None} and all(rows[i] == before[i] for i in rows)
        before = rows
    assert stages[-1][0] == [*columns, "ids", "decoded", "n_tokens"] and set(stages[-1][1]) == set(before)


def test_decisions_equal_brute_force(spark, sf_dir, stages):
    docs, language, quality, unique, clean, last = (rows for _, rows in stages)
    assert all(any(c.isalpha() for c in r.text) for r in language.values())
    for r in quality.values():
        n, *_, repeated = statistics(r.text)
        assert n >= 50 and 100 * repeated <= 50 * n
    ids = sorted(quality)
    roots = brute_classes([brute_print(quality[i].text) for i in ids])
    assert sorted(unique) == [ids[k] for k, root in enumerate(roots) if root == k]
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, r in unique.items() if any(s and 10 * len(s & shingles(r.text)) >= 8 * len(s) for s in items)}
    assert set(clean) == set(unique) - leaks
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for r in last.values():
        assert np.frombuffer(r.ids, "<u4").tolist() == [1, *library.encode(r.text), 2] and r.n_tokens == len(r.ids) // 4
        assert r.decoded == r.text.replace("▁", " ")


def test_clean_documents_stay(spark, sf_dir, stages):
    docs, language, quality = (rows for _, rows in stages[:3])
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").collect()}
    fit = {i for i in good & set(docs) if statistics(docs[i].text)[0] >= 50 and 2 * statistics(docs[i].text)[4] <= statistics(docs[i].text)[0]}
    assert len(fit & set(quality)) >= 0.98 * len(fit)


def test_run_and_odd_rows(spark, sf_dir, stages, odd_docs, no_docs):
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(stages[-1][1])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf_dir)
        assert out.count() <= odd_docs.count() and (name == "pieces" or out.columns == odd_docs.columns)
        assert stage(spark, no_docs, sf_dir).count() == 0
