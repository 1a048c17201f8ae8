import zlib

import numpy as np

from flowmedallion.llm.language import choose, keep_known, learn_languages, letters, mix, with_languages
from flowmedallion.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op2_language_id"](spark, folder).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def brute_em(likely, start, rounds=12, prior=0.5):
    shares = start / start.sum()
    for _ in range(rounds):
        mass = np.full(len(start), prior)
        for word in likely:
            joint = word * shares
            mass += joint / joint.sum()
        shares = mass / mass.sum()
    return shares


def test_em_equals_brute_force():
    draw = np.random.default_rng(1)
    sizes = np.array([3, 1, 40])
    likely = draw.random((3, sizes.sum())) ** 4
    start = np.array([0.5, 0.3, 0.2])
    shares, _ = mix(likely, sizes, np.ones((3, 3)), start)
    at = 0
    for i, n in enumerate(sizes):
        assert np.allclose(shares[:, i], brute_em(likely[:, at : at + n].T, start))
        at += n


def test_set_of_a_mixed_text():
    pure = np.tile([[1.0], [1e-4], [1e-4]], 60)
    mixed = np.concatenate([pure[:, :30], pure[[1, 0, 2], :30]], axis=1)
    best, _ = choose(np.concatenate([pure, mixed], axis=1), np.array([60, 60]), np.full(3, 1 / 3))
    assert (best[:, 0] > 0).tolist() == [True, False, False]
    assert (best[:, 1] > 0).tolist() == [True, True, False] and abs(best[0, 1] - 0.5) < 0.02


def test_letters():
    assert letters("² ½ 12 _ !".encode()) == [] and letters("Émile x2y ²".encode())[:1] == ["émile"]


def test_odd_rows(odd_docs, no_docs):
    model = learn_languages(odd_docs)
    assert model.names == ("de", "en", "fr")
    out = {(r.doc_id, r.text): r for r in with_languages(odd_docs, model).collect()}
    for key in ((2, None), (None, None), (3, ""), (5, " \n\t "), (6, "123 456 !!")):
        assert out[key].lang_pred == "und" and out[key].score == 0
    kept = keep_known(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} <= {1, None, 4, 7}
    assert keep_known(no_docs).count() == 0
    nothing = learn_languages(no_docs)
    assert {r.lang_pred for r in with_languages(odd_docs, nothing).collect()} == {"und"}


def test_short_clean_texts_stay_among_many_languages(spark):
    texts = {f"l{i:02}": " ".join(chr(0x4E00 + 30 * i + k) * 3 for k in range(12)) for i in range(40)}
    rows = [(n, text, lang) for n, (lang, text) in enumerate((lang, text) for lang, text in texts.items() for _ in range(8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert keep_known(docs).count() == len(rows)
