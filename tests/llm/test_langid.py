import numpy as np

from palisade.llm.langid import BATCH, ByteNetwork, cut, fit_language_network, language_digest, predict_language, sample_windows, train, with_known_language
from tests.conftest import TEST_DATA


def plain(net, windows):
    n, pooled = windows.shape[1], []
    for f, b in zip(net.filters, net.bias, strict=True):
        spread = np.stack([net.embedding[windows[:, j : n - len(f) + 1 + j]] for j in range(len(f))], axis=2)
        pooled.append((np.einsum("bpje,jef->bpf", spread, f) + b).max(axis=1))
    x = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.output + net.offset
    p = np.exp(x - x.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def brute(net, text):
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0
    windows, _, sizes = cut([text.encode()])
    mean = (plain(net, windows) * sizes[:, None]).sum(axis=0) / sizes.sum()
    return net.languages[mean.argmax()], float(mean.max())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_digest(docs).collect()
    assert len(rows) == len(known)
    held = [r for r in rows if r.held_out and known[r.doc_id] is not None and r.lang_pred != "und"]
    right = sum(r.lang_pred == known[r.doc_id] for r in held) / len(held)
    assert len(held) > 100 and right >= 0.95, right
    assert all(0 <= r.score <= 1 for r in rows)


def test_windows_hold_every_byte():
    texts = [b"", b"abc", b"x" * 300, b"y" * 256]
    windows, of, sizes = cut(texts, 128)
    assert of.tolist() == [1, 2, 2, 2, 3, 3] and sizes.tolist() == [3, 128, 128, 44, 128, 128]
    assert b"".join(w[:n].tobytes() for w, n in zip(windows, sizes, strict=True)) == b"".join(texts)


def test_tables_equal_the_convolution():
    draw = np.random.default_rng(1)
    windows = draw.integers(0, 256, (BATCH, 128)).astype(np.uint8)
    net: ByteNetwork = train(windows, draw.integers(0, 3, BATCH), ["a", "b", "c"], steps=3)
    assert np.allclose(net.probabilities(windows), plain(net, windows), atol=1e-4)


def test_predictions_equal_brute_force(spark):
    """Whole texts, window by window through a plain convolution."""
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").limit(150)
    net = fit_language_network(docs, per_language=40)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = predict_language(docs, net, "doc_id").collect()
    assert len(got) == len(texts)
    for r in got:
        name, score = brute(net, texts[r.doc_id])
        assert r.lang_pred == name and abs(r.score - score) < 1e-3


def test_odd_rows(spark):
    rows = [(1, "the cat sat on the mat " * 9, "en", "x"), (2, "der hund lag unter dem tisch " * 9, "de", "x"), (3, None, "de", "x"),
            (4, "", "en", "x"), (5, "123 ... ½²", "en", "x"), (None, "the mat", None, "x"), (6, "é", "fr", "x"), (6, "é" * 200_000, "fr", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in predict_language(docs, fit_language_network(docs), "doc_id").collect()]
    assert len(got) == len(rows) and {(i, p) for i, p, _ in got} >= {(3, "und"), (4, "und"), (5, "und"), (6, "fr")}
    assert all((p == "und") == (s == 0) for _, p, s in got)
    unlabelled = docs.filter("lang IS NULL")
    assert [r.lang_pred for r in language_digest(unlabelled).collect()] == ["und"]
    assert language_digest(docs.filter("false")).collect() == []


def test_letterless_texts_go_without_labels_too(spark):
    rows = [(1, "the mat", None), (2, None, None), (3, "", None), (4, "12 ... ½", None), (5, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in with_known_language(docs).collect()) == [1, 5]


def test_sample_is_bounded_where_rows_repeat(spark):
    docs = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "if(id % 4 = 0, 'the same text', concat('text number ', id)) AS text",
                                        "if(id % 4 = 0, 'en', 'de') AS lang")
    n = {r.lang: r["count"] for r in sample_windows(docs, per_language=50, per_doc=2).groupBy("lang").count().collect()}
    assert 50 <= n["en"] <= 100 and 50 <= n["de"] <= 100


def test_texts_of_no_one_language_go(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").limit(300)
    net = fit_language_network(docs)
    scores = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(docs, net, "doc_id").collect()}
    for least in (0.4, 0.95):
        want = sorted(i for i, (name, score) in scores.items() if name != "und" and score >= least)
        assert sorted(r.doc_id for r in with_known_language(docs, least).collect()) == want
    assert len(want) < len(scores)
