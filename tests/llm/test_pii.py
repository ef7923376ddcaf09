import hashlib
import re
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palisade.llm import pii
from palisade.llm.pii import Tagger, all_spans, base_spans, decode, fit_tagger, loss_and_gradients, luhn, pii_digest, tagged_spans, training_windows
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, kind == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                    13 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "b-", "1", "25", "300", " ", "+1", "(", "é", "4111111111111111", "-", "x.y", "192.168.0.1"]), max_size=14).map("".join))
def test_base_equals_the_patterns(text):
    assert base_spans(text) == brute(text)


def tiny():
    model = Tagger.random(3)
    draw = np.random.default_rng(5)
    model.move[:] = draw.normal(0, 0.7, model.move.shape)
    return model


def test_gradients():
    draw = np.random.default_rng(1)
    model, chars, tags = tiny(), draw.integers(0, 129, (3, 7)).astype(np.uint8), draw.integers(0, 5, (3, 7))
    _, grads = loss_and_gradients(model, chars, tags)
    for param, grad in zip((model.table, model.recur, model.output, model.offset, model.move), grads, strict=True):
        for at in [tuple(draw.integers(0, n) for n in param.shape) for _ in range(6)]:
            if param is model.table:
                at = (at[0], int(chars[0, 2]), at[2])
            keep, losses = param[at], []
            for step in (1e-5, -1e-5):
                param[at] = keep + step
                losses.append(loss_and_gradients(model, chars, tags)[0])
            param[at] = keep
            assert abs((losses[0] - losses[1]) / 2e-5 - grad[at]) < 1e-5


def test_scores_equal_the_trained_network(monkeypatch):
    """Windows side by side, of any length, give what one window alone gives."""
    monkeypatch.setattr(pii, "WINDOW", 40)
    monkeypatch.setattr(pii, "OVERLAP", 8)
    model = tiny()
    texts = ["", "ab@c.de and so on", "x" * 40, "12 34 " * 20]
    sizes = np.array(list(map(len, texts)))
    chars = pii.char_classes("".join(texts))
    got = model.for_scoring().text_scores(chars, sizes)

    def run(part):
        out = np.tile(model.offset, (len(part), 1))
        for d, step in ((0, 1), (1, -1)):
            h, c = np.zeros(pii.HIDDEN), np.zeros(pii.HIDDEN)
            for t in range(len(part))[::step]:
                i, f, o, g = np.split(model.table[d][part[t]] + h @ model.recur[d], 4)
                c = c / (1 + np.exp(-f)) + np.tanh(g) / (1 + np.exp(-i))
                h = np.tanh(c) / (1 + np.exp(-o))
                out[t] += h @ model.output[d]
        return out

    at = 0
    for size in sizes:
        total, cover = np.zeros((size, pii.TAGS)), np.zeros((size, 1))
        for a in range(0, max(size - 8, 1), 32) if size else ():
            total[a : a + 40] += run(chars[at + a : at + min(a + 40, size)])
            cover[a : a + 40] += 1
        assert np.allclose(got[at : at + size], total / np.maximum(cover, 1), atol=1e-4)
        at += size


def test_decoding_equals_all_paths():
    draw = np.random.default_rng(2)
    for _ in range(60):
        sizes = draw.integers(0, 6, 4)
        scores, move = draw.normal(-0.5, 1.5, (sizes.sum(), 5)), draw.normal(0, 1, (5, 5))
        tags, _ = decode(scores, move, sizes)
        at = 0
        for n in sizes:
            value = lambda path: (sum(scores[at + i, k] for i, k in enumerate(path))  # noqa: B023, E731
                                  + sum(move[a, b] for a, b in zip((0, *path), (*path, 0), strict=True)))
            best = max((value(p) for p in product(range(5), repeat=n)), default=0)
            assert n == 0 or abs(value(tuple(tags[at : at + n])) - best) < 1e-9
            at += n


def test_tagger_finds_held_out_spans(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    tagger = fit_tagger(docs.filter("doc_id % 2 = 0"), Workspace(spark, "test"))
    texts = [r.text for r in docs.filter("doc_id % 2 = 1").collect()]
    base = [{s for s in base_spans(t)} for t in texts]
    found = [set(x) for x in tagged_spans(tagger, texts)]
    hits = sum(any(k == j and a < d and c < b for j, c, d in f) for x, f in zip(base, found, strict=True) for k, a, b in x)
    assert hits >= 0.7 * sum(map(len, base))
    for old, new in zip(*all_spans(tagger, texts), strict=True):
        assert all(b <= c or d <= a for _, a, b in new for _, c, d in old)


def test_odd_rows(spark):
    long = "word " * 60_000 + "mail a.b@example.org"
    rows = [(1, None), (2, ""), (3, "é😀 +1 (843) 555-7672"), (3, "é😀 +1 (843) 555-7672"), (None, "10.0.0.1"), (4, long), (5, "7" * 50_000)]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n_ip int, spans string")
    for tagger in (None, fit_tagger(docs, Workspace(spark, "test"), steps=5)):
        got = pii_digest(docs, tagger).collect()
        for (doc_id, text), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, dict(rows).get(r.doc_id)))), strict=True):
            spans = brute(text)
            joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
            assert r.doc_id == doc_id and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
            assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert pii_digest(docs.filter("false"), None).collect() == []
    assert fit_tagger(docs.filter("false"), Workspace(spark, "test")) is None


@pytest.mark.parametrize("part, is_ip", [("0" * 5000 + "255", True), ("0" * 5000, True), ("0" * 5000 + "256", False), ("1" * 5000, False)])
def test_long_parts_of_addresses(part, is_ip):
    text = f"{part}.1.1.1"
    assert (1, 0, len(text)) in base_spans(text) if is_ip else not any(k == 1 for k, *_ in base_spans(text))


def test_sample_is_bounded_where_rows_repeat(spark):
    same = spark.range(5000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'mail me at a@b.org now' AS text")
    n = training_windows(same, sample=100).count()
    assert 100 <= n <= 500
    same_ids = spark.range(5000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "concat('call +1 555 123 4', 100000 + id) AS text")
    windows = sorted(tuple(r) for r in training_windows(same_ids, sample=100).collect())
    assert 100 <= len(windows) <= 500
    assert sorted(tuple(r) for r in training_windows(same_ids.repartition(7), sample=100).collect()) == windows
    assert training_windows(same.filter("false")).count() == 0
