import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from palisade.llm.hmm import HiddenMarkov, Vocabulary, _encode, baum_welch, count_words, read_vocabulary, score_texts
from palisade.llm.langid import fold_of
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", text), None]


def brute(rows):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows}
    counts = Counter(t for i, text in rows if not held[i] for t in tokens(text))
    total = sum(counts.values())
    out = []
    for i, text in rows:
        found = tokens(text)
        score = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in found)
        out.append((i, held[i], len(found), sum(counts[t] > 0 for t in found), total, score))
    return sorted(out, key=str)


ROWS = [(i, f"The cat {i % 3} sat\x0bon THE mat é É " * (i % 5)) for i in range(40)] + [
    (100, None), (101, ""), (102, "unseen words only \x1c x"), (103, "long " * 30_000), (None, "null id"), (7, "again"), (7, "again")]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
@pytest.mark.parametrize("head", [4, 65_000])
def test_base_equals_brute_force(spark, rows, head):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, row int, word int")
    got = sorted((tuple(r) for r in score_texts(docs, Workspace(spark, "test"), head=head, warm=1, full=1).collect()), key=str)
    want = brute(rows)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)
    assert all(r[6] < 1e-9 and math.isfinite(r[6]) for r in got)


def small_model():
    voc = Vocabulary({b"a": 0, b"b": 1}, np.array([5, 3]), 14, 4, 2)
    return voc, HiddenMarkov.random(voc, 3)


def test_likelihood_equals_all_paths():
    _, model = small_model()
    texts = [[0, 1, 2, 3], [3], [1, 1, 0, 2, 0, 3]]
    got = model.log10_likelihood(np.concatenate(texts), np.array([len(t) for t in texts]))
    for text, score in zip(texts, got, strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, x in zip(path, path[1:], text[1:], strict=False):
                p *= model.move[a, b] * model.emit[x, b]
            total += p
        assert math.isclose(score, math.log10(total), rel_tol=1e-9)


def test_symbols_have_probability_one():
    voc, model = small_model()
    pairs = [[a, b] for a in range(voc.size) for b in range(voc.size)]
    scores = model.log10_likelihood(np.concatenate(pairs), np.full(len(pairs), 2))
    assert math.isclose((10**scores).sum(), 1, rel_tol=1e-9)
    # the shares of rare words, an unseen one included, add up to one as well
    assert math.isclose(voc.rare_total, (14 - 2 - 8) + 0.1 * 3)


def test_expected_counts_equal_all_paths():
    voc, model = small_model()
    text, v = [0, 2, 1, 3], voc.size
    counts = np.zeros((v + 6, 3))
    model.expected_counts(np.array(text), np.array([4]), np.array([True]), counts)
    want, total = np.zeros_like(counts), 0.0
    for path in product(range(3), repeat=4):
        p = model.start[path[0]] * model.emit[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:], strict=False):
            p *= model.move[a, b] * model.emit[x, b]
        total += p
        for x, s in zip(text, path, strict=True):
            want[x, s] += p
        for a, b in zip(path, path[1:], strict=False):
            want[v + a, b] += p
        want[v + 3, path[0]] += p
    assert np.allclose(counts[:-2], want[:-2] / total)


def test_training_helps_held_out_texts(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").withColumn("held_out", fold_of("doc_id", 10) == 0)
    workspace = Workspace(spark, "test")
    counted = workspace.write(count_words(docs.filter("NOT held_out")), "counts")
    voc = read_vocabulary(docs.filter("NOT held_out"), counted)
    encoded = workspace.write(_encode(docs.select("doc_id", "text", "held_out"), voc), "encoded")
    model, history = baum_welch(encoded.filter("NOT held_out"), voc, workspace)
    assert history[-1] > history[-2]
    rows = [np.frombuffer(r.symbols, np.uint16) for r in encoded.filter("held_out").collect()]
    sizes = np.array([len(r) for r in rows])
    single = np.log10(voc.unigrams())
    assert model.log10_likelihood(np.concatenate(rows), sizes).sum() > single[np.concatenate(rows)].sum()


def test_words_beyond_the_head_have_emissions_of_their_own(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").select("doc_id", "text").filter("doc_id % 4 = 0")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in ROWS if i is not None], "doc_id bigint, text string"))
    few, all_ = (sorted((tuple(r) for r in score_texts(docs, Workspace(spark, "test"), head=head, warm=1, full=2).collect()), key=str) for head in (40, 65_000))
    assert [r[:5] for r in few] == [r[:5] for r in all_]
    assert np.allclose([r[5:] for r in few], [r[5:] for r in all_], rtol=1e-7)


def test_rounds_count_all_documents_and_empty_folds_change_nothing(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat", False)], "doc_id bigint, text string, held_out boolean").coalesce(1)
    workspace = Workspace(spark, "test")
    voc = read_vocabulary(docs, workspace.write(count_words(docs), "counts"))
    encoded = workspace.write(_encode(docs, voc), "encoded")
    model, _ = baum_welch(encoded, voc, workspace, warm=8, full=0)  # seven folds are empty
    assert np.ptp(model.emit, axis=1).max() > 1e-3
    _, history = baum_welch(encoded, voc, workspace)
    assert len(history) == 10 and all(b >= a - 1e-3 for a, b in zip(history, history[1:], strict=False)) and min(map(abs, history)) > 0


def test_sizes_of_blocks_and_buckets_change_nothing(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").select("doc_id", "text").filter("doc_id % 4 = 0")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in ROWS if i is not None], "doc_id bigint, text string"))
    sizes = ({"block_tokens": 2_000, "bucket_words": 50}, {})
    many, one = (sorted((tuple(r) for r in score_texts(docs, Workspace(spark, "test"), head=40, warm=1, full=2, **s).collect()), key=str) for s in sizes)
    assert [r[:5] for r in many] == [r[:5] for r in one]
    assert np.allclose([r[5] for r in many], [r[5] for r in one], rtol=1e-12)
    # warm rounds see other folds where blocks differ, so only full rounds are held against each other
    full, again = (sorted((tuple(r) for r in score_texts(docs, Workspace(spark, "test"), head=40, full=2, **s).collect()), key=str) for s in sizes)
    assert np.allclose([r[6] for r in full], [r[6] for r in again], rtol=1e-7)


def test_old_emissions_and_counts_are_gone_before_the_next_half_of_a_round(spark):
    steps = []

    class Watched(Workspace):
        def write(self, df, name):
            out = super().write(df, name)
            out.step = name
            steps.append(name)
            return out

        def remove(self, df):
            steps.append(f"-{df.step}")
            super().remove(df)

    docs = spark.createDataFrame([(i, f"w{i} w{i % 7} common") for i in range(60)], "doc_id bigint, text string")
    score_texts(docs, Watched(spark, "test"), head=2, block_tokens=40, bucket_words=16, states=2, full=2).collect()
    assert steps[steps.index("counts-0") :] == [
        "counts-0", "-begun", "round-0", "-counts-0", "counts-1", "-round-0", "round-1", "-counts-1",
    ]
