from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from palisade.llm.langid import LEAST_SCORE, fit_language_network
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA
from tests.llm import test_langid, test_leaks, test_mixing, test_near, test_tokenfiles


def columns(df):
    return [tuple(r) for r in df.collect()]


def test_stages_equal_brute_force(spark):
    """Each stage against plain code, on what the stage before it kept."""
    workspace = Workspace(spark, "test")
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").limit(400)
    odd = spark.createDataFrame([(5001, None, "en", "src1", 0), (5002, "12 34", None, "src2", 5), (5003, "", "en", None, 0)], docs.schema)
    docs = workspace.write(docs.unionByName(odd), "documents")
    items = columns(spark.read.parquet(f"{TEST_DATA}/benchmark.parquet").select("item_id", "text"))

    network = fit_language_network(docs)
    for name, stage in corpus_pipeline.STAGES:
        before = columns(docs.select("doc_id", "text", "source"))
        out = workspace.write(stage(spark, docs, TEST_DATA), name)
        if name != "token_files":
            assert out.columns == docs.columns
            whole = {r.doc_id: r for r in docs.collect()}
            assert all(whole[r.doc_id] == r for r in out.collect())
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        if name == "language_id":
            found = {i: test_langid.brute(network, t) for i, t, _ in before}
            want = Counter(i for i, (lang, score) in found.items() if lang != "und" and score >= LEAST_SCORE)
        elif name == "near_dedup":
            want = Counter(i for i, _, _, kept in test_near.brute([(i, t) for i, t, _ in before]) if kept)
        elif name == "decontaminate":
            want = Counter(i for i, *_, leaky in test_leaks.brute([(i, t) for i, t, _ in before], items) if not leaky)
        elif name == "mix_sources":
            sizes, target = test_mixing.wanted(before)
            took, largest = Counter(), Counter()
            for i, text, source in before:
                assert ids[i] <= 2
                took[source] += ids[i] * test_mixing.words(text)
                largest[source] = max(largest[source], test_mixing.words(text))
            assert all(abs(took[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
            want = ids
        else:
            want = Counter(i for i, _, _ in before)
            rows = sorted(out.collect(), key=lambda r: r.start)
            tokenizer, start, texts = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), 0, dict((i, t) for i, t, _ in before)
            assert [r.doc_id for r in rows] == sorted(ids.elements())
            for r in rows:
                found = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
                crc = test_tokenfiles.zlib.crc32(np.array(found, "<u4").tobytes())
                assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(found), crc)
                start += len(found)
        assert ids == want, name
        docs = out


def test_empty_table(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TEST_DATA)
        assert docs.collect() == []
        docs = docs if "text" in docs.columns else None


def test_odd_rows_and_columns(spark):
    """Repeated rows, null ids, a very long text, and columns named like the operators' own."""
    long = " ".join(f"der hund {i} lag unter dem tisch" for i in range(30_000))
    rows = [(1, "the cat sat on the mat " * 9, "en", "a", 1, 5), (1, "the cat sat on the mat " * 9, "en", "a", 1, 5), (2, long, "de", "b", 2, 6),
            (None, "ein hund und noch ein hund", "de", None, 3, 7), (None, None, None, None, 4, 8), (3, "", "en", "a", 5, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, doc_key int, score int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = Workspace(spark, "test").write(stage(spark, docs, TEST_DATA), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "doc_key", "score"]
        if name == "near_dedup":
            assert sorted(r.doc_key for r in docs.collect()) == [1, 2, 3]
    assert {r.doc_key for r in docs.collect()} <= {1, 2, 3}
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, TEST_DATA)
    assert tokens.count() == docs.count()
