import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from palisade.llm.tables import Workspace
from palisade.llm.tokenfiles import PieceEncoder, ShardReader, token_digest, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
CODER = PieceEncoder(PATH, cache_pieces=50)
PARTS = ["a", "Ab", "don't", " ", "  ", "\n", "\n\n", " \n", "\t", " ", "é", "12", "...", "'s", " ", "\x85", "x'll", "​", "\x1c"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_pieces_keep_the_tokenizers_ids(text):
    got = np.frombuffer(CODER.encode([text])[0], CODER.kind).tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


WORDS = ["Straße", "été", "à\u00ad", "мир", "x²", "中文", "naïve.", "end!", "a;b", "\u0378", "word", "ﬁn", "İ", "\u0301x", "_a", "<|endoftext|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([" ", " ", "\n", "", "\x1f", "\t"]), st.sampled_from(WORDS)), max_size=12))
def test_arrays_of_texts_keep_the_tokenizers_ids(pairs):
    text = "".join(x for pair in pairs for x in pair)
    texts = [text, "", text.strip(), " ".join(w for _, w in pairs)]
    ids, sizes = CODER.encode_array(pa.array(texts, pa.string()))
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [x for w in want for x in w]


def test_kept_pieces_are_short_and_looked_up_once_a_slice():
    coder, asked = PieceEncoder(PATH), []
    known = coder._ids_of_names
    coder._ids_of_names = lambda names, whole: asked.extend(names) or known(names, whole)
    coder.encode(["word " * 500 + "x" * 10_000, "a word " * 500 + "word"])
    assert sorted(asked) == sorted(set(asked))
    assert max(map(len, coder.cache)) <= 64


ROWS = [(3, "third one\n\nhere"), (1, None), (2, ""), (7, "word " * 5000), (None, "no id"), (5, "same"), (5, "same"), (4, "a  b \n c\td")]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_round_trip(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, start int, shard string")
    got = token_digest(docs, Workspace(spark, "test"), PATH, length=16, batch_sequences=3).collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == want


def test_sequences_and_masks(spark):
    docs = spark.createDataFrame(ROWS[:4], "doc_id bigint, text string").coalesce(1)
    manifest = write_token_files(docs, Workspace(spark, "test"), PATH, length=16, batch_sequences=3).collect()
    ids = []
    for row in sorted(manifest):
        shard = ShardReader(row.folder, row.name)
        for i in range(-(-row.n_tokens // 16)):
            values, mask = shard.sequence(i)
            assert len(values) == len(mask) == 16
            ids.extend(values[mask].tolist())
    want = [x for _, t in sorted(ROWS[:4]) for x in [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2]]
    assert ids == want


def test_added_tokens_keep_the_tokenizers_ids():
    texts = ["one two", "a <|endoftext|> b<|endoftext|>", "", "three."]
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[1]
    assert [np.frombuffer(x, CODER.kind).tolist() for x in CODER.encode(texts)] == want
