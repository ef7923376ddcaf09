"""Scoring texts with a hidden Markov language model.

Tokens are the words of a text and one end.  Every training word has emissions of its own, and so have the
end and an unseen word.  Those of the most frequent words (``HEAD`` at most, words of equal count together)
are an array that all tasks have.  The others are dealt to buckets by a hash, documents to blocks of about
``BLOCK_TOKENS`` tokens.  A block holds each of its words once and sends one row to each bucket that
has some of them: first the words, and in each round their expected counts.  The bucket adds up what the blocks sent
and answers each with one row of new emissions, so what is shuffled are arrays, no single words.  Emissions are
kept as 32-bit numbers on both sides, so that the cut between the two changes no result but by the order of sums.

Baum-Welch trains the latent states: ``FULL_ROUNDS`` rounds count over all training documents;
a caller may ask for rounds over one fold of the blocks before.  A round without tokens changes nothing.  The
driver sees sums of a size fixed by the numbers of states and symbols, and one sum per bucket.

Training cuts texts into segments of ``SEGMENT`` tokens, so that many run side by side.  Scores are the
exact likelihood of whole texts by the scaled forward recursion.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from palisade.llm.bytewords import mix
from palisade.llm.langid import fold_of
from palisade.llm.tables import Workspace, slices

HEAD = 65_000  # with two more symbols, ids fit 16 bits
STATES = 8
SEGMENT = 128
WARM_FOLDS = 8
WARM_ROUNDS = 0
FULL_ROUNDS = 10
SMOOTHING = 0.1
PRIOR = 50.0  # pseudo-counts of a state's emissions, spread as the corpus is
SEED = 29
_COUNTER_WORDS = 500_000
_TRAIN_TOKENS = 1 << 19  # whose posteriors are held at a time
_STEP_TOKENS = 1 << 17  # that one recursion takes side by side, which stay in a core's cache
BLOCK_TOKENS = 1 << 22
BUCKET_WORDS = 1 << 16
_HEAD_SLICE = 2048  # symbols whose counts one task adds up


@dataclass
class Vocabulary:
    """Counts of the training tokens; symbol i is the i-th frequent word, then come 'rare' and 'end'."""

    words: dict[bytes, int]
    counts: np.ndarray
    n_tokens: int  # N, ends included
    n_words: int  # different words, the end not included
    n_ends: int

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def size(self) -> int:
        return len(self.words) + 2

    @property
    def different(self) -> int:
        return self.n_words + (self.n_ends > 0)

    @property
    def base_total(self) -> float:
        return self.n_tokens + SMOOTHING * (self.different + 1)

    @property
    def rare_tokens(self) -> int:
        return self.n_tokens - self.n_ends - int(self.counts.sum())

    @property
    def rare_total(self) -> float:
        """What the smoothed counts of all rare words add up to, an unseen word included."""
        return self.rare_tokens + SMOOTHING * (self.n_words - len(self.words) + 1)

    def unigrams(self) -> np.ndarray:
        share = np.concatenate([self.counts, [self.rare_tokens, self.n_ends]]) + SMOOTHING
        return share / share.sum()

    def shares(self) -> tuple[np.ndarray, float]:
        """Smoothed shares where every word has one: of the symbols, 'rare' being an unseen word, and of a count of one."""
        share = np.concatenate([self.counts, [0, self.n_ends]]) + SMOOTHING
        total = share.sum() + self.rare_tokens + SMOOTHING * (self.n_words - len(self.words))
        return share / total, 1 / total


def spread(words: list[bytes], states: int, seed: int) -> np.ndarray:
    """Positive random factors, words x states, that depend on the word alone."""
    names = np.array([int.from_bytes(blake2b(w, digest_size=8).digest(), "little") for w in words], np.uint64)
    draws = [(mix(names ^ np.random.default_rng([seed, i]).integers(1 << 63, dtype=np.uint64)) >> np.uint64(11)) / 2.0**53 for i in range(2 * states)]
    normal = [np.sqrt(-2 * np.log1p(-u)) * np.cos(2 * np.pi * v) for u, v in zip(draws[::2], draws[1::2], strict=True)]
    return np.exp(0.7 * np.stack(normal, axis=1))


def _short(emit: np.ndarray) -> np.ndarray:
    """Rounded to what a 32-bit number holds."""
    return emit.astype(np.float32).astype(np.float64)


@dataclass
class HiddenMarkov:
    start: np.ndarray
    later: np.ndarray  # of segments that are not the first of a text, for training only
    move: np.ndarray
    emit: np.ndarray  # symbols x states
    total: np.ndarray  # by which the numbers of the table of other words are divided

    @classmethod
    def random(cls, vocabulary: Vocabulary, states: int = STATES, seed: int = SEED, others: np.ndarray | None = None) -> HiddenMarkov:
        """``others``: what the words beside the symbols add up to in each state."""
        draw = np.random.default_rng(seed)
        share = vocabulary.unigrams() if others is None else vocabulary.shares()[0]
        emit = _short(share[:, None] * spread([*vocabulary.words, b" rare", b" end"], states, seed))
        total = emit.sum(axis=0) + (0 if others is None else others)
        even = np.full(states, 1 / states)
        return cls(even, even, draw.dirichlet(np.full(states, 2.0), states), emit / total, total)

    def log10_likelihood(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each of several sequences that lie one after the other (each has one symbol at least)."""
        order = np.argsort(-sizes, kind="stable")
        at = (np.cumsum(sizes) - sizes)[order]
        active = len(sizes) - np.cumsum(np.bincount(sizes, minlength=sizes.max(initial=0) + 1))
        out = np.zeros(len(sizes))
        alpha = np.broadcast_to(self.start, (len(sizes), len(self.start)))
        for t in range(sizes.max(initial=0)):
            n = active[t]
            alpha = alpha[:n] if t == 0 else alpha[:n] @ self.move
            alpha = alpha * self.emit.take(symbols.take(at[:n] + t), axis=0)
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            out[:n] += np.log10(scale)
        back = np.empty_like(out)
        back[order] = out
        return back

    def expected_counts(self, symbols: np.ndarray, sizes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> None:
        """Add the expected counts of sequences: rows of symbols, then of moves, start, later, and the likelihood."""
        v, states = len(self.emit), len(self.start)
        ends = np.cumsum(sizes)
        gamma, place = np.empty((states, len(symbols))), np.empty(len(symbols), np.int64)
        for part in _runs(sizes, _STEP_TOKENS):
            at = slice(ends[part.start] - sizes[part.start], ends[part.stop - 1])
            order = self._posteriors(symbols[at], sizes[part.start : part.stop], first[part.start : part.stop], counts, gamma[:, at])
            place[at] = order + at.start
        ids = symbols.take(place)
        for s in range(states):
            counts[:v, s] += np.bincount(ids, gamma[s], minlength=v)

    def _posteriors(self, symbols: np.ndarray, sizes: np.ndarray, first: np.ndarray, counts: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Writes the states' probabilities step by step, states x tokens; returns the tokens' places in that order. The rest is added."""
        order = np.argsort(-sizes, kind="stable")
        at, first = (np.cumsum(sizes) - sizes)[order], first[order]
        longest, states, v = int(sizes.max(initial=0)), len(self.start), len(self.emit)
        active = len(sizes) - np.cumsum(np.bincount(sizes, minlength=longest + 1))
        alphas, emits, scales, places = [], [], [], []
        back, one = np.ascontiguousarray(self.move.T), np.ones(states)
        logs, product = 0.0, np.ones(0)
        alpha = np.where(first, self.start[:, None], self.later[:, None])
        for t in range(longest):
            n = active[t]
            place = at[:n] + t
            emit = self.emit.take(symbols.take(place), axis=0).T.copy()
            alpha = (alpha if t == 0 else back @ alpha[:, :n]) * emit
            scale = one @ alpha
            if t % 8 == 0 or len(product) > n:  # logarithms of eight steps at a time
                logs += float(np.log10(product).sum())
                product = scale.copy()
            else:
                product *= scale
            np.reciprocal(scale, out=scale)
            alpha *= scale
            alphas.append(alpha)
            emits.append(emit)
            scales.append(scale)
            places.append(place)
        logs += float(np.log10(product).sum())
        moves = np.zeros((states, states))
        begins = np.cumsum(active[:longest]) - active[:longest]
        beta = np.ones((states, 0))
        for t in range(longest - 1, -1, -1):
            n = active[t]
            if beta.shape[1] < n:  # sequences that end here
                beta = np.concatenate([beta, np.ones((states, n - beta.shape[1]))], axis=1)
            if t:
                ahead = emits[t]
                ahead *= beta
                ahead *= scales[t]
                moves += alphas[t - 1][:, :n] @ ahead.T
                np.multiply(alphas[t], beta, out=out[:, begins[t] : begins[t] + n])
                beta = self.move @ ahead
            else:
                np.multiply(alphas[0], beta, out=out[:, :n])
        counts[v : v + states] += moves * self.move
        if longest:
            heads = out[:, : active[0]]
            counts[v + states] += heads[:, first].sum(axis=1)
            counts[v + states + 1] += heads[:, ~first].sum(axis=1)
        counts[v + states + 2, :2] += [logs, len(symbols)]
        return np.concatenate(places) if places else np.zeros(0, np.int64)

    def updated(self, counts: np.ndarray, vocabulary: Vocabulary, others: np.ndarray | None = None) -> HiddenMarkov:
        v, states = len(self.emit), len(self.start)
        share = vocabulary.unigrams() if others is None else vocabulary.shares()[0]
        emit = _short(counts[:v] + PRIOR * share[:, None])
        total = emit.sum(axis=0) + (0 if others is None else others)
        move = counts[v : v + states] + 1
        start, later = counts[v + states] + 1, counts[v + states + 1] + 1
        return HiddenMarkov(start / start.sum(), later / later.sum(), move / move.sum(axis=1, keepdims=True), emit / total, total)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space: both as ``bytes`` does it."""
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n``: counts of all words, added up within each task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]):
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(words_of(text))
                if len(held) > _COUNTER_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _symbols(text: str | None, voc: Vocabulary) -> tuple[np.ndarray, list[bytes]]:
    """The symbols of a text, the end included, and the words among them that have none, in order."""
    found = words_of(text)
    ids = np.fromiter(chain(map(voc.words.get, found, repeat(voc.rare)), (voc.rare + 1,)), np.uint16, len(found) + 1)
    return ids, [found[i] for i in np.flatnonzero(ids == voc.rare).tolist()]


def _encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, held_out, symbols``: each document by itself, all words without a symbol being 'rare'."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # HEAD words at most
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            symbols = [_symbols(t, shared.value)[0].tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(symbols, pa.binary())], ["doc_id", "held_out", "symbols"]
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(encode, f"doc_id {kind}, held_out boolean, symbols binary")


_BLOCK = "block bigint, held_out array<boolean>, sizes binary, symbols binary, rare binary"


class _Block:
    """Documents that are gathered until they have tokens enough."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.ids, self.held, self.symbols, self.rare = [], [], [], []
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__  # a new word gets the next number
        self.tokens = 0

    def add(self, doc_id, held_out: bool, symbols: np.ndarray, outside: list[bytes]) -> None:
        self.ids.append(doc_id)
        self.held.append(held_out)
        self.symbols.append(symbols)
        self.tokens += len(symbols)
        self.rare.append(np.fromiter(map(self.words.__getitem__, outside), np.int32, len(outside)))

    def row(self, block: int) -> dict:
        """The words are in the order of their buckets."""
        words = list(self.words)
        trained = [r for r, out in zip(self.rare, self.held, strict=True) if not out]  # counts are of training documents
        times = np.bincount(np.concatenate(trained), minlength=len(words)) if trained else np.zeros(len(words), np.int64)
        bucket = np.fromiter((crc32(w) % self.buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        return {
            "block": block, "held_out": self.held, "sizes": np.fromiter(map(len, self.symbols), np.int64, len(self.symbols)).tobytes(),
            "symbols": np.concatenate(self.symbols).tobytes(), "rare": place[np.concatenate(self.rare)].tobytes(),
            "ids": self.ids, "words": [words[i] for i in order], "times": times.astype(np.int64)[order].tobytes(),
            "buckets": bucket[order].tobytes(),
        }


def blocks_of(docs: DataFrame, vocabulary: Vocabulary, buckets: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``block, held_out, sizes, symbols, rare, ids, words, times, buckets``: documents of a task, some millions of tokens a row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # HEAD words at most
    kind = docs.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]):
        part, n, block = TaskContext.get().partitionId() << 32, 0, _Block(buckets)

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block.row(part + n)], schema)

        for batch in batches:
            schema = pa.schema([
                ("block", pa.int64()), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.binary()), ("symbols", pa.binary()), ("rare", pa.binary()),
                ("ids", pa.list_(batch.schema.field("doc_id").type)), ("words", pa.list_(pa.binary())), ("times", pa.binary()), ("buckets", pa.binary()),
            ])
            for piece in slices(iter([batch]), "text", 4 << 20):
                columns = (piece.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))
                for doc_id, held_out, text in zip(*columns, strict=True):
                    block.add(doc_id, held_out, *_symbols(text, shared.value))
                    if block.tokens >= block_tokens:
                        yield ready()
                        n, block = n + 1, _Block(buckets)
        if block.tokens:
            yield ready()

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        gather, f"{_BLOCK}, ids array<{kind}>, words array<binary>, times binary, buckets binary"
    )


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that follow each other and have the same key."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != last:
                yield last, held
                held = []
            last = row[key]
            held.append(row)
    if held:
        yield last, held


_ROUND = "bucket int, block bigint, e binary"


def members_of(blocks: DataFrame, vocabulary: Vocabulary, *, states: int = STATES) -> DataFrame:
    """``bucket, block, places, n, e``: which of a bucket's words a block has, their training counts and first emissions.

    The row of block -1 has the counts of all words of the bucket, and the sum of the emissions.  A word that no training
    document has counts 0 and has emissions that are no numbers.
    """
    unit = vocabulary.shares()[1]

    def send(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                bucket, times = np.frombuffer(row["buckets"], np.int64), np.frombuffer(row["times"], np.int64)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                runs = [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts], pa.int32()), pa.array([row["block"]] * len(cuts), pa.int64()),
                     pa.array([row["words"][r] for r in runs], pa.list_(pa.binary())),
                     pa.array([times[r].tobytes() for r in runs], pa.binary())],
                    ["bucket", "block", "words", "times"],
                )

    def meet(batches: Iterator[pa.RecordBatch]):
        for bucket, rows in _groups(batches, "bucket"):
            index: dict[bytes, int] = {}
            places = [np.fromiter((index.setdefault(w, len(index)) for w in r["words"]), np.int32, len(r["words"])) for r in rows]
            n = np.zeros(len(index), np.int64)
            for r, place in zip(rows, places, strict=True):
                n[place] += np.frombuffer(r["times"], np.int64)
            e = (((n + SMOOTHING) * unit)[:, None] * spread(list(index), states, SEED)).astype(np.float32)
            total = e[n > 0].sum(axis=0, dtype=np.float64)
            e[n == 0] = np.nan
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket] * (len(rows) + 1), pa.int32()), pa.array([-1, *(r["block"] for r in rows)], pa.int64()),
                 pa.array([b"", *(p.tobytes() for p in places)], pa.binary()), pa.array([n.tobytes(), *(n[p].tobytes() for p in places)], pa.binary()),
                 pa.array([total.tobytes(), *(e[p].tobytes() for p in places)], pa.binary())],
                ["bucket", "block", "places", "n", "e"],
            )

    sent = blocks.select("block", "words", "times", "buckets").mapInArrow(send, "bucket int, block bigint, words array<binary>, times binary")
    met = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return met.mapInArrow(meet, "bucket int, block bigint, places binary, n binary, e binary")


def _answered(blocks: DataFrame, answers: DataFrame | None, counts: DataFrame | None = None) -> DataFrame:
    """Each block as a row of bucket -1, followed by the emissions (and counts) that the buckets sent to it."""
    parts = [c.partition(" ")[0] for c in _BLOCK.split(", ")]
    whole = blocks.select(*parts, *[c for c in blocks.columns if c == "ids"])
    nothing = F.lit(None).cast("binary")
    whole = whole.withColumns({"bucket": F.lit(-1), "e": nothing, "n": nothing})
    if answers is None:
        return whole
    sent = answers.filter("block >= 0").select("block", "bucket", "e", nothing.alias("n"))
    if counts is not None:
        sent = sent.unionByName(counts.filter("block >= 0").select("block", "bucket", nothing.alias("e"), "n"))
    # n comes last, as nulls come first
    return whole.unionByName(sent, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "bucket", F.col("n").isNotNull())


def _with_words(model: HiddenMarkov, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, HiddenMarkov]:
    """Symbols, sizes and held-out marks of a block's documents, and the model with the block's words as further symbols."""
    block, rare, states = rows[0], len(model.emit) - 2, len(model.start)
    ids = np.frombuffer(block["symbols"], np.uint16).astype(np.int64)
    found = [np.frombuffer(r["e"], np.float32).reshape(-1, states) for r in rows[1:] if r["e"] is not None]
    if found:
        ids[ids == rare] = rare + 2 + np.frombuffer(block["rare"], np.int32)
        e = np.concatenate(found) / model.total
        unseen = np.isnan(e[:, 0])
        e[unseen] = model.emit[rare]
        model = replace(model, emit=np.concatenate([model.emit, e]))
    return ids, np.frombuffer(block["sizes"], np.int64), np.array(block["held_out"], bool), model


def _message(bucket, block, arrays: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(block, pa.int64()), pa.array([a.tobytes() for a in arrays], pa.binary())], ["bucket", "block", "e"]
    )


def _expected(blocks: DataFrame, model: HiddenMarkov, answers: DataFrame | None) -> DataFrame:
    """The first half of a round: ``bucket, block, e``, the expected counts of each block's words, a row per bucket.

    Rows of block -1 and negative buckets are slices of the expected counts of symbols, from each task.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)

    def expect(batches: Iterator[pa.RecordBatch]):
        size = len(shared.value.emit)
        total = np.zeros((size + states + 3, states))
        for block, rows in _groups(batches, "block"):
            ids, sizes, held_out, hmm = _with_words(shared.value, rows)
            counts = np.zeros((len(hmm.emit) + states + 3, states))
            ends = np.cumsum(sizes)
            for group in _runs(np.where(held_out, 0, sizes), _TRAIN_TOKENS):
                texts = [ids[ends[i] - sizes[i] : ends[i]] for i in group if not held_out[i]]
                if not texts:
                    continue
                own = np.fromiter(map(len, texts), np.int64, len(texts))
                pieces = -(-own // SEGMENT)
                of = np.repeat(np.arange(len(own)), pieces)
                place = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                hmm.expected_counts(np.concatenate(texts), np.minimum(own[of] - place * SEGMENT, SEGMENT), place == 0, counts)
            total[:size] += counts[:size]
            total[size:] += counts[len(hmm.emit) :]
            sent = [r for r in rows[1:] if r["e"] is not None]
            if sent:
                cuts = np.cumsum([len(r["e"]) // (4 * states) for r in sent])[:-1]
                own = np.split(counts[size : len(hmm.emit)].astype(np.float32), cuts)
                yield _message([r["bucket"] for r in sent], [block] * len(sent), own)
        parts = [total[a : a + _HEAD_SLICE] for a in range(0, len(total), _HEAD_SLICE)]
        yield _message([-1 - i for i in range(len(parts))], [-1] * len(parts), parts)

    return _answered(blocks, answers).mapInArrow(expect, _ROUND)


def _summed(counted: DataFrame, vocabulary: Vocabulary, members: DataFrame | None, states: int) -> DataFrame:
    """The second half: ``bucket, block, e``, the buckets' new emissions for each block.

    Rows of block -1 are for the driver: the sum of a bucket's emissions, and (negative buckets) slices of the expected counts of symbols.
    """
    unit = vocabulary.shares()[1]

    def add(batches: Iterator[pa.RecordBatch]):
        for bucket, rows in _groups(batches, "bucket"):
            if bucket < 0:
                yield _message([bucket], [-1], [sum(np.frombuffer(r["e"], np.float64) for r in rows)])
                continue
            places = {r["block"]: np.frombuffer(r["places"], np.int32) for r in rows if r["places"] is not None}
            n = next(np.frombuffer(r["n"], np.int64) for r in rows if r["block"] < 0)
            e = np.zeros((len(n), states))
            for r in rows:
                if r["e"] is not None:
                    e[places[r["block"]]] += np.frombuffer(r["e"], np.float32).reshape(-1, states)
            e = (e + (PRIOR * unit * (n + SMOOTHING))[:, None]).astype(np.float32)
            total = e[n > 0].sum(axis=0, dtype=np.float64)
            e[n == 0] = np.nan
            met = [b for b in places if b >= 0]
            yield _message([bucket] * (len(met) + 1), [-1, *met], [total, *(e[places[b]] for b in met)])

    if members is not None:
        known = members.select("bucket", "block", F.when(F.col("block") >= 0, F.col("places")).alias("places"), F.when(F.col("block") < 0, F.col("n")).alias("n"))
        counted = counted.unionByName(known, allowMissingColumns=True)
    else:
        counted = counted.withColumns({"places": F.lit(None).cast("binary"), "n": F.lit(None).cast("binary")})
    return counted.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(add, _ROUND)


def _runs(sizes: np.ndarray, limit: int) -> Iterator[range]:
    """Places that follow each other, whose sizes add up to about ``limit``."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + limit, side="right")))
        yield range(at, to)
        at = to


def _sums(answers: DataFrame | None) -> np.ndarray | None:
    """What the emissions of all words beside the symbols add up to, from one row per bucket."""
    if answers is None:
        return None
    return sum(np.frombuffer(r.e, np.float64) for r in answers.filter("block < 0 AND bucket >= 0").sort("bucket").select("e").collect())


def trained(blocks: DataFrame, vocabulary: Vocabulary, members: DataFrame | None, workspace: Workspace, begun: DataFrame | None = None, *, states: int = STATES,
            warm: int = WARM_ROUNDS, full: int = FULL_ROUNDS) -> tuple[HiddenMarkov, DataFrame | None, list[float]]:
    """From the first emissions ``begun``, which are removed when they are replaced: the trained model, the emissions of the other words, and the mean log10 likelihood of a token before each round's update."""
    answers, history = begun, []
    model = HiddenMarkov.random(vocabulary, states, others=_sums(begun))
    for i in range(warm + full):
        part = blocks
        if i < warm:
            part = blocks.filter(F.pmod(F.xxhash64(F.lit(SEED), "block"), F.lit(WARM_FOLDS)) == i % WARM_FOLDS)
        sent = None if answers is None else answers.join(part.select("block"), "block", "left_semi") if i < warm else answers
        # Each half is written, so that the shuffle of the first is gone before that of the second begins.
        counted = workspace.write(_expected(part, model, sent), f"counts-{i}")
        replaced = answers is not None and i >= warm and vocabulary.n_tokens > 0  # a round with tokens replaces them
        if replaced:
            workspace.remove(answers)
        summed = workspace.write(_summed(counted, vocabulary, members, states), f"round-{i}")
        workspace.remove(counted)
        found = {r.bucket: np.frombuffer(r.e, np.float64) for r in summed.filter("bucket < 0").select("bucket", "e").collect()}
        rows = [found[b] for b in sorted(found, reverse=True)]
        counts = np.concatenate(rows).reshape(-1, states) if rows else np.zeros((vocabulary.size + states + 3, states))
        total, tokens = counts[-1, :2]
        history.append(total / tokens if tokens else 0.0)
        if not tokens:
            workspace.remove(summed)
            continue
        if answers is not None:
            if not replaced:
                workspace.remove(answers)
            answers = summed
        model = model.updated(counts, vocabulary, _sums(answers))
        if answers is None:
            workspace.remove(summed)
    return model, answers, history


def baum_welch(encoded: DataFrame, vocabulary: Vocabulary, workspace: Workspace, **training) -> tuple[HiddenMarkov, list[float]]:
    """The trained model, and the mean log10 likelihood of a token before each round's update, where all words are symbols."""

    def one_each(batches: Iterator[pa.RecordBatch]):
        n, part = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = [(s, len(s) // 2) for s in batch.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(part + n, part + n + len(rows)), pa.int64()), pa.array([[False]] * len(rows), pa.list_(pa.bool_())),
                 pa.array([np.int64(k).tobytes() for _, k in rows], pa.binary()), pa.array([s for s, _ in rows], pa.binary()),
                 pa.array([b""] * len(rows), pa.binary())],
                ["block", "held_out", "sizes", "symbols", "rare"],
            )
            n += len(rows)

    blocks = workspace.write(encoded.select("symbols").mapInArrow(one_each, _BLOCK), "blocks")
    model, _, history = trained(blocks, vocabulary, None, workspace, **training)
    return model, history


def _score(blocks: DataFrame, model: HiddenMarkov, vocabulary: Vocabulary, members: DataFrame, answers: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` of each document."""
    spark = blocks.sparkSession
    shared, known = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(vocabulary)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]):
        voc = known.value
        head = np.concatenate([voc.counts, [0, voc.n_ends]])
        for _, rows in _groups(batches, "block"):
            ids, sizes, held_out, hmm = _with_words(shared.value, rows)
            n = np.concatenate([head, *(np.frombuffer(r["n"], np.int64) for r in rows[1:] if r["n"] is not None)])
            logs, seen = np.log10((n + SMOOTHING) / voc.base_total), n > 0
            ends = np.cumsum(sizes)
            starts = ends - sizes
            path = np.concatenate([hmm.log10_likelihood(ids[starts[g.start] : ends[g.stop - 1]], sizes[g.start : g.stop]) for g in _runs(sizes, _TRAIN_TOKENS)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0]["ids"], doc_type), pa.array(held_out), pa.array(sizes),
                 pa.array(np.add.reduceat(seen[ids].astype(np.int64), starts)), pa.array(np.add.reduceat(logs[ids], starts)), pa.array(path)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    doc_type = to_arrow_type(blocks.schema["ids"].dataType.elementType)
    result = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    return _answered(blocks, answers, members).mapInArrow(score, result)


def read_vocabulary(train: DataFrame, counted: DataFrame, head: int = HEAD) -> Vocabulary:
    totals = counted.agg(F.count(F.lit(1)).alias("different"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    ends = train.count()
    # The least count of a frequent word, by steps of a 256th of a power of two: a few thousand numbers.
    step = F.floor(F.log2("n") * 256).alias("step")
    room, least = head, None
    for row in sorted(counted.groupBy(step).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect(), key=lambda r: -r.step):
        room -= row.words
        if room < 0:
            break
        least = row.n
    top = counted.filter(F.lit(False) if least is None else F.col("n") >= least).collect()
    top.sort(key=lambda r: (-r.n, bytes(r.word)))
    counts = np.array([r.n for r in top], np.int64)
    return Vocabulary({bytes(r.word): i for i, r in enumerate(top)}, counts, totals.tokens + ends, totals.different, ends)


def score_texts(
    docs: DataFrame, workspace: Workspace, *, folds: int = 10, held: int = 0, head: int = HEAD, block_tokens: int = BLOCK_TOKENS,
    bucket_words: int = BUCKET_WORDS, **training,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, all of whole texts.

    Learns from the documents whose id's crc32 modulo ``folds`` is not ``held``.  A null text is empty:
    it has the end alone.  Repeated rows are scored each.  With nothing to learn from, every token has
    the same base probability and the model is the untrained one.  Sizes of blocks and buckets change no
    result but by the order of sums.
    """
    rows = docs.select("doc_id", "text", (fold_of("doc_id", folds) == held).alias("held_out"))
    train = rows.filter("NOT held_out")
    counted = workspace.write(count_words(train), "counts")
    vocabulary = read_vocabulary(train, counted, head)
    workspace.remove(counted)
    states, outside = training.get("states", STATES), vocabulary.n_words - len(vocabulary.words)
    whole = workspace.write(blocks_of(rows, vocabulary, outside // bucket_words + 1, block_tokens), "words")
    met = workspace.write(members_of(whole, vocabulary, states=states), "met")
    blocks = workspace.write(whole.drop("words", "times", "buckets"), "blocks")
    members = workspace.write(met.drop("e"), "members")
    begun = workspace.write(met.select("bucket", "block", "e"), "begun")
    workspace.remove(whole)
    workspace.remove(met)
    model, answers, _ = trained(blocks, vocabulary, members if outside else None, workspace, begun if outside else None, **training)
    scored = _score(blocks, model, vocabulary, members, begun if answers is None else answers)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
