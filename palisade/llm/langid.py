"""Language identification with a byte convolutional network in numpy.

Texts are cut into windows of ``WINDOW`` bytes.  Filters of several widths slide over byte embeddings,
their largest responses over a window are pooled, and a softmax gives the window's languages; a text
gets the mean over all its windows, weighted by bytes.  The network is trained on the driver from a
bounded sample of labelled windows (``DOCS_PER_LANGUAGE`` documents of a language, drawn by a hash, and
``WINDOWS_PER_DOC`` windows of each); every byte of every text is then classified in the tasks.

For speed, embeddings and filters are multiplied into tables of byte pairs once per worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.tables import draw_of, slices

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
DOCS_PER_LANGUAGE = 300
WINDOWS_PER_DOC = 6
LEAST_SCORE = 0.4  # a text of no one language: 0.0 to 0.04 % of the texts of each test language score less
STEPS = 350
BATCH = 128
SEED = 23
UNKNOWN = "und"
_BLOCK = 256  # windows that are classified at once, small enough for the caches


@dataclass
class ByteNetwork:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    bias: list[np.ndarray]
    output: np.ndarray  # pooled features x languages
    offset: np.ndarray

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    @cached_property
    def _tables(self) -> list[list[tuple[int, bool, np.ndarray]]]:
        """Per width: (position, whether of a pair of bytes, responses)."""
        out = []
        for weights, bias in zip(self.filters, self.bias, strict=True):
            single = [(self.embedding @ w).astype(np.float32) for w in weights]
            single[0] = single[0] + bias.astype(np.float32)
            parts: list[tuple[int, bool, np.ndarray]] = []
            for j in range(0, len(single) - 1, 2):
                parts.append((j, True, (single[j][:, None] + single[j + 1][None]).reshape(65536, -1)))
            if len(single) % 2:
                parts.append((len(single) - 1, False, single[-1]))
            out.append(parts)
        return out

    def _pooled(self, windows: np.ndarray) -> np.ndarray:
        wide = windows.astype(np.int32)
        pairs = wide[:, :-1] << 8 | wide[:, 1:]
        out = []
        for width, parts in zip((len(f) for f in self.filters), self._tables, strict=True):
            n = windows.shape[1] - width + 1
            total = None
            for j, paired, table in parts:
                got = table.take((pairs if paired else wide)[:, j : j + n], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            out.append(total.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), _BLOCK):
            x = self._pooled(windows[at : at + _BLOCK]) @ self.output + self.offset
            x = np.exp(x - x.max(axis=1, keepdims=True))
            out[at : at + _BLOCK] = x / x.sum(axis=1, keepdims=True)
        return out


def cut(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (zero bytes fill the last of each), the text of each, and its bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-sizes // size)
    data = np.frombuffer(b"".join(t.ljust(n * size, b"\0") for t, n in zip(texts, counts.tolist(), strict=True)), np.uint8)
    of = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return data.reshape(-1, size), of, np.minimum(sizes[of] - place * size, size)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], *, steps: int = STEPS, seed: int = SEED) -> ByteNetwork:
    """Fit the network with Adam; a max pool passes its gradient to the place of the largest response."""
    draw = np.random.default_rng(seed)
    params = [draw.normal(0, 0.5, (256, EMBEDDING))]
    params += [draw.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS]
    params += [draw.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages))]
    n = len(WIDTHS)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1 if len(languages) > 1 else 1):
        pick = draw.integers(0, len(windows), BATCH)
        x, y = windows[pick], labels[pick]
        embedding, filters, bias, output, offset = params[0], params[1 : n + 1], params[n + 1 : 2 * n + 1], params[-2], params[-1]
        tops, places = [], []
        for w, f, b in zip(WIDTHS, filters, bias, strict=True):
            span = x.shape[1] - w + 1
            response = sum(((embedding @ f[j]).astype(np.float32)[x[:, j : j + span]] for j in range(w)), np.float32(0)) + b
            places.append(response.argmax(axis=1))
            tops.append(response.max(axis=1))
        pooled = np.maximum(np.concatenate(tops, axis=1), 0)
        logits = pooled @ output + offset
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(BATCH), y] -= 1
        p /= BATCH
        back = (p @ output.T) * (pooled > 0)
        grads = [np.zeros_like(q) for q in params]
        grads[-2], grads[-1] = pooled.T @ p + 1e-4 * output, p.sum(axis=0)
        for k, (w, f) in enumerate(zip(WIDTHS, filters, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            grads[n + 1 + k] = g.sum(axis=0)
            for j in range(w):
                met = x[np.arange(BATCH)[:, None], places[k] + j]
                grads[1 + k][j] = np.einsum("bf,bfe->ef", g, embedding[met])
                np.add.at(grads[0], met, g[:, :, None] * f[j].T[None])
        for q, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteNetwork(languages, params[0], params[1 : n + 1], params[n + 1 : 2 * n + 1], params[-2].astype(np.float32), params[-1].astype(np.float32))


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def sample_windows(docs: DataFrame, *, per_language: int = DOCS_PER_LANGUAGE, per_doc: int = WINDOWS_PER_DOC) -> DataFrame:
    """``lang, window``: a repeatable sample of about that many labelled documents of each language.

    Rows are drawn by a hash of id and text, more of them where rows that repeat both leave too few.
    At most ``per_language * per_doc`` windows of a language are returned.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select("doc_id", "text", "lang")
    draw = draw_of(SEED, "doc_id", "text")
    # One row per language, as many as the network has outputs on the driver: texts need no shuffle.
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    below = {lang: 1.2 * per_language / n for lang, n in sizes.items()}
    while True:
        share = docs.sparkSession.createDataFrame(list(below.items()), "of string, below double")
        drawn = labelled.join(F.broadcast(share), F.col("lang") == F.col("of")).filter(draw < F.col("below"))
        met = {r.lang: r["count"] for r in drawn.groupBy("lang").count().collect()}
        few = [lang for lang, n in sizes.items() if below[lang] < 1 and met.get(lang, 0) < per_language]
        if not few:
            break
        below.update({lang: 8 * below[lang] for lang in few})

    def windows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            langs, out = [], []
            for doc_id, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True):
                data = text.encode()
                found, _, _ = cut([data])
                pick = np.random.default_rng([SEED, zlib.crc32(str(doc_id).encode())]).permutation(len(found))[:per_doc]
                langs += [lang] * len(pick)
                out += [found[i].tobytes() for i in pick]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "window"])

    found = drawn.select("doc_id", "text", "lang").mapInArrow(windows, "lang string, window binary")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "window")))
    return found.withColumn("place", place).filter(F.col("place") <= per_language * per_doc).drop("place")


def fit_language_network(docs: DataFrame, **settings) -> ByteNetwork | None:
    """Train from labelled rows; the driver gets the bounded sample. None where nothing is labelled."""
    rows = sorted((r.lang, bytes(r.window)) for r in sample_windows(docs, **settings).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(lang) for lang, _ in rows]), languages)


def predict_language(docs: DataFrame, network: ByteNetwork | None, *carry: str) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score``, from the texts alone.

    A null text, one without a letter, or any text without a trained network gets ``und`` and score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers
    fields = docs.select(*carry).schema

    def predict(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for batch in batches:
            for part in slices(iter([batch]), "text", 1 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                known = np.array([any(map(str.isalpha, t)) for t in texts], bool) & (model is not None)
                names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                if known.any():
                    mine = np.flatnonzero(known)
                    windows, of, sizes = cut([texts[i].encode() for i in mine])
                    p = model.probabilities(windows) * sizes[:, None]
                    first = np.flatnonzero(np.diff(of, prepend=-1))
                    mean = np.add.reduceat(p, first, axis=0) / np.add.reduceat(sizes, first)[:, None]
                    names[mine] = np.array(model.languages, object)[mean.argmax(axis=1)]
                    scores[mine] = np.clip(mean.max(axis=1), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carry), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*carry, "lang_pred", "score"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(*carry, "text").mapInArrow(predict, f"{kinds}, lang_pred string, score double")


def with_known_language(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows whose text the network finds to be of a language it has learned, with a score of ``least`` or more.

    Null texts and texts without a letter go as well; where nothing is labelled, only these.  Repeated
    rows get one verdict, an empty table stays empty, further columns are kept whatever their names.
    """
    packed = docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias("row"))
    network = fit_language_network(packed)
    if network:
        judged = predict_language(packed, network, "row")
        return judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")

    def lettered(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(lettered, docs.schema)


def language_digest(docs: DataFrame, *, folds: int = 4, held: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; held-out rows are never trained on."""
    network = fit_language_network(docs.filter(fold_of("doc_id", folds) != held))
    return predict_language(docs, network, "doc_id").select(
        "doc_id", (fold_of("doc_id", folds) == held).alias("held_out"), "lang_pred", "score"
    )
