"""Personal data by base patterns and a character BiLSTM with CRF transitions, in numpy.

The base patterns find emails, IP addresses, card and phone numbers.  Their spans in a bounded sample
(``TRAIN_DOCS`` documents, drawn by a hash, a few windows of each) label the training windows of the
tagger, which is fitted on the driver.  Tasks then run it over every character of every text:

* texts are cut into windows of ``WINDOW`` characters that overlap by ``OVERLAP``; windows of similar
  length go through both directions of the LSTM side by side;
* where windows overlap their tag scores are averaged, so a text has one score per character and tag;
* the CRF decodes the whole text at once.  Characters that no best path can tag are found with two
  running minima (see ``_zones``) and left out, which changes no result.

Spans of the tagger that touch no base span, beat leaving the characters untagged by ``MARGIN``, and
keep the rules of their kind (digits, Luhn, parts up to 255, an @) are added; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace, hash_sample, slices

KINDS = ("email", "ip", "card", "phone")  # as listed in digests; tag 0 is 'none', tag i + 1 is kind i
TAGS = len(KINDS) + 1
HIDDEN = 8
CLASSES = 129  # ASCII, and one for every other character
WINDOW, OVERLAP = 512, 64
MARGIN = 4.0
TRAIN_DOCS = 6000
TRAIN_WINDOW = 96
WINDOWS_PER_DOC = 4
STEPS = 400
BATCH = 64
SEED = 31
_ROWS = 1024  # windows that run side by side
_CHUNK = 2 << 20

# Fixed patterns. Possessive repeats and the look-behind change no match, they only avoid retries.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NUMBER = re.compile("[0-9]+")

Span = tuple[int, int, int]  # kind, start, end (exclusive)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @: the local part cannot hold one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield 0, start, end
        at = text.find("@", end if found else at + 1)


def _is_byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """By kind, then by start; matches that fail a rule are dropped without a second try."""
    out = list(_emails(text))
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_is_byte, m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = "".join(filter(str.isdigit, m.group())) if m.end() - m.start() <= 40 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def plausible(kind: int, text: str) -> bool:
    """Whether a tagged span keeps the rules of its kind, whatever stands between its parts."""
    groups = _NUMBER.findall(text)
    digits = "".join(groups)
    if kind == 0:
        return "@" in text[1:-1]
    if kind == 1:
        return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def char_classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(codes, CLASSES - 1).astype(np.uint8)


@dataclass
class Tagger:
    """Gates are ordered in, forget, out, new; index 0 of the first axis runs forward, 1 backward."""

    table: np.ndarray  # 2 x CLASSES x 4 HIDDEN: what a character adds to the gates, bias included
    recur: np.ndarray  # 2 x HIDDEN x 4 HIDDEN
    output: np.ndarray  # 2 x HIDDEN x TAGS
    offset: np.ndarray  # TAGS
    move: np.ndarray  # TAGS x TAGS

    @classmethod
    def random(cls, seed: int = SEED) -> Tagger:
        draw = np.random.default_rng(seed)
        table = draw.normal(0, 0.5, (2, CLASSES, 4 * HIDDEN))
        table[:, :, HIDDEN : 2 * HIDDEN] += 1.5  # remember, to begin with
        offset = np.zeros(TAGS)
        offset[0] = 1
        return cls(table, draw.normal(0, HIDDEN**-0.5, (2, HIDDEN, 4 * HIDDEN)), draw.normal(0, 0.3, (2, HIDDEN, TAGS)), offset, np.zeros((TAGS, TAGS)))

    def for_scoring(self) -> Scorer:
        """Single precision, a block per gate, with three gates halved so that one tanh serves all four."""
        half = np.ones(4 * HIDDEN)
        half[: 3 * HIDDEN] = 0.5

        def blocks(x: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray(np.stack(np.split(x * half, 4, axis=-1)).astype(np.float32))

        return Scorer(blocks(self.table), blocks(self.recur), *(x.astype(np.float32) for x in (self.output, self.offset, self.move)))


@dataclass
class Scorer:
    """A tagger made ready for long texts; the first axis of the gates is in, forget, out, new."""

    table: np.ndarray  # 4 x 2 x CLASSES x HIDDEN
    recur: np.ndarray  # 4 x 2 x HIDDEN x HIDDEN
    output: np.ndarray
    offset: np.ndarray
    move: np.ndarray

    def window_scores(self, chars: np.ndarray, start: np.ndarray, size: np.ndarray, scores: np.ndarray) -> None:
        """Add the tag scores of windows (sorted by size, largest first) to those of the characters."""
        rows, longest = len(start), int(size[0])
        ends = start + size - 1
        active = rows - np.cumsum(np.bincount(size, minlength=longest + 1))
        h = np.zeros((2, rows, HIDDEN), np.float32)
        c = np.zeros((2, rows, HIDDEN), np.float32)
        hidden = np.empty((2, rows, longest, HIDDEN), np.float32)
        for t in range(longest):
            n = active[t]
            if n < h.shape[1]:
                h, c = np.ascontiguousarray(h[:, :n]), c[:, :n]
            z = np.matmul(h, self.recur)
            seen = chars.take(start[:n] + t), chars.take(ends[:n] - t)
            for gate, table in zip(z, self.table, strict=True):
                gate[0] += table[0].take(seen[0], axis=0)
                gate[1] += table[1].take(seen[1], axis=0)
            np.tanh(z, out=z)
            gates = z[:3]
            gates *= 0.5
            gates += 0.5
            c = z[1] * c
            z[0] *= z[3]
            c += z[0]
            h = np.tanh(c)
            h *= z[2]
            hidden[:, :n, t] = h
        out = np.matmul(hidden.reshape(2, -1, HIDDEN), self.output).reshape(2, rows, longest, TAGS)
        for a, n, forward, backward in zip(start.tolist(), size.tolist(), *out, strict=True):
            scores[a : a + n] += forward[:n]
            scores[a : a + n] += backward[:n][::-1]

    def text_scores(self, chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Scores per character and tag of texts that lie one after the other, averaged over windows."""
        hop = WINDOW - OVERLAP
        counts = np.where(sizes > 0, np.maximum(-(-(sizes - OVERLAP) // hop), 1), 0)
        of = np.repeat(np.arange(len(sizes)), counts)
        place = (np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)) * hop
        start, size = (np.cumsum(sizes) - sizes)[of] + place, np.minimum(sizes[of] - place, WINDOW)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        scores = np.zeros((len(chars), TAGS), np.float32)
        wide = chars.astype(np.intp)
        for at in range(0, len(start), _ROWS):
            self.window_scores(wide, start[at : at + _ROWS], size[at : at + _ROWS], scores)
        cover = np.zeros(len(chars) + 1, np.int32)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + size, -1)
        scores /= np.cumsum(cover[:-1], dtype=np.int32)[:, None]
        return scores + self.offset


def _zones(scores: np.ndarray, move: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches outside of which a best path is untagged.

    With scores relative to tag 0 and moves relative to 0 -> 0, a tagged run gains at most the sum of
    g = (best other score + best move between other tags) over its characters, and a constant for its
    two ends.  A character of which every run gains nothing is untagged on the best path that tags
    least: dropping such a run never lowers the score.
    """
    free = move - move[0, 0]
    inner = free[1:, 1:].max()
    ends = free[0, 1:].max() + free[1:, 0].max() - inner
    gain = (scores[:, 1:].max(axis=1) - scores[:, 0]).astype(np.float64) + inner
    limit = np.concatenate(([0], np.cumsum(sizes + 1)))
    spaced = np.full(limit[-1] + 1, -1e9)  # runs do not cross texts
    spaced[np.arange(len(gain)) + 1 + np.repeat(np.arange(len(sizes)), sizes)] = gain
    low = np.zeros_like(spaced)
    total = np.cumsum(np.maximum(spaced, -1e4))
    low[1:] = np.minimum.accumulate(total)[:-1]
    left = total - low  # the best sum that ends here
    high = np.maximum.accumulate(total[::-1])[::-1]
    best = left + (high - total)  # of all runs through here
    inside = (best + ends > 0)[np.arange(len(gain)) + 1 + np.repeat(np.arange(len(sizes)), sizes)]
    first = np.zeros(len(gain), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    begin = inside & (first | ~np.concatenate(([False], inside[:-1])))
    last = np.concatenate((first[1:], [True])) if len(gain) else first
    end = inside & (last | ~np.concatenate((inside[1:], [False])))
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def decode(scores: np.ndarray, move: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of whole texts, and for each character the gain of its zone over no tags at all."""
    tags, gains = np.zeros(len(scores), np.int8), np.zeros(len(scores))
    begin, end = _zones(scores, move, sizes)
    if not len(begin):
        return tags, gains
    order = np.argsort(begin - end, kind="stable")
    begin, size = begin[order], (end - begin)[order]
    longest = int(size[0])
    active = len(size) - np.cumsum(np.bincount(size, minlength=longest + 1))
    rel = (scores - scores[:, :1]).astype(np.float64)
    free = (move - move[0, 0]).astype(np.float64)
    best = free[0] + rel[begin]
    came = []
    final = np.zeros((len(size), TAGS))
    for t in range(1, longest):
        n = active[t]
        final[n : len(best)] = best[n:]
        ways = best[:n, :, None] + free
        came.append(ways.argmax(axis=1).astype(np.int8))
        best = ways.max(axis=1) + rel[begin[:n] + t]
    final[: len(best)] = best
    final += free[:, 0]
    gain = final.max(axis=1)
    tag = np.zeros(len(size), np.int64)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        tag[:n] = np.where(size[:n] == t + 1, final[:n].argmax(axis=1), tag[:n])
        tags[begin[:n] + t] = tag[:n]
        gains[begin[:n] + t] = gain[:n]
        if t:
            tag[:n] = came[t - 1][np.arange(n), tag[:n]]
    return tags, gains


def tagged_spans(tagger: Scorer, texts: list[str]) -> list[list[Span]]:
    """Spans of the tagger in each text, by start."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = char_classes("".join(texts))
    scores = tagger.text_scores(chars, sizes)
    tags, gains = decode(scores, tagger.move, sizes)
    first = np.cumsum(sizes) - sizes
    cut = np.zeros(len(tags) + 1, bool)
    cut[first] = True
    cut[1:-1] |= tags[1:] != tags[:-1]
    cut[-1] = True
    edges = np.flatnonzero(cut)
    out: list[list[Span]] = [[] for _ in texts]
    if len(tags):
        found = np.flatnonzero((tags[edges[:-1]] > 0) & (gains[edges[:-1]] >= MARGIN))
        of = np.searchsorted(first + sizes, edges[found], "right")
        for i, a, b in zip(of.tolist(), edges[found].tolist(), edges[found + 1].tolist(), strict=True):
            out[i].append((int(tags[a]) - 1, a - int(first[i]), b - int(first[i])))
    return out


def all_spans(tagger: Scorer | None, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and the tagger's plausible spans that touch none of them."""
    base = [base_spans(t) for t in texts]
    more = tagged_spans(tagger, texts) if tagger else [[] for _ in texts]
    kept = [
        [(k, a, b) for k, a, b in new if plausible(k, text[a:b]) and all(b <= x or a >= y for _, x, y in old)]
        for text, old, new in zip(texts, base, more, strict=True)
    ]
    return base, kept


# --- training -------------------------------------------------------------------------------------


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def loss_and_gradients(model: Tagger, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tags of windows of one length, by back-propagation."""
    rows, length = chars.shape
    ids = np.stack([chars, chars[:, ::-1]])
    h = np.zeros((2, rows, HIDDEN))
    c = np.zeros((2, rows, HIDDEN))
    kept = []
    hidden = np.empty((2, length, rows, HIDDEN))
    for t in range(length):
        z = h @ model.recur
        z[0] += model.table[0][ids[0, :, t]]
        z[1] += model.table[1][ids[1, :, t]]
        gates, new = 1 / (1 + np.exp(-z[..., : 3 * HIDDEN])), np.tanh(z[..., 3 * HIDDEN :])
        i, f, o = np.split(gates, 3, axis=-1)
        before, c = c, f * c + i * new
        top = np.tanh(c)
        kept.append((h, before, i, f, o, new, top))
        h = o * top
        hidden[:, t] = h
    states = np.stack([hidden[0], hidden[1, ::-1]])  # by place in the text
    scores = np.einsum("dtrh,dhk->trk", states, model.output) + model.offset
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, length):
        alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + model.move, 1) + scores[t]
    for t in range(length - 2, -1, -1):
        beta[t] = _logsumexp(model.move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _logsumexp(alpha[-1], 1)
    gold = tags.T
    at = np.arange(rows)
    value = scores[np.arange(length)[:, None], at, gold].sum(axis=0) + model.move[gold[:-1], gold[1:]].sum(axis=0)
    d_scores = np.exp(alpha + beta - total[:, None])
    d_scores[np.arange(length)[:, None], at, gold] -= 1
    pairs = np.exp(alpha[:-1, :, :, None] + model.move + (scores + beta)[1:, :, None, :] - total[:, None, None])
    d_move = pairs.sum(axis=(0, 1))
    np.add.at(d_move, (gold[:-1], gold[1:]), -1)
    d_scores /= rows
    d_states = np.einsum("trk,dhk->dtrh", d_scores, model.output)
    d_hidden = np.stack([d_states[0], d_states[1, ::-1]])
    d_table, d_recur = np.zeros_like(model.table), np.zeros_like(model.recur)
    d_h, d_c = np.zeros_like(h), np.zeros_like(c)
    for t in range(length - 1, -1, -1):
        last, before, i, f, o, new, top = kept[t]
        d_h = d_h + d_hidden[:, t]
        d_c = d_c + d_h * o * (1 - top * top)
        z = np.concatenate([d_c * new * i * (1 - i), d_c * before * f * (1 - f), d_h * top * o * (1 - o), d_c * i * (1 - new * new)], axis=-1)
        for d in range(2):
            np.add.at(d_table[d], ids[d, :, t], z[d])
        d_recur += np.swapaxes(last, 1, 2) @ z
        d_h, d_c = z @ np.swapaxes(model.recur, 1, 2), d_c * f
    d_output = np.einsum("dtrh,trk->dhk", states, d_scores)
    return float((total - value).mean()), [d_table, d_recur, d_output, d_scores.sum(axis=(0, 1)), d_move / rows]


def train(chars: np.ndarray, tags: np.ndarray, *, steps: int = STEPS, seed: int = SEED) -> Tagger:
    """Adam on batches of which half have a tagged character, where there are such windows."""
    model, draw = Tagger.random(seed), np.random.default_rng(seed + 1)
    params = [model.table, model.recur, model.output, model.offset, model.move]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    tagged = np.flatnonzero(tags.any(axis=1))
    for step in range(1, steps + 1):
        pick = draw.integers(0, len(chars), BATCH)
        if len(tagged):
            pick[: BATCH // 2] = draw.choice(tagged, BATCH // 2)
        _, grads = loss_and_gradients(model, chars[pick], tags[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 5 / (norm + 1e-9)) if step < 0.7 * steps else 0.005 * min(1.0, 5 / (norm + 1e-9))
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def training_windows(docs: DataFrame, *, sample: int = TRAIN_DOCS, per_doc: int = WINDOWS_PER_DOC) -> DataFrame:
    """``chars, tags`` of windows of about ``sample`` documents: some around base spans, one anywhere.

    Rows are drawn by a hash of id and text.  Equal rows are drawn together, so the draw may be larger;
    at most ``sample * (per_doc + 1)`` windows are returned in any case.
    """
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL AND text <> ''")
    drawn = hash_sample(rows, sample, SEED)

    def windows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            chars, tags = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                draw = np.random.default_rng([SEED, zlib.crc32(str(doc_id).encode())])
                spans = base_spans(text)
                label = np.zeros(len(text) + TRAIN_WINDOW, np.uint8)
                for kind, a, b in spans:
                    label[a:b] = kind + 1
                codes = np.concatenate([char_classes(text), np.full(TRAIN_WINDOW, 10, np.uint8)])
                near = [spans[i] for i in draw.permutation(len(spans))[: per_doc - 1]]
                middles = [(a + b) // 2 for _, a, b in near] + [int(draw.integers(0, len(text)))]
                numbers = [m.start() for m in _DIGIT.finditer(text) if not label[m.start()]]
                if numbers:  # numbers that are none of the kinds teach the most
                    middles.append(numbers[int(draw.integers(0, len(numbers)))])
                for middle in middles:
                    at = max(0, min(middle - int(draw.integers(0, TRAIN_WINDOW)), len(text) - 1))
                    chars.append(codes[at : at + TRAIN_WINDOW].tobytes())
                    tags.append(label[at : at + TRAIN_WINDOW].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(chars, pa.binary()), pa.array(tags, pa.binary())], ["chars", "tags"])

    found = drawn.mapInArrow(windows, "chars binary, tags binary")
    return found.orderBy(F.xxhash64(F.lit(SEED), "chars", "tags")).limit(sample * (per_doc + 1))


def fit_tagger(docs: DataFrame, workspace: Workspace, *, steps: int = STEPS, **settings) -> Scorer | None:
    """Train from labelled spans; the driver gets the bounded sample. None where there is no text."""
    sample = workspace.write(training_windows(docs, **settings), "training-windows")
    rows = sorted((bytes(r.chars), bytes(r.tags)) for r in sample.collect())
    if not rows:
        return None
    chars, tags = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, TRAIN_WINDOW) for x in zip(*rows, strict=True))
    return train(chars, tags, steps=steps).for_scoring()


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def pii_digest(docs: DataFrame, tagger: Scorer | None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_tagged`` of every whole text.

    Null counts as empty, which has no spans.  Rows are independent of each other: repeated rows and
    null ids have a row each.  ``n_tagged`` counts the spans that the tagger adds.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # a few thousand numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(iter([batch]), "text", _CHUNK):
                base, more = all_spans(shared.value, [t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     *(pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in range(len(KINDS))),
                     pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x in base], pa.string()),
                     pa.array([_joined(x + y) for x, y in zip(base, more, strict=True)], pa.string()),
                     pa.array(list(map(len, more)), pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_tagged"],
                )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_tagged bigint")
