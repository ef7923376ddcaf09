"""Token ids in Arrow files of fixed-size lists.

Documents are range-partitioned and sorted by doc_id; each partition is encoded and written as one
shard, a pair of Arrow IPC files below a shared folder:

* ``*.arrow``: record batches of ``input_ids`` (fixed_size_list of unsigned ids) and ``attention_mask``
  (fixed_size_list of booleans, false on the padding that ends a shard).  The shard's ids run through
  the sequences without gaps, so sequence i is row i % n of batch i // n, read without a copy from a
  memory map.
* ``*.docs.arrow``: ``doc_id, start, n_tokens`` of each document within the shard.

A task writes files of a name of its own and reports them; only those of successful tasks enter the
manifest table, so lost executors and repeated tasks do no harm.

Encoding is byte-level BPE with a split before every single space between two other characters, where
the tokenizer splits too.  Arrow splits the texts and names equal pieces once per slice, so Python sees each
different piece once.  Each worker keeps the ids of the first ``CACHE_PIECES`` it meets.  Of the others, plain words go
straight to the tokenizer's model; the rest is encoded by the whole tokenizer, many in one call, with a token
between them that it always cuts out.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palisade.llm.tables import Workspace, slices

END_ID = 2
SEQUENCE = 1024
BATCH_SEQUENCES = 64
CACHE_PIECES = 200_000
CACHE_LENGTH = 64
JOINED_PIECES = 512
ENCODE_BYTES = 4 << 20


#: A piece begins with a single space or line break, or with the text, and goes on to the next space or
#: break that stands alone. The tokenizer cuts there too; it looks at other white space as runs, which
#: stay inside a piece.
_PIECE = re.compile(r"(?:\A\s*|[ \n])\S+(?:(?:\s{2,}|[^\S \n])\S+)*(?:\s+\Z)?|\A\s+\Z")
#: Marks that the tokenizer cuts off when they stand alone after letters, as it does a line break before them.
_MARKS = ".,;:!?"
_LETTERS_BEFORE = "\u0530"  # letters of the scripts up to there are letters in every version of Unicode in use
#: The signs by which byte-level models know the space and the bytes that UTF-8 has beyond ASCII.
_BYTE_SPACE = "\u0120"
_BYTE_LEVEL = {b: chr(0x143) if b == 0xAD else chr(0x122 + b - 0x80) for b in (*range(0x80, 0xA1), 0xAD)}
#: What a text has that is more than words with one space or line break between two of them.
_SPACES = "\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_UNEVEN = rf"[{_SPACES}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
#: A piece is named by what follows its space, or by itself after a line break; any other has this before it.
_BARE = "\x1f"


def _name(piece: str) -> str:
    if piece[:1] == " " and len(piece) > 1 and not piece[1].isspace():
        return piece[1:]
    return piece if piece[:1] == "\n" and len(piece) > 1 and not piece[1].isspace() else _BARE + piece


def _piece(name: str) -> str:
    if name[0] == _BARE:
        return name[1:]
    return name if name[0] == "\n" else " " + name


def _for_re2(text: str) -> str:
    return "".join(c if c.isalnum() and c.isascii() else rf"\x{{{ord(c):x}}}" for c in text)


class PieceEncoder:
    """Ids of whole texts, equal to the tokenizer's own, from ids of pieces.

    Only byte-level BPE with its usual pattern cuts texts at single spaces; for other tokenizers each
    text is encoded as it is.
    """

    def __init__(self, path: str, *, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder()
        added = [re.escape(t.content) for t in tokens.values()]
        self.added = re.compile("|".join(added)) if added else None  # such a string in a text is one token, no pieces
        self.added_re2 = "|".join(_for_re2(t.content) for t in tokens.values())
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.split = "use_regex=True" in str(self.tokenizer.pre_tokenizer) and self.tokenizer.normalizer is None
        #: A string that is a token wherever it stands, and its id: it keeps joined pieces apart.
        alone = ((t.content, i) for i, t in tokens.items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word))
        self.mark = next(alone, None)
        self.model = self.tokenizer.model
        #: Letters can go to the model alone where the tokenizer does nothing else to them.
        self.words = self.split and type(self.model).__name__ == "BPE" and str(self.tokenizer.pre_tokenizer).startswith("ByteLevel")
        self.line, *marks = self._ids(["\n", *_MARKS])
        self.marks = {"": b"", **dict(zip(_MARKS, marks, strict=True))}
        self.cache: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind.char, x.ids).tobytes() for x in found]

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The same for pieces, which hold no added token: many in one call, with such a token between them."""
        if self.mark is None:
            return [x for at in range(0, len(pieces), 4096) for x in self._ids(pieces[at : at + 4096])]
        text, mark = self.mark
        out, width = [], self.kind.itemsize
        for at in range(0, len(pieces), JOINED_PIECES):
            joined = text.join(pieces[at : at + JOINED_PIECES])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            cuts, raw = np.flatnonzero(ids == mark), ids.tobytes()
            starts, ends = [0, *((cuts + 1) * width).tolist()], [*(cuts * width).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip(starts, ends, strict=True)]
        return out

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, set[str]]:
        """The names of the texts' pieces, one text after the other, their number in each text, and which hold an added token."""
        whole = set()
        plain = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.match_substring_regex(texts, _UNEVEN)))
        if self.added:
            plain = pc.and_(plain, pc.invert(pc.match_substring_regex(texts, self.added_re2)))
        even = pc.binary_join_element_wise(_BARE, pc.replace_substring(texts, "\n", " \n"), "")
        lists = pc.split_pattern(pc.if_else(plain, even, None), " ")
        if plain.false_count:
            others = lists.to_pylist()
            for i in pc.indices_nonzero(pc.invert(plain)).to_pylist():
                text = texts[i].as_py()
                # a text with an added token is one piece, which the tokenizer looks at as a whole
                added = self.added and self.added.search(text)
                others[i] = [_name(p) for p in ([text] if added else _PIECE.findall(text))]
                whole.update(others[i] if added else [])
            lists = pa.array(others, pa.list_(pa.string()))
        return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), whole

    def _ids_of_word(self, word: str, space: str = "") -> bytes | None:
        """The ids of letters with one mark at most after them: the tokenizer gives its model the letters as one word."""
        letters, mark = (word[:-1], word[-1]) if word[-1:] in self.marks else (word, "")
        if not (letters.isalpha() and (letters.isascii() or max(letters) < _LETTERS_BEFORE)):
            return None
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return array(self.kind.char, [x.id for x in self.model.tokenize(space + letters)]).tobytes() + self.marks[mark]

    def _ids_of_names(self, names: list[str], whole: set[str]) -> list[bytes]:
        """The ids of different pieces; those that are met first are kept.  ``whole`` ones go to the tokenizer as they are."""
        known = self.cache
        out = list(map(known.get, names))
        at = [i for i, x in enumerate(out) if x is None]
        rest = []
        for i in at:
            name, first = names[i], names[i][0]
            if name in whole:
                out[i] = self._ids([_piece(name)])[0]
            elif not self.words:
                rest.append(i)
            elif first == "\n" or first == _BARE:
                ids = self._ids_of_word(name[1:])
                out[i] = ids if ids is None or first == _BARE else self.line + ids
            else:
                out[i] = self._ids_of_word(name, _BYTE_SPACE)
            if out[i] is None:
                rest.append(i)
        for i, ids in zip(rest, self._ids_of_pieces([_piece(names[i]) for i in rest]), strict=True):
            out[i] = ids
        if len(known) < self.cache_pieces:  # frequent pieces come early; what is met later is met rarely
            known.update((names[i], out[i]) for i in at if len(names[i]) <= CACHE_LENGTH)
        return out

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and their number in each text.  Equal pieces are looked up once."""
        if not self.split:
            found = self._ids(texts.to_pylist())
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
            return np.frombuffer(b"".join(found), self.kind), sizes
        flat, pieces, whole = self._pieces(texts)
        coded = flat.dictionary_encode()
        rows = self._ids_of_names(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), whole)
        ids = np.frombuffer(b"".join(rows), self.kind)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // self.kind.itemsize
        ends = np.cumsum(sizes)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
        taken = lists.take(coded.indices).flatten().to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy()])])
        return taken, np.diff(upto[np.concatenate([[0], np.cumsum(pieces)])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``kind``."""
        ids, sizes = self.encode_array(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> PieceEncoder:
    """One encoder for all tasks of a worker, so that they share its pieces."""
    return PieceEncoder(path)


class ShardWriter:
    """Streams ids into one pair of files."""

    def __init__(self, folder: str, shard: int, kind: np.dtype, doc_type: pa.DataType, length: int, batch_sequences: int):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        self.length, self.kind, self.batch = length, kind, length * batch_sequences
        self.lists = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("attention_mask", pa.list_(pa.bool_(), length))])
        self.index = pa.schema([("doc_id", doc_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.files = [self.fs.open_output_stream(f"{base}/{self.name}{end}") for end in (".arrow", ".docs.arrow")]
        self.ids = pa.ipc.new_file(self.files[0], self.lists)
        self.docs = pa.ipc.new_file(self.files[1], self.index)
        self.held = np.empty(0, kind)
        self.total = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents' ids, one after the other, and their number in each document."""
        starts = self.total + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([doc_ids, pa.array(starts), pa.array(sizes)], schema=self.index))
        self.total += int(sizes.sum())
        self.n_docs += len(sizes)
        self.held = np.concatenate([self.held, ids])
        full = len(self.held) // self.batch * self.batch
        for at in range(0, full, self.batch):
            self._write(self.held[at : at + self.batch], self.batch)
        self.held = self.held[full:].copy()

    def _write(self, ids: np.ndarray, n: int) -> None:
        padded = np.zeros(n, self.kind)
        padded[: len(ids)] = ids
        self.ids.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(n) < len(ids)), self.length),
        ], schema=self.lists))

    def close(self) -> None:
        if len(self.held):
            self._write(self.held, -(-len(self.held) // self.length) * self.length)
        self.ids.close()
        self.docs.close()
        for f in self.files:
            f.close()


class ShardReader:
    """Random access to a shard: sequences, masks, and the ids of any range, from a memory map where there is one."""

    def __init__(self, folder: str, name: str):
        fs, base = pafs.FileSystem.from_uri(folder)
        local = isinstance(fs, pafs.LocalFileSystem)
        opened = pa.memory_map if local else fs.open_input_file
        self.ids = pa.ipc.open_file(opened(f"{base}/{name}.arrow"))
        self.docs = pa.ipc.open_file(opened(f"{base}/{name}.docs.arrow"))
        self.length = self.ids.schema.field("input_ids").type.list_size
        first = self.ids.get_batch(0).num_rows if self.ids.num_record_batches else 1
        self.per_batch = first
        self._last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._last[0] != i:
            self._last = (i, self.ids.get_batch(i))
        return self._last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i, the ids as a view."""
        batch, row = self._batch(i // self.per_batch), i % self.per_batch
        return batch.column(0)[row].values.to_numpy(), batch.column(1)[row].values.to_numpy(zero_copy_only=False)

    def ranges(self, start: int, size: int) -> Iterator[np.ndarray]:
        """Views that together hold the ids [start, start + size) of the shard."""
        step = self.per_batch * self.length
        while size > 0:
            ids = self._batch(start // step).column(0).flatten().to_numpy()
            got = ids[start % step : start % step + size]
            yield got
            start, size = start + len(got), size - len(got)


def write_token_files(
    docs: DataFrame, workspace: Workspace, path: str, *, end_id: int = END_ID, length: int = SEQUENCE,
    batch_sequences: int = BATCH_SEQUENCES, encoder: Callable[[str], PieceEncoder] = shared_encoder,
) -> DataFrame:
    """Write every whole text, ``end_id`` after each, in ascending doc_id order; returns the manifest.

    Manifest: ``shard, folder, name, n_docs, n_tokens``.  A null text is empty and has only its end id;
    a null doc_id comes first; rows that repeat a doc_id follow each other in the order of their texts.
    An empty table writes no file.
    """
    folder = workspace.path("tokens")
    if folder.startswith("file:"):
        folder = "file:///" + folder.removeprefix("file:").lstrip("/")
    elif "://" not in folder:
        folder = f"file://{folder}"

    def encode(batches):
        writer, coder = None, None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(iter([batch]), "text", ENCODE_BYTES):
                if writer is None:
                    pa.default_memory_pool().release_unused()  # what earlier stages of the worker have left
                    coder = encoder(path)
                    writer = ShardWriter(folder, shard, coder.kind, part.schema.field("doc_id").type, length, batch_sequences)
                ids, sizes = coder.encode_array(pc.fill_null(part.column("text"), ""))
                writer.add(part.column("doc_id"), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "folder": [folder], "name": [writer.name], "n_docs": [writer.n_docs], "n_tokens": [writer.total],
            })

    placed = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = "shard bigint, folder string, name string, n_docs bigint, n_tokens bigint"
    return workspace.write(placed.mapInArrow(encode, kind), "manifest")


def read_token_files(manifest: DataFrame, doc_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, shard``, all of it read from the files.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers.
    """
    # One row per shard file; the running total over them is a window over the manifest alone.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["folder"], row["name"])
                for i in range(shard.docs.num_record_batches):
                    index = shard.docs.get_batch(i)
                    crcs = []
                    for start, size in zip(index.column("start").to_pylist(), index.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for ids in shard.ranges(start, size):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    starts = pa.array(index.column("start").to_numpy() + row["before"])
                    yield pa.RecordBatch.from_arrays(
                        [index.column("doc_id"), starts, index.column("n_tokens"), pa.array(crcs, pa.int64()),
                         pa.array([row["shard"]] * index.num_rows, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    spread = shards.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInArrow(read, f"doc_id {doc_type}, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint")


def token_digest(docs: DataFrame, workspace: Workspace, path: str, **settings) -> DataFrame:
    """Write the token files and read them back: ``doc_id, start, n_tokens, ids_crc32, shard``."""
    manifest = write_token_files(docs, workspace, path, **settings)
    return read_token_files(manifest, docs.schema["doc_id"].dataType.simpleString())
