"""Packing of token ids into training windows by bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's ids are placed as they come: whole
windows first, then the rest into the open window where it leaves the least room. Where it fits in
none, the fullest window is emitted; if that would waste more than ``slack`` ids, the window is
first filled up by a cut of the document. What a partition has left open at its end is merged with
the leftovers of its neighbours, and what a merge has left over is cut into windows of powers of two,
which need no padding.

Defined cases: a null or empty text is a document of the closing id alone; any columns beside the id
and the text are ignored, so clashing names do no harm; repeated rows are packed as often as they
occur; an empty table gives no piece; a text of any length is cut into as many windows as it needs.
A row with a null id is packed like any other and keeps its null.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.shared import public_file, with_text
from crmlake.llm.text_arrays import Known, slices, span_hashes, words

WINDOW = 4096
OPEN_WINDOWS = 64
SLACK = 16
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker remembers; a full table starts again.
KNOWN_WORDS = 600_000
#: Partitions whose leftovers are merged together, so a merge holds at most so many windows.
MERGED_PARTITIONS = 32
#: Where the numbers of merged partitions begin, above those of any first pass.
MERGED = 1 << 30

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, left_ids binary, left_docs binary, part long")

_workers: dict[str, tuple] = {}


def _tokenizer(path: str) -> tuple:
    """The tokenizer and what it made of words so far; kept by a Python worker between tasks."""
    if path not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _workers[path] = Tokenizer.from_file(path), Known(KNOWN_WORDS, kind=np.uint32)
    return _workers[path]


def token_ids(column: pa.Array, path: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ids of each text) slice by slice.

    White space never is inside a token, nor does it change what is beside it, so a text's ids are
    those of its words one after the other.
    """
    tokenizer, known = _tokenizer(path)

    def encode(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(
            [s.decode("utf-8", "replace") for s in spans], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes

    for first, data, offsets in slices(column):
        starts, ends, text = words(data, offsets)
        entries = known.find(data, starts, ends, span_hashes(data, starts, ends), encode)
        ids, sizes = known.runs(entries)
        cuts = np.cumsum(np.bincount(text, weights=sizes, minlength=len(offsets) - 1)).astype(np.int64)
        yield first, np.split(ids, cuts[:-1])


class OpenWindows:
    """A fixed number of open windows; ``emit`` is called with each window that closes."""

    def __init__(self, emit, window: int = WINDOW, most: int = OPEN_WINDOWS, slack: int = SLACK):
        self.emit, self.window, self.most, self.slack = emit, window, most, slack
        self.open: list[list] = []
        self.room = np.zeros(0, np.int64)

    def place(self, doc_id, ids: np.ndarray, start: int, total: int) -> None:
        """Place ids [start:] of a document of ``total`` ids."""
        while len(ids) - start >= self.window:
            self.emit([(doc_id, start, ids[start:start + self.window], total)])
            start += self.window
        while (size := len(ids) - start) > 0:
            fits = np.flatnonzero(self.room >= size)
            if len(fits):
                at = int(fits[np.argmin(self.room[fits])])
                self._put(at, (doc_id, start, ids[start:], total))
                return
            if len(self.open) < self.most:
                self.open.append([])
                self.room = np.append(self.room, self.window)
                continue
            at = int(np.argmin(self.room))
            room = int(self.room[at])
            if room > self.slack:
                self._put(at, (doc_id, start, ids[start:start + room], total))
                start += room
            else:
                self._close(at)

    def _put(self, at: int, piece: tuple) -> None:
        self.open[at].append(piece)
        self.room[at] -= len(piece[2])
        if not self.room[at]:
            self._close(at)

    def _close(self, at: int) -> None:
        self.emit(self.open.pop(at))
        self.room = np.delete(self.room, at)

    def merge(self) -> list[tuple]:
        """Fill the fullest windows from the emptiest until less than one window is left; its pieces."""
        order = np.argsort(self.room, kind="stable")
        queue = [p for at in order for p in self.open[at]]
        self.open, self.room = [], np.zeros(0, np.int64)
        return cut(queue, self.window, self.emit)


def cut(pieces: list[tuple], window: int, emit) -> list[tuple]:
    """Emit whole windows of the pieces one after the other; the pieces of the unfilled last."""
    filled, held = [], 0
    for doc_id, start, ids, total in pieces:
        while len(ids):
            take = min(len(ids), window - held)
            filled.append((doc_id, start, ids[:take], total))
            start, ids, held = start + take, ids[take:], held + take
            if held == window:
                emit(filled)
                filled, held = [], 0
    return filled


def powers_of_two(pieces: list[tuple], emit) -> None:
    """Emit pieces as windows of powers of two, the largest first."""
    size = sum(len(ids) for _, _, ids, _ in pieces)
    while size:
        window = 1 << (size.bit_length() - 1)
        emitted = []
        rest = cut(pieces, window, emitted.append)
        emit(emitted[0])
        pieces, size = rest, size - window


class _Rows:
    """Piece rows of emitted windows, numbered within a partition."""

    def __init__(self, part: int):
        self.part, self.number, self.rows = part, 0, []

    def emit(self, pieces: list[tuple]) -> None:
        offset, sequence = 0, (self.part << 32) + self.number
        self.number += 1
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
            self.rows.append((doc_id, start, len(ids), crc, total, sequence, offset, None, None, self.part))
            offset += len(ids)

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SCHEMA = pa.schema([(n, pa.binary() if n.startswith("left") else pa.int64())
                     for n in (c.split()[0] for c in PIECES.split(", "))])


def _left_row(rows: _Rows, left: list[tuple]) -> None:
    """All leftover pieces of a partition as one row: their ids, and (id, start, length, total)."""
    if left:
        docs = np.array([(d is None, d or 0, s, len(i), t) for d, s, i, t in left], "<i8")
        ids = np.concatenate([i for _, _, i, _ in left]).astype("<u4")
        rows.rows.append((None,) * 7 + (ids.tobytes(), docs.tobytes(), rows.part))


def _read_left(ids: bytes, docs: bytes) -> Iterator[tuple]:
    tokens, at = np.frombuffer(ids, "<u4"), 0
    for null, doc_id, start, length, total in np.frombuffer(docs, "<i8").reshape(-1, 5).tolist():
        yield None if null else doc_id, start, tokens[at:at + length], total
        at += length


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, slack: int = SLACK, id_column: str = "doc_id",
         text_column: str = "text", path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` is the vocabulary file as every executor sees it (by default that of the installed
    public tokenizers). The pieces of the first pass are checkpointed, so texts are read once.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(TaskContext.get().partitionId())
        bins = OpenWindows(rows.emit, window, open_windows, slack)
        file = path or public_file(vocabulary)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in token_ids(batch.column(1), file):
                for k, ids in enumerate(texts):
                    whole = np.concatenate([ids, end])
                    bins.place(doc_ids[first + k], whole, 0, len(whole))
            yield rows.take(_SCHEMA)
        _left_row(rows, bins.merge())
        yield rows.take(_SCHEMA)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive in order of their group; less than two windows of a group are held."""
        rows, group, left = _Rows(0), None, []
        for batch in batches:
            for part, ids, docs in zip(*(batch.column(n).to_pylist() for n in ("part", "left_ids", "left_docs"))):
                if part // MERGED_PARTITIONS != group:
                    powers_of_two(left, rows.emit)
                    group, left = part // MERGED_PARTITIONS, []
                    rows.part, rows.number = MERGED + group, 0
                left = cut(left + list(_read_left(ids, docs)), window, rows.emit)
            yield rows.take(_SCHEMA)
        powers_of_two(left, rows.emit)
        yield rows.take(_SCHEMA)

    first = with_text(docs, id_column, text_column).mapInArrow(packed, PIECES).checkpoint()
    left = (first.where("left_ids IS NOT NULL").select("left_ids", "left_docs", "part")
            .withColumn("part_group", F.expr(f"part div {MERGED_PARTITIONS}"))
            .repartition("part_group").sortWithinPartitions("part_group", "part"))
    names = [c.split()[0] for c in PIECES.split(", ")][:7]
    return (first.where("left_ids IS NULL").select(*names)
            .unionByName(left.mapInArrow(merged, PIECES).select(*names)))
