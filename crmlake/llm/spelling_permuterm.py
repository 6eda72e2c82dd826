"""Spelling variants of words by permuterm rotations.

A word ends in a mark; the rotations of ``word$`` are all its cyclic shifts. Two words that differ in one
replaced character have a rotation in which that character is the last, so both share the prefix before
it; where a character is inserted, that prefix is a whole rotation of the shorter word. Rotations are
therefore written with the edited character skipped, beside the whole ones, and sorted; a group of equal
ones holds at most one word for each letter of the alphabet and one whole rotation, 91 rows for the
letters used here, however large the vocabulary is. Every group is looked at once; each of its rows
emits its neighbours' number and the most frequent one, never a row for a pair.

Defined cases: a null text has no words; a null id counts as an empty string; repeated rows count each;
an empty table gives no rows; further columns are not looked at. A word inserted into a run of the same letter is counted at the first
letter of the run only, so no pair counts twice. Ties of frequency go to the word that is smaller by code
points.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from crmlake.llm.shared import release
from crmlake.llm.text_arrays import lower_ascii, ragged, slices

#: Shortest word, in code points, and least number of occurrences.
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent.
TIMES = 10
#: One in so many occurrences loses a letter.
DAMAGED = 31
#: Distinct words a task holds before it passes their counts on.
HELD = 400_000
#: Spans longer than this are hashed one by one.
_LONG = 64
_FULL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table.astype(np.uint32)


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of A-Z, a-z and U+00C0-U+00FF, in bytes, and the text it is in."""
    # in UTF-8 these are the ASCII letters and the pairs that begin with 0xC3
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    high = data == 0xC3
    letter |= high
    letter[1:] |= high[:-1]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = letter
    at = np.flatnonzero(inside[1:] != inside[:-1])
    joints = offsets[1:-1]
    joints = np.unique(joints[(joints > 0) & (joints < len(data))])
    glued = joints[inside[joints] & inside[joints + 1]]
    if len(glued):
        at = np.sort(np.concatenate([at, glued, glued]), kind="stable")
    starts, ends = at[0::2], at[1::2]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_crc32(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each span behind what ``begun`` is the crc32 of, a byte of all spans at a time."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -_LONG, "left"))
    for k in order[:long].tolist():
        out[k] = zlib.crc32(data[starts[k]:starts[k] + sizes[k]].tobytes(), int(begun[k]))
    rest = order[long:]
    state, first, size = begun[rest] ^ _FULL, starts[rest], sizes[rest]
    left = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for k, n in enumerate(left.tolist()):
        state[:n] = _CRC[(state[:n] ^ data[first[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[rest] = state ^ _FULL
    return out


def occurrences(ids: list, texts: pa.Array, damaged: int = DAMAGED, least: int = LEAST_LENGTH) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(words, counts) of a slice of texts after another; every word has ``least`` code points."""
    prefixes = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    for row, data, offsets in slices(texts):
        data = lower_ascii(data)
        starts, ends, text = letter_runs(data, offsets)
        marks = np.concatenate([[0], np.cumsum(data == 0xC3)])
        points = ends - starts - (marks[ends] - marks[starts])
        keep = points >= least
        starts, sizes, points = starts[keep], (ends - starts)[keep], points[keep]
        if not len(starts):
            continue
        crc = span_crc32(data, starts, sizes, prefixes[row + text[keep]])
        hit = crc % np.uint32(damaged) == 0
        changed = []
        for a, n, h, p in zip(starts[hit].tolist(), sizes[hit].tolist(), crc[hit].tolist(), points[hit].tolist()):
            if p > least:
                word = data[a:a + n].tobytes().decode()
                changed.append(word[:h % p] + word[h % p + 1:])
        starts, sizes = starts[~hit], sizes[~hit]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(sizes),
                                      [None, pa.py_buffer(bounds), pa.py_buffer(data[ragged(starts, sizes)])])
        counts = pa.concat_arrays([words, pa.array(changed, pa.large_string())]).value_counts()
        yield counts.field(0), counts.field(1)


def _counted(batches: Iterator[pa.RecordBatch], damaged: int, least: int) -> Iterator[pa.RecordBatch]:
    words, counts, held = [], [], 0

    def summed() -> pa.Table:
        table = pa.table({"word": pa.concat_arrays(words), "n": pa.concat_arrays(counts)})
        return table.group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        for w, n in occurrences(batch.column(0).to_pylist(), batch.column(1), damaged, least):
            words.append(w)
            counts.append(n)
            held += len(w)
        if held > HELD:
            table = summed()
            if 2 * len(table) > held:  # hardly any of them repeat
                yield from table.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches()
                words, counts, held = [], [], 0
            else:
                words, counts, held = [table["word"].combine_chunks()], [table["n"].combine_chunks()], len(table)
    if held:
        yield from summed().cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches()


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damaged: int = DAMAGED,
               least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the letter runs of all texts; one in ``damaged`` occurrences lacks a letter."""
    texts = docs.select(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`").cast("string"))
    counts = texts.mapInArrow(lambda batches: _counted(batches, damaged, least), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(key, letter, edge, n): rotations of ``word$``, with the last letter skipped or whole (letter '').

    ``edge`` says that the skipped letter differs from the one before it in the word.
    """
    size = F.length("word")
    cut = words.select("word", "n", F.explode(F.sequence(F.lit(0), 2 * size)).alias("at"))
    skips = F.col("at") < F.length("word")
    at = F.when(skips, F.col("at")).otherwise(F.col("at") - F.length("word"))
    letter = F.when(skips, F.substring("word", at + 1, F.lit(1))).otherwise("")
    tail = F.substring("word", F.when(skips, at + 2).otherwise(at + 1), F.length("word"))
    edge = skips & ((at == 0) | (F.substring("word", at, F.lit(1)) != letter))
    return cut.select(F.concat(tail, F.lit("$"), F.substring("word", F.lit(1), at)).alias("key"),
                      letter.alias("letter"), edge.alias("edge"), "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): for every group that a word is in, its near words there, their number and
    the most frequent one as a struct of its negated count and itself."""
    group = Window.partitionBy("key")
    rows = (rotations(words)
            .withColumn("all", F.collect_list(F.struct("letter", "edge", "n")).over(group))
            .where(F.size("all") > 1))
    head, tail = F.substring_index("key", "$", -1), F.substring_index("key", "$", 1)
    near = F.filter("all", lambda o: (o["letter"] != F.col("letter")) & (
        ((o["letter"] != "") & (F.col("letter") != "")) | (o["edge"] & (F.col("letter") == ""))
        | ((o["letter"] == "") & F.col("edge"))))
    best = F.array_min(F.transform("near", lambda o: F.struct(
        (-o["n"]).alias("less"), F.concat("head", o["letter"], "tail").alias("word"))))
    return (rows.withColumns({"near": near, "head": head, "tail": tail}).where(F.size("near") > 0)
            .select(F.concat("head", "letter", "tail").alias("word"), F.size("near").cast("long").alias("n_near"),
                    best.alias("best")))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table (word, n) of distinct words without ``$``.

    The form of a word is its most frequent near word, if that is at least ``times`` as frequent; the root
    is where its forms lead to.
    """
    words = words.select("word", "n").checkpoint()
    nothing = F.lit(None).cast("struct<less: bigint, word: string>")
    told = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), nothing.alias("best")).unionByName(
        neighbours(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best"))
    summed = told.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    formed = -F.col("best.less") >= times * F.col("n")
    out = summed.select("word", "n", "n_near", F.when(formed, F.col("best.word")).alias("form"),
                        F.when(formed, -F.col("best.less")).alias("form_n")).checkpoint()
    release(words.sparkSession)
    links = out.where("form is not null").select("word", F.col("form").alias("root"))
    # every form is ``times`` as frequent as its word: chains are short, and each round doubles the steps
    most = words.agg(F.max("n")).first()[0] or 0
    steps = 0
    while times ** (steps + 1) <= most:
        steps += 1
    for _ in range((steps - 1).bit_length() if steps > 1 else 0):
        links = links.checkpoint()
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return out.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
