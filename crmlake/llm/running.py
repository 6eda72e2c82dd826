"""Running values of a sorted table that no group has to gather in one task for.

A key with very many rows (one conversation, one source) is spread over tasks by its order. Every task
tells where its rows begin and end, a few values for each task; what a key brings along from the tasks
before is worked out of these and handed to the task that goes on with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from crmlake.llm.shared import temporary

#: Chains are numbers below this prime; a chain times BASE plus the next digest is the next chain.
PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D9E3779B97F4A7C15F39CC0B % PRIME


def positions(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """``df`` with the row's number within its key, from 0, in ``order``. Rows alike in key and order are
    numbered in any order. The result reads a checkpoint and is sorted by key and order."""
    return _running(df, key, order, out, None, None)


def chains(df: DataFrame, key: str, order: list[Column], digest: str, amount: str, before: str, after: str,
           amount_before: str) -> DataFrame:
    """``df`` with what stands for all ``digest`` (hex strings) of a key up to a row, without it and with it,
    as hex strings, and the sum of ``amount`` over the rows before. The chain before a first row is empty."""
    number, = temporary("number", avoid=df.columns)
    return _running(df, key, order, number, (digest, amount), (before, after, amount_before)).drop(number)


def _running(df, key, order, out, read, write) -> DataFrame:
    tie, part = temporary("tie", "part", avoid=[*df.columns, out, *(write or ())])
    by = [F.col(key), *order]
    # the last column parts rows that are alike in all others. Rows carry the number of their task: the result is
    # worked out again wherever it is read, and below a union or a coalesce the tasks have other numbers
    sorted_ = (df.withColumn(tie, F.monotonically_increasing_id())
               .repartitionByRange(*by, F.col(tie)).sortWithinPartitions(*by).drop(tie)
               .withColumn(part, F.spark_partition_id()).checkpoint())
    key_type = sorted_.schema[key].dataType
    seen = StructType([StructField("part", LongType()), StructField("first", key_type), StructField("last", key_type),
                       StructField("whole", LongType()), StructField("n", LongType()),
                       StructField("chain", StringType()), StructField("amount", LongType())])
    ends = sorted_.select(key, part, *(read or ())).mapInArrow(lambda batches: _ends(batches, key, part, read), seen)
    brought = _brought(ends.collect())  # one row of a few numbers for each task
    added = [StructField(out, LongType())]
    if write:
        added += [StructField(write[0], StringType()), StructField(write[1], StringType()),
                  StructField(write[2], LongType())]
    return sorted_.mapInArrow(lambda batches: _numbered(batches, key, part, read, brought),
                              StructType(sorted_.schema.fields + added)).drop(part)


def _brought(rows: list) -> dict:
    """For each task whose first key began before it: the rows, chain and amount of that key so far."""
    out, last = {}, None
    for row in sorted(rows, key=lambda r: r["part"]):
        own = (row["n"], int(row["chain"], 16), row["amount"])
        if last is not None and last[0] == row["first"]:
            out[row["part"]] = last[1]
            if row["whole"]:
                own = _join(last[1], own)
        last = (row["last"], own)
    return out


def _join(one: tuple, two: tuple) -> tuple:
    return one[0] + two[0], (one[1] * pow(BASE, two[0], PRIME) + two[1]) % PRIME, one[2] + two[2]


def _groups(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each run of equal keys."""
    codes = keys.dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices
    codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
    return starts, np.diff(np.append(starts, len(codes)))


class _State:
    """The key that is open, with its rows, chain and amount so far."""

    def __init__(self, brought: tuple | None):
        self.brought, self.begun, self.key, self.groups = brought, False, None, 0
        self.n, self.chain, self.amount = 0, 0, 0

    def enter(self, key) -> None:
        if self.begun and key == self.key:
            return
        self.n, self.chain, self.amount = (self.brought or (0, 0, 0)) if not self.begun else (0, 0, 0)
        self.key, self.begun = key, True
        self.groups += 1


def _walk(batch: pa.RecordBatch, key: str, read: tuple | None, state: _State):
    """Columns of the batch: number, chain before, chain after, amount before."""
    keys = batch.column(batch.schema.get_field_index(key))
    starts, sizes = _groups(keys)
    numbers = np.arange(len(keys), dtype=np.int64) - np.repeat(starts, sizes)
    before, after = [], []
    if read:
        digests = batch.column(batch.schema.get_field_index(read[0])).to_pylist()
        amounts = pc.fill_null(batch.column(batch.schema.get_field_index(read[1])), 0).to_numpy(zero_copy_only=False)
        sums = np.concatenate([[0], np.cumsum(amounts)])
        held = np.zeros(len(keys), np.int64)
    for start, size in zip(starts.tolist(), sizes.tolist()):
        state.enter(keys[start].as_py())
        numbers[start:start + size] += state.n
        if read:
            held[start:start + size] = sums[start:start + size] - sums[start] + state.amount
            chain = state.chain
            for k in range(start, start + size):
                before.append("" if state.n + k - start == 0 else f"{chain:032x}")
                chain = (chain * BASE + int(digests[k][:30], 16)) % PRIME
                after.append(f"{chain:032x}")
            state.chain = chain
            state.amount += int(sums[start + size] - sums[start])
        state.n += size
    if read:
        return numbers, before, after, held
    return (numbers,)


def _part(batch: pa.RecordBatch, part: str) -> int:
    return batch.column(batch.schema.get_field_index(part))[0].as_py()


def _ends(batches: Iterator[pa.RecordBatch], key: str, part: str, read: tuple | None) -> Iterator[pa.RecordBatch]:
    state, first, number = _State(None), None, None
    for batch in batches:
        if batch.num_rows:
            if not state.begun:
                first, number = batch.column(batch.schema.get_field_index(key))[0], _part(batch, part)
            _walk(batch, key, read, state)
    if state.begun:
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([first.as_py()], first.type),
             pa.array([state.key], first.type), pa.array([int(state.groups == 1)], pa.int64()),
             pa.array([state.n], pa.int64()), pa.array([f"{state.chain:x}"]), pa.array([state.amount], pa.int64())],
            ["part", "first", "last", "whole", "n", "chain", "amount"])


def _numbered(batches: Iterator[pa.RecordBatch], key: str, part: str, read: tuple | None,
              brought: dict) -> Iterator[pa.RecordBatch]:
    state = None
    for batch in batches:
        if batch.num_rows:
            state = state or _State(brought.get(_part(batch, part)))
            numbers, *rest = _walk(batch, key, read, state)
            columns = [pa.array(numbers)]
            if rest:
                columns += [pa.array(rest[0], pa.string()), pa.array(rest[1], pa.string()), pa.array(rest[2])]
            names = [*batch.schema.names, *(f"_{k}" for k in range(len(columns)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)
