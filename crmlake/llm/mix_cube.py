"""Mixing of sources to target weights by cube-method balanced sampling.

Every source has a target, its share by weight of all words, at most ``most`` times its own words. A
source that is to give ``r`` times its words takes every document floor(r) times; one copy more is taken
with the fraction as inclusion probability. Which documents give that copy is decided by the cube method:
of three undecided documents the probabilities move along the vector that leaves the sums of documents
and of words as they are, at random in one of its two directions, until one of them is 0 or 1 and another
document takes its place. This flight runs in chunks of a source; what each leaves undecided (two
documents) is gathered by later, ever fewer flights. The landing takes what the last one leaves and a few
documents held back, two for each power of two of a size, and picks the subset that comes nearest to the
words that are still owed; a few documents more or fewer than owed may be taken for that, at a price.

The order of the documents within a source is a hash of id and size; documents alike in both give alike
rows, so reruns agree whatever the partitioning.

Defined cases: a null text has size 0; documents without words are taken 0 words; a null id is a value
like any other and a null source is a source, the last one; repeated rows are documents of their own; an empty table gives no
rows; further columns are not looked at. A source of a few documents comes as near as whole documents allow.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.running import positions

WEIGHTS = (1, 2, 3)
MOST = 3.0
#: Documents of one flight, and how many flights' leftovers make another.
CHUNK = 4096
GATHERED = 128
SEED = 20240115
#: Sources up to this number are broadcast beside their documents; a row is a name and four numbers.
BROADCAST_SOURCES = 10_000
#: Most documents of a source that are held back for the landing.
HELD = 24
#: What a document beyond the owed number costs in the landing, in documents of the mean size.
EXTRA, EXTRA_COST = 6, 0.1
_NEAR = 1e-9

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(doc_id, source, size): the number of words of every text."""
    count = F.regexp_count(F.col(f"`{text_column}`").cast("string"), F.lit(WORD)).cast("long")
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.col(f"`{source_column}`").cast("string").alias("source"),
                       F.coalesce(count, F.lit(0)).alias("size"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_rank, source_size, n_docs, target) of each source, as a checkpoint.

    Sources are numbered by code point, null last, without one task that sorts them all. A source whose
    share exceeds ``most`` times its size stops there and the excess goes to the others by weight, which
    is repeated until no share exceeds; each round is one sum over the sources.
    """
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
               .withColumn("all", F.lit(0)))
    ranked = positions(sources, "all", [F.col("source").isNull(), F.col("source")], "source_rank").drop("all")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).checkpoint()
    share, stopped = 0.0, None
    while True:
        over = F.col("source_size") * most < F.col("weight") * share
        n, free, held, total = ranked.agg(
            F.count_if(over), F.sum(F.when(~over, F.col("weight"))),
            F.sum(F.when(over, F.col("source_size"))), F.sum("source_size")).first()
        if n == stopped or not free:
            break
        stopped, share = n, (total - most * (held or 0)) / free
    return ranked.withColumn("target", F.when(F.col("source_size") * most < F.col("weight") * share, F.col("source_size") * most)
                             .otherwise(F.col("weight") * share)).drop("weight")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, id_column: str = "doc_id",
        text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document."""
    sized = sizes(docs, id_column, text_column, source_column).checkpoint()
    told = targets(sized, weights, most).checkpoint()
    n_sources, longest = told.agg(F.count("*"), F.max("n_docs")).first()
    # a source may hold any part of all documents; the join is one that adaptive execution splits
    side = F.broadcast(told) if n_sources <= BROADCAST_SOURCES else told
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    joined = (sized.join(side.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")))
              .drop("its_source").withColumn("ratio", ratio)
              .withColumn("whole", F.floor("ratio")).withColumn("prob", F.col("ratio") - F.floor("ratio"))
              .withColumn("order", F.xxhash64("doc_id", "size", F.lit(SEED)))
              .select("doc_id", "source", "source_rank", "size", "source_size", "target", "whole", "prob", "order"))
    open_ = (F.col("size") > 0) & (F.col("prob") > 0)
    rest = joined.where(~open_)
    units = positions(joined.where(open_), "source_rank", [F.col("order"), F.col("doc_id"), F.col("size")], "at")
    units = units.withColumn("chunk", F.floor(F.col("at") / CHUNK).cast("long")).withColumn("held", F.lit(False))
    schema = units.schema
    chunks, level, decided = max(1, math.ceil((longest or 0) / CHUNK)), 0, []
    while True:
        last = chunks == 1
        flown = units.groupBy("source_rank", "chunk").applyInArrow(_flight(level, last), schema).checkpoint()
        undecided = F.col("held") | ((F.col("prob") > 0) & (F.col("prob") < 1))
        decided.append(flown.where(~undecided))
        if last:
            break
        units = flown.where(undecided).withColumn("chunk", F.floor(F.col("chunk") / GATHERED).cast("long"))
        chunks, level = math.ceil(chunks / GATHERED), level + 1
    names = ["doc_id", "source", "size", "source_size", "target", "whole", "prob"]
    out = rest.select(*names[:-1], F.lit(0.0).alias("prob"))
    for part in decided:
        out = out.unionByName(part.select(*names))
    copies = (F.col("whole") + F.round("prob")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def _flight(level: int, last: bool):
    """The flight of one chunk; after the last one the source lands and nothing stays undecided."""

    def fly(key: tuple, table: pa.Table) -> pa.Table:
        rank, chunk = (k.as_py() for k in key)
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("size", "ascending"), ("at", "ascending")])
        size = table["size"].to_numpy().astype(float)
        prob = table["prob"].to_numpy().copy()
        held = table["held"].to_numpy(zero_copy_only=False).copy()
        if level == 0 and chunk == 0:
            held[_sample(size)] = True
        rng = np.random.Generator(np.random.PCG64([SEED, rank, chunk, level]))
        move(size, prob, np.flatnonzero(~held), rng)
        if last:
            land(size, prob, np.flatnonzero(held | ((prob > 0) & (prob < 1))))
            held[:] = False
        for name, values in (("prob", pa.array(prob)), ("held", pa.array(held))):
            table = table.set_column(table.schema.get_field_index(name), name, values)
        return table

    return fly


def _sample(size: np.ndarray) -> np.ndarray:
    """The first document of each power of two, then the second ones."""
    octave = np.frexp(size)[1]
    first = np.unique(octave, return_index=True)[1]
    others = np.setdiff1d(np.arange(len(size)), first)
    second = others[np.unique(octave[others], return_index=True)[1]]
    return np.concatenate([first, second])[:HELD]


def move(size: np.ndarray, prob: np.ndarray, units: np.ndarray, rng: np.random.Generator) -> None:
    """Move the probabilities of ``units`` to 0 or 1 until two are left; both sums stay as they are."""
    draws = rng.random(len(units) + 1).tolist()
    z, p = size.tolist(), prob.tolist()
    active: list[int] = []
    for at in units.tolist():
        if not 0 < p[at] < 1:
            continue
        active.append(at)
        while len(active) == 3:
            a, b, c = active
            u = (z[b] - z[c], z[c] - z[a], z[a] - z[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[k]) / v if v > 0 else p[k] / -v for k, v in zip(active, u) if v)
            down = min(p[k] / v if v > 0 else (1 - p[k]) / -v for k, v in zip(active, u) if v)
            step = up if draws[-1] * (up + down) < down else -down
            draws.pop() if len(draws) > 1 else None
            for k, v in zip(active, u):
                moved = p[k] + step * v
                p[k] = 0.0 if moved < _NEAR else 1.0 if moved > 1 - _NEAR else moved
            active = [k for k in active if 0 < p[k] < 1]
    prob[:] = p


def land(size: np.ndarray, prob: np.ndarray, units: np.ndarray) -> None:
    """Decide ``units``: the subset whose words come nearest to the words owed, in documents of the mean size,
    plus the cost of documents beyond the owed number, rounded up or down. Two halves of the units are
    enumerated and matched by sorting."""
    if not len(units):
        return
    owed, number, mean = float((prob[units] * size[units]).sum()), float(prob[units].sum()), float(size[units].mean())
    halves = [units[0::2], units[1::2]]
    sums, counts = [], []
    for half in halves:
        bits = (np.arange(1 << len(half))[:, None] >> np.arange(len(half))) & 1
        sums.append(bits @ size[half] if len(half) else np.zeros(1))
        counts.append(bits.sum(1) if len(half) else np.zeros(1, int))
    least, most = math.floor(number + _NEAR), math.ceil(number - _NEAR)
    best = None
    for total in range(max(0, least - EXTRA), min(len(units), most + EXTRA) + 1):
        price = EXTRA_COST * max(0, least - total, total - most)
        for k in range(max(0, total - len(halves[1])), min(total, len(halves[0])) + 1):
            one, two = np.flatnonzero(counts[0] == k), np.flatnonzero(counts[1] == total - k)
            two = two[np.argsort(sums[1][two], kind="stable")]
            wanted = owed - sums[0][one]
            place = np.searchsorted(sums[1][two], wanted)
            for side in (np.clip(place - 1, 0, len(two) - 1), np.clip(place, 0, len(two) - 1)):
                off = np.abs(sums[1][two][side] - wanted) / mean + price
                at = int(off.argmin())
                if best is None or off[at] < best[0] - _NEAR:
                    best = (float(off[at]), int(one[at]), int(two[side[at]]))
    for half, mask in zip(halves, best[1:]):
        prob[half] = (mask >> np.arange(len(half))) & 1
