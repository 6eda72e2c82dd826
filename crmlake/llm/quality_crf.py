"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before and after it;
transitions between neighbouring lines are learned. The forward-backward probabilities of "good",
weighted by line length, make the document's score.

Features are shares and counts of characters and words in a line, cut into bins (``BINS``); all are
worked out by numpy over whole texts. The model is fitted on a bounded sample of the labelled
documents (``SAMPLE_PER_LABEL`` of each label, a run of at most ``SAMPLE_LINES`` lines from anywhere
in each); scores read whole texts.

Defined cases: a null or empty text is one empty line and scores as such; blank lines have length 1
in the weights; equal texts score alike; rows with a null label or a null id are not learned from;
further columns are ignored; without a labelled row every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.crf import Chain, Emissions, fit
from crmlake.llm.shared import with_text
from crmlake.llm.text_arrays import slices, span_hashes, words

SAMPLE_PER_LABEL = 1500
SAMPLE_LINES = 48
#: Upper ends of the bins of a share.
BINS = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
#: Upper ends of the bins of a count.
COUNT_BINS = np.array([0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 1024])
WIDTH = 12

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SYMBOL, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
_CLASS[:33] = _SPACE
_CLASS[[ord(c) for c in ".,;:?'\"()-!"]] = _MARK
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = _SYMBOL

SHARES = ("upper", "digit", "space", "mark", "symbol", "exclaim", "distinct", "repeats", "long words",
          "short words", "long and marked", "seen line")
COUNTS = ("words", "bytes")
OWN = len(SHARES) + len(COUNTS)
#: Own, previous and next line, and two cells for "no line before", "no line after".
CELLS = 3 * OWN * WIDTH + 2


def line_bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each feature [line, feature], bytes of each line, and the lines of each text (offsets).

    A text of k line feeds has k + 1 lines.
    """
    feeds = np.flatnonzero(data == 10)
    text = np.searchsorted(offsets, feeds, "right") - 1
    per_text = np.bincount(text, minlength=len(offsets) - 1) + 1
    cuts = np.concatenate([[0], np.cumsum(per_text)])
    n = int(cuts[-1])
    starts = np.empty(n, np.int64)
    starts[cuts[:-1]] = offsets[:-1]
    others = np.ones(n, bool)
    others[cuts[:-1]] = False
    starts[others] = feeds + 1
    ends = np.empty(n, np.int64)
    ends[cuts[1:] - 1] = offsets[1:]
    others[:] = True
    others[cuts[1:] - 1] = False
    ends[others] = feeds
    size = np.maximum(ends - starts, 1)

    kind = _CLASS[data]
    follows = np.flatnonzero(data == 0xC3) + 1  # Latin letters of two bytes
    follows = follows[follows < len(data)]
    capital = follows[(data[follows] >= 0x80) & (data[follows] <= 0x9E)]
    kind[capital - 1] = _UPPER
    kind[capital] = _UPPER

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (sums[ends] - sums[starts]) / size

    shares = [share(kind == k) for k in (_UPPER, _DIGIT, _SPACE, _MARK, _SYMBOL)]
    shares.append(share(data == ord("!")))

    ws, we, _ = words(data, offsets)
    line = np.searchsorted(starts, ws, "right") - 1
    h = span_hashes(data, ws, we)
    count = np.bincount(line, minlength=n)
    per = np.maximum(count, 1)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((h, line))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=n)
    length = we - ws
    marked = (kind[we - 1] == _MARK) | (kind[we - 1] == _SYMBOL) if len(we) else np.zeros(0, bool)
    whole = span_hashes(data, starts, ends)
    of = np.repeat(np.arange(len(per_text)), per_text)
    by = np.lexsort((np.arange(n), whole, of))
    seen = np.zeros(n)
    again = (whole[by][1:] == whole[by][:-1]) & (of[by][1:] == of[by][:-1])
    seen[by[1:][again]] = 1
    seen[ends == starts] = 0
    shares += [1 - distinct / per, np.bincount(line[same], minlength=n) / per,
               np.bincount(line[length >= 7], minlength=n) / per,
               np.bincount(line[length <= 3], minlength=n) / per,
               np.bincount(line[(length >= 7) & marked], minlength=n) / per, seen]
    shares[6][count == 0] = 0
    bins = [np.searchsorted(BINS, s, "left") for s in shares]
    bins += [np.searchsorted(COUNT_BINS, c, "left") for c in (count, ends - starts)]
    return np.stack(bins, 1).astype(np.uint8), size, cuts


def cells(bins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Weight cells [line, feature] of lines with their neighbours in the same text."""
    n = len(bins)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    full = np.diff(cuts) > 0
    first[cuts[:-1][full]] = True
    last[cuts[1:][full] - 1] = True
    own = np.arange(OWN) * WIDTH + bins.astype(np.int64)
    block = OWN * WIDTH
    before, after = np.roll(own, 1, 0) + block, np.roll(own, -1, 0) + 2 * block
    before[first] = 3 * block
    after[last] = 3 * block + 1
    return np.concatenate([own, before, after], 1)


@dataclass
class Model:
    weights: np.ndarray
    chain: Chain

    def score(self, bins: np.ndarray, size: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Length-weighted mean probability of "good" of each text's lines."""
        found = cells(bins, cuts)
        scores = np.stack([self.weights[found, k].sum(1) * found.shape[1] ** -0.5 for k in (0, 1)], 1)
        good = self.chain.marginals(scores, cuts)[:, 1]
        total = np.add.reduceat(size.astype(float), cuts[:-1])
        return np.clip(np.add.reduceat(good * size, cuts[:-1]) / total, 0, 1)


def train(texts: list[tuple[int, np.ndarray]]) -> Model | None:
    """A model from (label, bins of consecutive lines)."""
    if not texts:
        return None
    cuts = np.concatenate([[0], np.cumsum([len(b) for _, b in texts])])
    found = cells(np.concatenate([b for _, b in texts]), cuts)
    n, wide = found.shape
    labels = np.repeat([label for label, _ in texts], np.diff(cuts))
    weights, chain = fit(Emissions(found.ravel(), np.full(n * wide, wide ** -0.5), np.arange(n + 1) * wide),
                         np.arange(n), labels, cuts, CELLS, 2, rounds=120, rate=0.5)
    return Model(weights, chain)


def learn(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """A model from documents joined to their label (0 or 1), from about ``per_label`` rows of each."""
    rows = labelled.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                           F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
                           F.col(f"`{label_column}`").cast("int").alias("label"))
    rows = rows.where("doc_id IS NOT NULL AND label IN (0, 1)")

    def bins(batches):
        for batch in batches:
            out = []
            keys, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, data, offsets in slices(batch.column(1)):
                found, _, cuts = line_bins(data, offsets)
                for k in range(len(offsets) - 1):
                    lines = found[cuts[k]:cuts[k + 1]]
                    at = keys[first + k] * 2654435761 % max(1, len(lines) - SAMPLE_LINES + 1)
                    out.append((keys[first + k], labels[first + k], lines[at:at + SAMPLE_LINES].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.binary())], ["doc_id", "label", "bins"])

    found = rows.mapInArrow(bins, "doc_id long, label int, bins binary").limit(3 * per_label).collect()
    return train([(r["label"], np.frombuffer(r["bins"], np.uint8).reshape(-1, OWN))
                  for r in sorted(found, key=lambda r: (r["doc_id"], r["label"], bytes(r["bins"])))])


def sample(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
           per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Documents joined to a sample of the labels: of each label about ``per_label`` rows.

    Labels are counted, then kept where the hashed id is below the share that gives the sample. The
    sample is broadcast: a limit bounds it.
    """
    rows = labels.select(F.col(f"`{id_column}`").cast("long").alias(id_column),
                         F.col(f"`{label_column}`").cast("int").alias(label_column))
    rows = rows.where(f"`{id_column}` IS NOT NULL AND `{label_column}` IN (0, 1)")
    below = F.lit(0.0)
    for r in rows.groupBy(label_column).count().collect():
        below = F.when(F.col(label_column) == r[label_column], per_label / r["count"]).otherwise(below)
    u = F.pmod(F.xxhash64(id_column), F.lit(1 << 30)) / float(1 << 30)
    few = rows.where(u < below).limit(3 * per_label)
    return docs.select(id_column, "text").join(F.broadcast(few), id_column)


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches):
        model = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if model is not None:
                for first, data, offsets in slices(batch.column(1)):
                    scores[first:first + len(offsets) - 1] = model.score(*line_bins(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return with_text(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, score double, predicted int")


def keep(docs: DataFrame, model: Model | None, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if model is not None:
                for first, data, offsets in slices(batch.column(at)):
                    scores[first:first + len(offsets) - 1] = model.score(*line_bins(data, offsets))
            yield batch.filter(pa.array(scores >= least))

    at = docs.columns.index(text_column)
    return docs.mapInArrow(run, docs.schema)


def label_lines(text: str, model: Model) -> list[tuple[str, float]]:
    """(line, probability of good) of one text: the labels behind a score."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    bins, _, cuts = line_bins(data, np.array([0, len(data)]))
    found = cells(bins, cuts)
    scores = np.stack([model.weights[found, k].sum(1) * found.shape[1] ** -0.5 for k in (0, 1)], 1)
    good = model.chain.marginals(scores, cuts)[:, 1]
    return list(zip(text.split("\n"), good.tolist()))
