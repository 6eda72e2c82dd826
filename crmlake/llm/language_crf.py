"""Language of every word, and from it of a text, by a linear-chain conditional random field.

A word (a run without white space) scores for each language by its letter n-grams, its affixes (the
n-grams that touch a word's edge) and, if it is in the learned lexicon, by itself. Transitions are
learned from spans of several languages set one after the other, as code-switched text has them.
Forward-backward over all words of a text gives each word's probabilities; their sum, weighted by
letters, decides the text's language.

The model is fitted on a bounded sample of the labelled texts (``SAMPLE_PER_LANGUAGE`` texts,
fewer of each where there are many languages, ``SPANS_PER_TEXT`` spans of ``SPAN_WORDS`` words from
anywhere in the text). Every language is learned. Prediction reads whole
texts; its tables only remember what was worked out before.

Defined cases: text null, empty or without a letter is ``und`` with score 0; a word without letters
takes its neighbours' language; languages tie by name; repeated rows get equal rows; further columns
are ignored; without a labelled text every row is ``und`` with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.crf import Chain, Emissions, fit
from crmlake.llm.shared import with_text
from crmlake.llm.text_arrays import Known, mix, slices, span_hashes, words

SAMPLE_PER_LANGUAGE = 240
SPANS_PER_TEXT = 2
SPAN_WORDS = 60
#: Words of the sample times languages, about: with more languages each has fewer texts, but at least one.
SAMPLE_CELLS = 16_000_000
NGRAM_CELLS = 1 << 16
LEXICON_WORDS = 1 << 15
LEXICON_LEAST = 3
KNOWN_WORDS = 1_000_000
UNDETERMINED = "und"

_EDGE = 0x20
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def word_features(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all n-grams of the words, the word of each, and each word's letters and own hash."""
    text = "\n".join(s.decode("utf-8", "replace").replace("\n", " ") for s in spans).lower() + "\n"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[codes]
    end = codes == 10
    kept = letter | end
    owner = (np.cumsum(end) - end)[kept]
    c = np.where(end, _EDGE, codes)[kept].astype(np.uint64)
    edge = end[kept]
    n_letters = np.bincount(owner[~edge], minlength=len(spans))
    c, edge = np.concatenate([[np.uint64(_EDGE)], c]), np.concatenate([[True], edge])
    owner = np.concatenate([[0], owner])
    cells, of = [], []
    # from each position on: one to four letters, edges only at either end
    gram = np.zeros(len(c), np.uint64)
    alive = np.ones(len(c), bool)
    for k in range(4):
        gram[:len(c) - k] = gram[:len(c) - k] * np.uint64(0x100000001B3) + c[k:]
        alive[len(c) - k:] = False
        at = np.flatnonzero(alive[:len(c) - k])
        if k:
            cells.append(mix(gram[at], k) % np.uint64(NGRAM_CELLS))
            of.append(owner[at + 1])
        alive[:len(c) - k] &= ~(edge[k:] & (k > 0))
    inside = np.flatnonzero(~edge)
    hashes = np.zeros(len(spans), np.uint64)
    np.add.at(hashes, owner[inside], mix(c[inside] + (np.arange(len(c), dtype=np.uint64)[inside]
                                         - _word_start(owner, edge)[inside]) * np.uint64(0x110000), 9))
    return np.concatenate(cells).astype(np.int64), np.concatenate(of), n_letters, hashes


def _word_start(owner: np.ndarray, edge: np.ndarray) -> np.ndarray:
    start = np.concatenate([[0], np.flatnonzero(edge[1:]) + 1])
    return start[np.minimum(owner, len(start) - 1)].astype(np.uint64)


@dataclass
class Model:
    languages: list[str]
    ngrams: np.ndarray
    lexicon: np.ndarray
    lexicon_weights: np.ndarray
    chain: Chain

    def word_rows(self, spans: list[bytes]) -> np.ndarray:
        """Scores of each language and, last, the letters of each word."""
        cells, of, n_letters, hashes = word_features(spans)
        count = np.bincount(of, minlength=len(spans))
        out = np.zeros((len(spans), len(self.languages) + 1), np.float32)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), max(0, len(self.lexicon) - 1))
        found = self.lexicon[at] == hashes if len(self.lexicon) else np.zeros(len(spans), bool)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(of, self.ngrams[cells, k], len(spans)) / np.sqrt(np.maximum(count, 1))
            out[found, k] += self.lexicon_weights[at[found], k]
        out[n_letters == 0] = 0
        out[:, -1] = n_letters
        return out


def train(rows: list[tuple[str, str]]) -> Model | None:
    """A model from (language, span of words) pairs."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    rows = sorted(set(rows))
    np.random.Generator(np.random.PCG64(1)).shuffle(rows)
    known: dict[str, int] = {}
    items, labels, cuts = [], [], [0]
    for k, (lang, span) in enumerate(rows):
        for w in span.split():
            items.append(known.setdefault(w, len(known)))
            labels.append(number[lang])
        if k % 3 == 2:  # three spans, mostly of several languages, are one sequence
            cuts.append(len(items))
    if cuts[-1] < len(items):
        cuts.append(len(items))
    items, labels = np.array(items, np.int64), np.array(labels, np.int64)
    cells, of, n_letters, hashes = word_features([w.encode() for w in known])
    count = np.bincount(of, minlength=len(known))
    times = np.bincount(items, minlength=len(known))
    own, first = np.unique(hashes[(times >= LEXICON_LEAST) & (n_letters > 0)], return_index=True)
    lexicon = own[:LEXICON_WORDS]
    at = np.minimum(np.searchsorted(lexicon, hashes), max(0, len(lexicon) - 1))
    in_lexicon = np.flatnonzero(lexicon[at] == hashes) if len(lexicon) else np.zeros(0, np.int64)
    features = np.concatenate([cells, NGRAM_CELLS + at[in_lexicon]])
    values = np.concatenate([1 / np.sqrt(np.maximum(count, 1))[of], np.ones(len(in_lexicon))])
    owner = np.concatenate([of, in_lexicon])
    order = np.argsort(owner, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(known)))])
    weights, chain = fit(Emissions(features[order], values[order], starts), items, labels,
                         np.array(cuts), NGRAM_CELLS + len(lexicon), len(languages), rounds=30)
    return Model(languages, weights[:NGRAM_CELLS].astype(np.float32), lexicon,
                 weights[NGRAM_CELLS:].astype(np.float32), chain)


def _spans(lang: str, text: str, key: int) -> Iterator[tuple[str, str]]:
    found = text.split()
    pick = np.random.Generator(np.random.PCG64(key & 0x7FFFFFFF))
    for _ in range(SPANS_PER_TEXT):
        at = int(pick.integers(0, max(1, len(found) - SPAN_WORDS + 1)))
        if found:
            yield lang, " ".join(w[:200] for w in found[at:at + SPAN_WORDS])


def learn(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          language_column: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """A model from the rows with text and language, from a sample of ``per_language`` rows each.

    Two narrow passes: rows per language are counted, then rows whose hashed id is below the share
    that gives the sample, the row of the lowest hash always; a limit bounds it also where ids repeat.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    rows = labelled.select(F.col(f"`{id_column}`").cast("string").alias("id"),
                           F.col(f"`{text_column}`").cast("string").alias("text"),
                           F.col(f"`{language_column}`").cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"[^\s]"))
    u = F.pmod(F.xxhash64(F.coalesce("id", "text")), F.lit(1 << 30)) / float(1 << 30)
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(u).alias("lowest")).collect()
    if not counts:
        return None
    each = max(1, min(per_language, SAMPLE_CELLS // (SPANS_PER_TEXT * SPAN_WORDS * len(counts) ** 2)))
    shares = labelled.sparkSession.createDataFrame(
        [(r["lang"], max(each / r["count"], r["lowest"])) for r in counts], "lang string, share double")
    sample = rows.join(F.broadcast(shares), "lang").where(u <= F.col("share"))
    schema = StructType([StructField("lang", StringType()), StructField("span", StringType())])

    def cut(batches):
        for batch in batches:
            found = [s for key, text, lang in zip(*(batch.column(n).to_pylist() for n in ("key", "text", "lang")))
                     for s in _spans(lang, text, key)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)],
                                             ["lang", "span"])

    most = 2 * SPANS_PER_TEXT * (each + 1) * len(counts)
    spans = (sample.select(F.hash("id", "text").cast("long").alias("key"), "text", "lang")
             .mapInArrow(cut, schema).distinct().limit(most).collect())
    return train([(r["lang"], r["span"]) for r in spans])


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size fixed by the constants above
    known: list[Known] = []

    def run(batches):
        model = shared.value
        if model is not None and not known:
            known.append(Known(KNOWN_WORDS, len(model.languages) + 1))
        for batch in batches:
            n = batch.num_rows
            lang, score = [UNDETERMINED] * n, np.zeros(n)
            for first, mass in _masses(batch.column(1), model, known):
                total = mass.sum(1)
                best = mass.argmax(1)
                for k in np.flatnonzero(total > 0).tolist():
                    lang[first + k] = model.languages[best[k]]
                    score[first + k] = min(1.0, mass[k, best[k]] / total[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"])

    return with_text(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: Model | None, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text has a language that holds a share of ``least`` or more of its letters, with
    all their columns and without a shuffle. Without a model all rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known: list[Known] = []
    at = docs.columns.index(text_column)

    def run(batches):
        model = shared.value
        if model is not None and not known:
            known.append(Known(KNOWN_WORDS, len(model.languages) + 1))
        for batch in batches:
            stays = np.full(batch.num_rows, model is None)
            for first, mass in _masses(batch.column(at), model, known):
                total = mass.sum(1)
                stays[first:first + len(mass)] = (total > 0) & (mass.max(1) >= least * total)
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)


def _masses(column: pa.Array, model: Model | None, known: list[Known]):
    """(first row, letters of each language in each text), slice by slice."""
    if model is None:
        return
    for first, data, offsets in slices(column):
        starts, ends, text = words(data, offsets)
        entries = known[0].find(data, starts, ends, span_hashes(data, starts, ends), model.word_rows)
        rows = known[0].rows[entries]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(offsets) - 1))])
        m = model.chain.marginals(rows[:, :-1].astype(float), cuts) * rows[:, -1:]
        yield first, np.stack([np.bincount(text, m[:, k], len(offsets) - 1) for k in range(m.shape[1])], 1)


def word_languages(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(word, language, probability) of each word of one text: the labels behind a prediction."""
    found = text.split()
    rows = model.word_rows([w.encode() for w in found])
    m = model.chain.marginals(rows[:, :-1].astype(float), np.array([0, len(found)]))
    return [(w, model.languages[int(p.argmax())], float(p.max())) for w, p in zip(found, m)]
