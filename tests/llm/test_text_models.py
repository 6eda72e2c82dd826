"""Chain fields, quality, language, byte-level BPE and packing against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crmlake.llm import bpe_segment_tree as B, language_crf as L, packing as P, quality_crf as Q
from crmlake.llm.crf import Chain, Emissions, fit
from crmlake.llm.text_arrays import Known, slices, span_hashes, words

PROSE = {"aa": "banana bandana cabana manana lalana sarana nabana kamana".split(),
         "oo": "hodor modor rodos lodon poton boror sodol torok".split()}


def text_of(lang, n, seed):
    pick = random.Random(f"{lang}{seed}")
    return " ".join(pick.choice(PROSE[lang]) for _ in range(n))


def test_marginals_equal_a_plain_recursion():
    rng = np.random.default_rng(0)
    lengths, states = [0, 1, 5, 47, 48, 49, 200, 0, 97], 3
    offsets = np.r_[0, np.cumsum(lengths)]
    scores, chain = rng.normal(size=(offsets[-1], states)) * 3, Chain(rng.normal(size=(states, states)), rng.normal(size=states))
    got, pairs = chain.marginals(scores, offsets, pairs=True)
    lse = lambda g, axis: np.log(np.exp(g - g.max(axis, keepdims=True)).sum(axis)) + g.max(axis)
    moved = np.zeros((states, states))
    for a, b in zip(offsets[:-1], offsets[1:]):
        s, n = scores[a:b], b - a
        if not n:
            continue
        alpha, beta = np.zeros((n, states)), np.zeros((n, states))
        alpha[0] = chain.start + s[0]
        for i in range(1, n):
            alpha[i] = lse(alpha[i - 1][:, None] + chain.trans, 0) + s[i]
        for i in range(n - 2, -1, -1):
            beta[i] = lse(chain.trans + (s[i + 1] + beta[i + 1])[None], 1)
        z = lse(alpha[-1], 0)
        assert np.allclose(np.exp(alpha + beta - z), got[a:b], atol=1e-9)
        for i in range(1, n):
            moved += np.exp(alpha[i - 1][:, None] + chain.trans + (s[i] + beta[i])[None] - z)
    assert np.allclose(moved, pairs)


def test_fit_raises_the_likelihood():
    rng = np.random.default_rng(1)
    labels = np.repeat([0, 1, 0, 1], 25)
    items, offsets = np.arange(100), np.array([0, 50, 100])
    features = np.where(rng.random(100) < 0.85, labels, 1 - labels)
    emissions = Emissions(features, np.ones(100), np.arange(101))
    weights, chain = fit(emissions, items, labels, offsets, 2, 2, rounds=60)
    flat = Chain(np.zeros((2, 2)), np.zeros(2))
    before = flat.log_likelihood(np.zeros((100, 2)), offsets, labels)
    assert chain.log_likelihood(emissions.scores(weights)[items], offsets, labels) > before / 2


def test_words_and_hashes_do_not_depend_on_slices():
    texts = ["a b  c", "", None, "d", "e f", "\tx\n", "ab" * 70000 + " tail é", "x"]
    seen = {}
    for limit in (1, 5, 1 << 20):
        found = []
        for first, data, offsets in slices(pa.array(texts), limit):
            s, e, t = words(data, offsets)
            raw = data.tobytes()
            found += [(first + k, raw[a:b]) for k, a, b in zip(t.tolist(), s.tolist(), e.tolist())]
            for (_, w), h in zip(found[-len(s):] if len(s) else [], span_hashes(data, s, e).tolist()):
                assert seen.setdefault(w, h) == h
        assert found == [(i, w.encode()) for i, t in enumerate(texts) for w in (t or "").split()]
    assert len(set(seen.values())) == len(seen)


def test_known_values_survive_a_full_table():
    known = Known(3, kind=np.int64)
    data = np.frombuffer(b"a bb ccc dddd a bb eeeee", np.uint8)
    s, e, _ = words(data, np.array([0, len(data)]))
    for _ in range(3):
        for a in range(len(s)):
            at = known.find(data, s[a:a + 1], e[a:a + 1], span_hashes(data, s[a:a + 1], e[a:a + 1]),
                            lambda spans: (np.array([len(x) for x in spans]), np.ones(len(spans), np.int64)))
            assert known.runs(at)[0].tolist() == [e[a] - s[a]] and len(known.keys) <= 3


GOOD = "The quick plan was drawn up, and all of it was good.\nIt went on from there to the end."
BAD = "BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!\nBUY!! NOW!! $$$ ### BUY!!"


def test_quality_learns_from_neighbours_and_scores_every_row(docs):
    rows = docs(*[GOOD, BAD] * 30, None, "", "\n\n\n", "w " * 60000, ids=[*range(60), 60, 61, None, 63])
    labelled = rows.where("doc_id < 60").withColumn("quality", (1 - F.col("doc_id") % 2).cast("int"))
    model = Q.learn(labelled)
    got = Q.score(rows, model).collect()
    assert len(got) == 64 and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == 1 - i % 2 for i in range(60))
    assert all((r["predicted"] == 1) == (r["score"] >= 0.5) for r in got)
    lines = Q.label_lines(GOOD + "\n" + BAD, model)
    assert len(lines) == 4 and lines[0][1] > lines[3][1]
    kept = Q.keep(rows, model)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} >= set(range(0, 60, 2))
    assert {r["score"] for r in Q.score(rows, None).collect()} == {0.5}
    assert Q.score(rows.limit(0), model).count() == 0


def test_line_bins_equal_a_plain_count():
    texts = ["One two, two!\n\nÉTÉ 9%", "", "x\n"]
    for _, data, offsets in slices(pa.array(texts)):
        bins, size, cuts = Q.line_bins(data, offsets)
    lines = [line for t in texts for line in t.split("\n")]
    assert len(bins) == len(lines) and np.diff(cuts).tolist() == [len(t.split("\n")) for t in texts]
    for line, row, n in zip(lines, bins, size):
        raw = max(1, len(line.encode()))
        assert n == raw
        upper = sum(len(c.encode()) for c in line if c.isupper()) / raw
        assert row[0] == np.searchsorted(Q.BINS, upper, "left")
        assert row[Q.SHARES.index("exclaim")] == np.searchsorted(Q.BINS, line.count("!") / raw, "left")
        assert row[len(Q.SHARES)] == np.searchsorted(Q.COUNT_BINS, len(line.split()), "left")


def test_language_of_words_and_texts(docs):
    texts = [text_of(lang, 40, i) for i in range(40) for lang in PROSE]
    rows = docs(*texts, None, "", "123 !!", text_of("aa", 30000, 99), ids=None)
    labelled = rows.where("doc_id < 80").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("oo"))
    model = L.learn(labelled)
    assert model.languages == ["aa", "oo"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(rows, model).collect()}
    assert all(got[i][0] == ("aa", "oo")[i % 2] for i in range(80)) and got[83][0] == "aa"
    assert [got[i] for i in (80, 81, 82)] == [("und", 0.0)] * 3
    mixed = L.word_languages(text_of("aa", 8, 5) + " " + text_of("oo", 8, 6), model)
    assert [x[1] for x in mixed] == ["aa"] * 8 + ["oo"] * 8
    assert {r["doc_id"] for r in L.keep(rows, model).collect()} == {*range(80), 83}
    assert {r["lang_pred"] for r in L.predict(rows, None).collect()} == {"und"}
    assert L.learn(labelled.where("doc_id < 0")) is None


def test_every_language_is_learned(docs, monkeypatch):
    names = [f"l{k:02d}" for k in range(70)]
    letters = random.Random(8)
    lexicon = {n: ["".join(letters.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(6)] for n in names}
    texts = [" ".join(lexicon[n] * 4) for n in names for _ in range(1 if n == "l69" else 3)]
    of = [n for n in names for _ in range(1 if n == "l69" else 3)]
    rows = docs(*texts, " ", ids=[*range(len(texts)), None])
    labelled = rows.withColumn("lang", F.element_at(F.array(*[F.lit(n) for n in (*of, "blank")]), F.coalesce(
        F.col("doc_id") + 1, F.lit(len(of) + 1)).cast("int")))
    for cells in (L.SAMPLE_CELLS, 1):
        monkeypatch.setattr(L, "SAMPLE_CELLS", cells)
        model = L.learn(labelled)
        assert model.languages == names
    got = {r["doc_id"]: r["lang_pred"] for r in L.predict(rows, model).collect()}
    assert [got[i] for i in range(len(of))] == of


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers

    return B.encoder(public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)


def reference():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(B.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_tokenizer(coder):
    pick = random.Random(3)
    odd = list("aé ß\n\t \xa0 　\x85\x1c 中字'st're'll!?.12٣𝟘🙂​̀ÀàΩ")
    texts = ["", "  ", "a  b", "don't stop 'tis we'LL", "x" * 3000, "ab" * 3000 + " " * 500 + "é" * 300, "<|endoftext|> hi"]
    texts += ["".join(pick.choices(odd, k=pick.randint(1, 60))) for _ in range(600)]
    texts += ["".join(pick.choices("etaoinshr", k=k)) for k in range(1, 600, 23)]
    plain = reference()
    for first, found in coder.encode_column(pa.array(texts)):
        for k, ids in enumerate(found):
            assert ids.tolist() == plain.encode_ordinary(texts[first + k])
            assert coder.decode(ids) == texts[first + k].encode()


def test_bpe_long_and_grouped_forms_agree(coder):
    pick = random.Random(5)
    pieces = ["".join(pick.choices("abcdeé", k=k)).encode() for k in range(1, 120)]
    for piece, ids in zip(pieces, coder.encode_matches(pieces)):
        assert coder.encode_long(piece).tolist() == ids.tolist()


def test_bpe_queries_round_trip(docs):
    rows = docs("hello  world", None, "", "hello  world", "né" * 5000)
    ids = B.encode(rows)
    back = {r["doc_id"]: bytes(r["data"]).decode() for r in B.decode(ids).collect()}
    assert back == {0: "hello  world", 1: "", 2: "", 3: "hello  world", 4: "né" * 5000}
    got = {r["doc_id"]: r for r in B.digests(rows).collect()}
    assert got[1]["n_tokens"] == 0 and got[0]["ids_sha256"] == got[3]["ids_sha256"]
    assert B.encode(rows.limit(0)).count() == 0


@pytest.mark.parametrize("slices_", [1, 7])
def test_packing_holds_every_id_once(docs, slices_):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [text_of("aa", n, n) for n in (3, 50, 900, 4000, 9000, 1, 77)] + [None, "", "", "a" * 20000, " \n "]
    rows = docs(*texts, ids=[*range(11), None]).repartition(slices_, "doc_id")
    plain = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    whole = {i if i < 11 else None: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    pieces = P.pack(rows).collect()
    held, sequences = {}, {}
    for r in pieces:
        ids = whole[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        part = ids[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        held.setdefault(r["doc_id"], []).extend(range(r["start"], r["start"] + r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {d: sorted(x) for d, x in held.items()} == {d: list(range(len(x))) for d, x in whole.items()}
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.WINDOW
        padding += 0 if at & (at - 1) == 0 else P.WINDOW - at
    assert padding <= 0.02 * sum(map(len, whole.values()))
    assert P.pack(rows.limit(0)).count() == 0


def test_open_windows_are_bounded_and_best_fit():
    closed = []
    bins = P.OpenWindows(closed.append, window=10, most=2, slack=1)
    for k, n in enumerate((6, 5, 4, 3)):
        bins.place(k, np.zeros(n, np.uint32), 0, n)
        assert len(bins.open) <= 2
    assert [[p[0] for p in w] for w in closed] == [[0, 2]]  # 4 goes where it leaves no room
