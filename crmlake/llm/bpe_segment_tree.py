"""Byte-level BPE encoding by a segment tree over byte positions, and decoding.

A text is cut by the vocabulary's pattern; in each match every byte starts as a piece, and again and
again the leftmost pair of lowest rank is merged. A segment tree over positions holds, at position i,
the key rank * size + i of the pair that starts at i; its root is the next merge. A merge changes the
pair at i and the one before it and takes out the pair at i's neighbour: three point updates, each
along one path of the tree.

Matches of like length are encoded together: their trees are the rows of one array, and each step does
one merge in every row that has one left. Long matches are encoded one by one with plain lists. A
worker remembers the ids of words (a word with the white space before it) in a table of bounded size.

Defined cases: null text is empty and has no ids; texts of any length, and matches of any length, are
encoded whole; bytes that no text can hold are not met; repeated rows get equal rows; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crmlake.llm.shared import public_file, with_text
from crmlake.llm.text_arrays import SPACE, Known, slices, span_hashes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
KNOWN_WORDS = 600_000
#: Longer matches are encoded one by one; shorter ones in groups of at most so many bytes of trees.
LONG = 256
GROUP_CELLS = 1 << 19
_NEVER = np.iinfo(np.int64).max

_workers: dict[tuple, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.by_rank = {r: b for b, r in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.known = Known(KNOWN_WORDS, kind=np.uint32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``_NEVER``; a negative id is no piece."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], _NEVER)

    def encode_group(self, pieces: list[bytes], size: int) -> list[np.ndarray]:
        """Ids of matches of at most ``size`` bytes (a power of two), one merge in each row per step."""
        m = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, m)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((m, size + 1), -1, np.int64)
        inside = np.arange(size + 1) < length[:, None]
        ids[inside] = self.byte_ids[flat]
        after = np.tile(np.arange(1, size + 2), (m, 1))
        before = np.tile(np.arange(-1, size), (m, 1))
        tree = np.full((m, 2 * size), _NEVER, np.int64)
        ranks = self._rank(ids[:, :size], ids[:, 1:])
        tree[:, size:] = np.where(ranks < _NEVER, ranks * size + np.arange(size), _NEVER)
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        active = np.flatnonzero(tree[:, 1] < _NEVER)
        while len(active):
            key = tree[active, 1]
            at = key % size
            gone = after[active, at]
            ids[active, at] = key // size
            ids[active, gone] = -1
            behind = after[active, gone]
            after[active, at] = behind
            last = behind <= size
            before[active[last], behind[last]] = at[last]
            previous = before[active, at]
            self._update(tree, size, active, gone, np.full(len(active), _NEVER))
            right = np.where(behind <= size, ids[active, np.minimum(behind, size)], -1)
            self._update(tree, size, active, at, self._key(key // size, right, at, size))
            has = previous >= 0
            rows_p, p = active[has], previous[has]
            self._update(tree, size, rows_p, p, self._key(ids[rows_p, p], (key // size)[has], p, size))
            active = active[tree[active, 1] < _NEVER]
        kept = ids >= 0
        flat_ids = ids[kept].astype(np.uint32)
        return np.split(flat_ids, np.cumsum(kept.sum(1))[:-1])

    def _key(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        rank = self._rank(left, right)
        return np.where(rank < _NEVER, np.where(rank < _NEVER, rank, 0) * size + at, _NEVER)

    @staticmethod
    def _update(tree: np.ndarray, size: int, rows: np.ndarray, at: np.ndarray, keys: np.ndarray) -> None:
        """Set one leaf in each row and mend its path to the root."""
        fits = at < size
        if not fits.all():
            rows, at, keys = rows[fits], at[fits], keys[fits]
        node = at + size
        tree[rows, node] = keys
        while size > 1:
            node >>= 1
            size >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_long(self, piece: bytes) -> np.ndarray:
        """The same for one match of any length."""
        n, get = len(piece), self.pairs.get
        size = 1 << max(1, n - 1).bit_length()
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [_NEVER] * (2 * size)
        for i in range(n - 1):
            rank = get((ids[i] << 32) | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank * size + i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(i: int, left: int, right: int | None) -> None:
            rank = None if right is None else get((left << 32) | right)
            node = size + i
            tree[node] = _NEVER if rank is None else rank * size + i
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        while (key := tree[1]) < _NEVER:
            merged, at = divmod(key, size)
            gone = after[at]
            ids[at], ids[gone] = merged, -1
            behind = after[at] = after[gone]
            if behind < n:
                before[behind] = at
            update(gone, -1, None)
            update(at, merged, ids[behind] if behind < n else None)
            if (p := before[at]) >= 0:
                update(p, ids[p], merged)
        return np.array([i for i in ids if i >= 0], np.uint32)

    def encode_matches(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if len(piece) > LONG:
                out[k] = self.encode_long(piece)
            else:
                groups.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for size, members in groups.items():
            step = max(1, GROUP_CELLS // size)
            for a in range(0, len(members), step):
                part = members[a:a + step]
                for k, ids in zip(part, self.encode_group([pieces[k] for k in part], size)):
                    out[k] = ids
        return out

    def encode_spans(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of spans one after the other, and how many each has."""
        find = self.pattern.findall
        number: dict[str, int] = {}
        per_span = [[number.setdefault(x, len(number)) for x in find(s.decode("utf-8", "replace"))] for s in spans]
        found = self.encode_matches([x.encode() for x in number])
        sizes = np.fromiter((sum(len(found[k]) for k in ks) for ks in per_span), np.int64, len(spans))
        parts = [found[k] for ks in per_span for k in ks]
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), sizes

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        for first, data, offsets in slices(column):
            starts, ends, text = spaced_words(data, offsets)
            entries = self.known.find(data, starts, ends, span_hashes(data, starts, ends), self.encode_spans)
            ids, sizes = self.known.runs(entries)
            cuts = np.cumsum(np.bincount(text, weights=sizes, minlength=len(offsets) - 1)).astype(np.int64)
            yield first, np.split(ids, cuts[:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        get = self.by_rank
        return b"".join([get[i] for i in ids.tolist()])


# Last bytes of white space outside ASCII, and the bytes before them: where one may end, no cut is made.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
_BEFORE_SPACE = np.zeros(256, bool)
_BEFORE_SPACE[[0xC2, 0x9A, 0x80, 0x81]] = True
_SPACE_OR_CONTROL = SPACE.copy()
_SPACE_OR_CONTROL[28:32] = True


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that begin where white space follows something else, or a text begins; no match of the
    pattern crosses such a place, nor does what is on one side change the matches on the other.
    """
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    space = SPACE[data]
    begins = np.zeros(len(data), bool)
    solid = ~_SPACE_OR_CONTROL[data]
    solid[1:] &= ~(_MAYBE_SPACE[data[1:]] & _BEFORE_SPACE[data[:-1]])
    begins[1:] = space[1:] & solid[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _workers:
        _workers[path, pattern] = Encoder(path, pattern)
    return _workers[path, pattern]


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           vocabulary: str = VOCABULARY, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; ``path`` is the rank file as every executor sees it."""
    def run(batches):
        coder = _coder(path, vocabulary, pattern)
        for batch in batches:
            ids = [x for _, texts in coder.encode_column(batch.column(1)) for x in texts]
            cuts = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.astype(np.int32)))],
                ["doc_id", "ids"])

    return with_text(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", vocabulary: str = VOCABULARY,
           path: str | None = None) -> DataFrame:
    """(doc_id, data) with the bytes of each row's ids; null ids give no bytes."""
    def run(batches):
        coder = _coder(path, vocabulary, None)
        for batch in batches:
            data = [coder.decode(np.asarray(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return rows.select(id_column, ids_column).mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY,
            path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded again in one pass."""
    def run(batches):
        coder = _coder(path, vocabulary, pattern)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for _, texts in coder.encode_column(batch.column(1)):
                for ids in texts:
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(np.ascontiguousarray(ids, "<u4")).hexdigest())
                    of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return with_text(docs, id_column, text_column).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _coder(path: str | None, vocabulary: str, pattern: str | None) -> Encoder:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return encoder(path or public_file(vocabulary), pattern)
