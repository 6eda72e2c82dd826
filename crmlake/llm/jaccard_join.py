"""Near-duplicate join: Jaccard similarity of word shingles, with prefixes under several orders.

Two sets of similarity t or more share a token among the first n - ceil(t n) + 1 tokens of either, in
*any* order of all tokens. Tokens are put in ``ORDERS`` global orders: rarer first, by counts over all
documents, and tokens of like frequency by another hash for each order. Candidates come from the lists
of the first order's prefixes, and in every order their prefixes must share as many tokens as similar
sets of their sizes do (at least one); what passes all orders is verified on whole sets.

Passes, all distributed:

1. every text is shingled; equal sets (a 128-bit digest) form a class, and a sketch of fixed size
   counts tokens over all documents;
2. every set's prefix of the first order is written, and marks (16 bits a token) of its prefixes in all
   orders; tokens in one set only are dropped;
3. links are sought in rounds. Each set is compared with one hub per round: that of its lists which it
   meets most often (a list's hub is one of its ids by hash, another in each round). The marks of a hub's
   members go to the hub; what may share enough in every order follows with its text, and is verified on
   whole sets. Linked sets become one component, and only tokens whose sets are in several remain;
4. of what remains, pairs of different components are counted by the tokens they share, which is the
   first order's filter; those that pass it go the same way. A pair inside one component cannot change
   the result. No pair of different components is left out.

A hub's members are dealt in blocks of ``BLOCK``, each with a copy of the hub, and pass it as a sorted
stream, so no group is held in memory.

So a group of thousands of near copies costs a few verifications per member, not all its pairs.

Defined cases: null or empty texts and texts without words have an empty set and link with nothing;
fewer words than a shingle form one token; equal sets always link; repeated rows get equal
rows, and an id whose rows differ links by any of its texts; rows without an id are left out; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crmlake.llm.components import components
from crmlake.llm.shared import release, with_text
from crmlake.llm.text_arrays import lower_ascii, mix, slices, span_hashes, words

WORDS = 5
PER_CENT = 80
ORDERS = 3
#: Counters of the frequency sketch, and the parts in which they are added up.
CELLS = 1 << 24
PARTS = 64
#: Rounds of verification against hubs before what is left is paired; they end as well when one brings little.
HUB_ROUNDS = 8
#: Members of a hub that are compared with one copy of it.
BLOCK = 128
#: Rounds end when what is left is at most so many co-occurrences for each document in a list.
LEFT_PER_DOCUMENT = 64
#: Ids that may be broadcast; more are joined by a shuffle.
BROADCAST_IDS = 50_000
#: Bits of the filters that pick out shared tokens and the candidates' texts.
FILTER_BITS = 1 << 25

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(column: pa.Array, width: int = WORDS):
    """(row, sorted distinct 64-bit tokens) of every text."""
    for first, data, offsets in slices(column):
        data = lower_ascii(data)
        starts, ends, text = words(data, offsets)
        h = span_hashes(data, starts, ends)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(offsets) - 1))]).tolist()
        n = len(h) - width + 1
        if n > 0:
            k = h[:n] * _FACTORS[0]
            for j in range(1, width):
                k = k + h[j:n + j] * _FACTORS[j]
            k = mix(k)
        for i in range(len(offsets) - 1):
            a, b = cuts[i], cuts[i + 1]
            if b - a >= width:
                yield first + i, np.unique(k[a:b - width + 1])
            elif b > a:
                few = h[a:b] * np.array(_FACTORS[:b - a])
                yield first + i, mix(np.array([few.sum()]), 77 + b - a)
            else:
                yield first + i, h[:0]


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(np.ascontiguousarray(tokens, "<u8"), digest_size=16).digest()


def least_overlap(n: np.ndarray | int, per_cent: int = PER_CENT):
    """The fewest tokens that a set of n tokens must share with a similar one."""
    return -(-per_cent * n // 100)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(40)).astype(np.int64) & (CELLS - 1)


def prefix(tokens: np.ndarray, level: np.ndarray, order: int, per_cent: int = PER_CENT) -> np.ndarray:
    """The prefix of a set in one global order: rarer levels first, then by the order's own hash."""
    n = len(tokens)
    size = n - least_overlap(n, per_cent) + 1
    key = level[_cells(tokens)].astype(np.uint64) << np.uint64(58) | mix(tokens, 100 + order) >> np.uint64(6)
    return tokens[np.argpartition(key, size - 1)[:size]] if size < n else tokens


def marks(tokens: np.ndarray) -> np.ndarray:
    """16 bits of each token: prefixes share at most as many tokens as marks of one are among the other's."""
    return (mix(tokens, 301) >> np.uint64(48)).astype(np.uint16)


def fewest_shared(n: int, m: int, per_cent: int = PER_CENT) -> int:
    """The fewest tokens that prefixes of similar sets of n and m tokens share, in any order.

    Where the prefix that ends first in the order ends, all common tokens so far are in both prefixes;
    beyond, that set has no more than ceil(t n) - 1 tokens. So the sets share at most what the prefixes
    share and the larger of both rests.
    """
    needed = -(-(n + m) * per_cent // (100 + per_cent))
    return max(1, needed - max(least_overlap(n, per_cent), least_overlap(m, per_cent)) + 1)


def _arrays(values: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def profile(texts: DataFrame, width: int = WORDS) -> DataFrame:
    """(doc_id, n, set) of every document, set being a digest, and rows of the sketch (part, counts)."""
    def run(batches):
        counts, found = np.zeros(CELLS, np.uint32), False
        for batch in batches:
            ids, n, sets = batch.column(0), [], []
            for _, tokens in shingle_sets(batch.column(1), width):
                _count(counts, tokens)
                n.append(len(tokens))
                sets.append(digest(tokens))
                found = True
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.nulls(len(n), pa.int32()),
                 pa.nulls(len(n), pa.binary())], ["doc_id", "n", "set", "part", "counts"])
        if found:
            parts = np.minimum(counts, 0xFFFF).astype("<u2").reshape(PARTS, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.binary()),
                 pa.array(range(PARTS), pa.int32()),
                 pa.array([zlib.compress(_planes(p), 1) for p in parts], pa.binary())],
                ["doc_id", "n", "set", "part", "counts"])

    return texts.mapInArrow(run, "doc_id long, n long, set binary, part int, counts binary")


def _planes(counts: np.ndarray) -> bytes:
    """Two-byte counters with all low bytes before all high ones, which are mostly 0 and pack to nothing."""
    return counts.view(np.uint8).reshape(-1, 2).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(2, -1).T).view("<u2").ravel()


def _count(counts: np.ndarray, tokens: np.ndarray) -> None:
    cells, times = np.unique(_cells(tokens), return_counts=True)
    counts[cells] += times.astype(np.uint32)


def frequency_levels(profiles: DataFrame) -> np.ndarray:
    """log2 of the summed counters: CELLS bytes, whatever the input."""
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = _from_planes(zlib.decompress(packed))
                if part in sums:
                    sums[part] += counts
                else:
                    sums[part] = counts.astype(np.uint64)  # one part is 1/PARTS of the counters
        levels = [zlib.compress(np.log2(s + 1.0).astype(np.uint8).tobytes(), 1) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())],
                                         ["part", "levels"])

    rows = (profiles.where("part IS NOT NULL").select("part", "counts").repartition("part")
            .mapInArrow(add, "part int, levels binary").collect())
    out = np.zeros((PARTS, CELLS // PARTS), np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(zlib.decompress(r["levels"]), np.uint8)
    return out.ravel()


def join_documents(docs: DataFrame, width: int = WORDS, per_cent: int = PER_CENT,
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document with an id."""
    spark = docs.sparkSession
    texts = with_text(docs, id_column, text_column).where("doc_id IS NOT NULL")
    profiles = profile(texts, width).checkpoint()
    levels = spark.sparkContext.broadcast(frequency_levels(profiles))
    sets = profiles.where("part IS NULL").select("doc_id", "n", "set")
    classes = (sets.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
               .where("copies > 1").select("set", "first").checkpoint())

    # a set is written by the first document of a task that has it; sets under 4 tokens link to equals only
    smallest = next(n for n in range(1, 1000) if 100 * n >= per_cent * (n + 1))

    def prefixes(batches):
        seen: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for k, tokens in shingle_sets(batch.column(1), width):
                if len(tokens) >= smallest and (d := digest(tokens)) not in seen:
                    seen.add(d)
                    heads = [prefix(tokens, levels.value, o, per_cent) for o in range(ORDERS)]
                    rows.append((ids[k], len(tokens), heads[0], b"".join(marks(h).tobytes() for h in heads)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 _arrays([r[2] for r in rows]), pa.array([r[3] for r in rows], pa.binary())],
                ["doc", "n", "tokens", "marks"])

    written = texts.mapInArrow(prefixes, "doc long, n int, tokens array<long>, marks binary").checkpoint()
    tokens = written.select(F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token").checkpoint()
    release(spark)
    in_several = spark.sparkContext.broadcast(member_filter(shared))

    def probably_shared(batches):
        for batch in batches:
            tokens = batch.column(2)
            flat = tokens.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), tokens.value_lengths().to_numpy(zero_copy_only=False))
            kept = passes_filter(flat, in_several.value)
            at = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[kept]), batch.column(0).take(at), batch.column(1).take(at)], ["token", "doc", "n"])

    lists = (written.mapInArrow(probably_shared, "token long, doc long, n int")
             .join(_small(shared), "token", "left_semi").checkpoint())
    release(spark)
    links = _links(texts, written, lists, width, per_cent)

    first_of = sets.where("n > 0").join(classes, "set").select("doc_id", "first").where("doc_id <> first")
    if links is not None:
        ends = links.select(F.col("a").alias("doc_id")).union(links.select(F.col("b").alias("doc_id"))).distinct()
        renamed = ends.join(first_of, "doc_id").groupBy("doc_id").agg(F.min("first").alias("first")).checkpoint()
        pick = lambda side: (F.coalesce(F.col("first"), F.col("doc_id")).alias(side))
        links = (links.withColumnRenamed("a", "doc_id").join(renamed, "doc_id", "left").select(pick("a"), "b")
                 .withColumnRenamed("b", "doc_id").join(renamed, "doc_id", "left").select("a", pick("b"))
                 .where("a <> b"))
        labels = components(links).checkpoint()
        # a class takes the label of its first document; all others that have a label are classes of one
        by_class = (classes.join(labels, F.col("first") == F.col("node"), "left")
                    .select("set", F.coalesce("label", "first").alias("of_class")).checkpoint())
        out = (sets.join(by_class, "set", "left").withColumnRenamed("doc_id", "node")
               .join(labels, "node", "left")
               .select(F.col("node").alias("doc_id"), "n", F.coalesce("of_class", "label", "node").alias("c")))
    else:
        out = (sets.join(classes, "set", "left")
               .select("doc_id", "n", F.coalesce("first", "doc_id").alias("c")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"))


def _bits(values: np.ndarray) -> np.ndarray:
    """The two bits of each value in a filter."""
    values = values.view(np.uint64)
    return np.stack([(mix(values, salt) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for salt in (501, 502)])


def member_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of one column of longs, of FILTER_BITS bits whatever their number.

    Bitmaps of tasks are joined part by part. Many ids fill it up, and more passes than should; what
    passes is joined exactly afterwards or does no harm.
    """
    step = FILTER_BITS // PARTS

    def mark(batches):
        bits, found = np.zeros(FILTER_BITS, bool), False
        for batch in batches:
            if batch.num_rows:
                bits[_bits(batch.column(0).to_numpy(zero_copy_only=False)).ravel()] = True
                found = True
        if found:
            parts = [zlib.compress(np.packbits(bits[k * step:(k + 1) * step]).tobytes(), 1) for k in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())],
                                             ["part", "bits"])

    def join(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.frombuffer(zlib.decompress(packed), np.uint8)
                sums[part] = sums[part] | one if part in sums else one
        packed = [zlib.compress(s.tobytes(), 1) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["part", "bits"])

    schema = "part int, bits binary"
    out = np.zeros((PARTS, step // 8), np.uint8)
    for r in ids.mapInArrow(mark, schema).repartition("part").mapInArrow(join, schema).collect():
        out[r["part"]] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.ravel()


def passes_filter(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    bits = _bits(values)
    return ((members[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1).all(0)


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` (one column of longs), marked for broadcast where they were counted to be few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _fits(n, m, per_cent: int):
    """Sizes that can be as similar as asked."""
    return 100 * F.least(n, m) >= per_cent * F.greatest(n, m)


def _against_hubs(pairs: DataFrame, rows: DataFrame, held, similar) -> DataFrame:
    """The pairs (a, b) for which ``similar(held(row of a), held(row of b))`` holds for any rows of both.

    ``rows`` has the columns doc, n, data. Each member's row is sent to its hub ``a`` once, each hub's row
    to every block of its members, and sorted to stand before them.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = (pairs.join(sizes, "a")
               .select("a", F.expr("pmod(xxhash64(b), blocks)").cast("int").alias("block"), "b"))
    hubs = members.select("a", "block", F.col("a").alias("b")).distinct()
    sent = (members.withColumn("member", F.lit(1)).union(hubs.withColumn("member", F.lit(0)))
            .join(rows.withColumnRenamed("doc", "b"), "b")
            .repartition("a", "block").sortWithinPartitions("a", "block", "member")
            .select("a", "block", "member", "b", "n", "data"))

    def run(batches):
        at, hub, seen = None, [], set()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            found: list[tuple[int, int]] = []
            for a, block, member, b, n, data in zip(*columns):
                if at != (a, block):
                    at, hub, seen = (a, block), [], set()
                if member:
                    one = held(n, data)
                    if any(similar(h, one) for h in hub):
                        found.append((a, b))
                elif data not in seen:  # not a repeated row
                    seen.add(data)
                    hub.append(held(n, data))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return sent.mapInArrow(run, "a long, b long").distinct()


def _links(texts: DataFrame, written: DataFrame, lists: DataFrame, width: int, per_cent: int) -> DataFrame | None:
    """Verified links (a, b) that connect all that any link connects, or None."""
    spark = texts.sparkSession
    count = lists.select("doc").distinct().count()

    def only(ids):
        """Rows (doc, n, data) of the texts that the filter lets through."""
        def run(batches):
            for batch in batches:
                batch = batch.filter(pa.array(passes_filter(batch.column(0).to_numpy(), ids.value)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([0] * batch.num_rows, pa.int32()), batch.column(1)], ["doc", "n", "data"])

        return run

    def prefixes(n, data):
        return n, np.frombuffer(data, np.uint16).reshape(ORDERS, -1)

    def share_enough(x, y):
        least = fewest_shared(x[0], y[0], per_cent)
        return all(np.isin(p, q).sum() >= least for p, q in zip(x[1], y[1]))

    def whole(_, data):
        return next(t for _, t in shingle_sets(pa.array([data], pa.string()), width))

    def linked(x, y):
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= per_cent * (len(x) + len(y) - both)

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that pass all orders' filters and then the exact test.

        Texts are read again, and sent to hubs, only of documents whose pairs pass every filter.
        """
        heads = written.select("doc", "n", F.col("marks").alias("data"))
        found = _against_hubs(pairs, heads, prefixes, share_enough).checkpoint()
        release(spark)
        ids = spark.sparkContext.broadcast(member_filter(found.select("a").union(found.select("b")).distinct()))
        rows = texts.mapInArrow(only(ids), "doc long, n int, data string")
        return _against_hubs(found, rows, whole, linked).checkpoint()

    links, before, left = None, float("inf"), _still_apart(lists, None, 0)
    for r in range(1, HUB_ROUNDS + 1):
        release(spark)
        pairs = (left.where("of <> hub_of").where(_fits(F.col("n"), F.col("hub_n"), per_cent))
                 .groupBy("doc", "hub").agg(F.count("*").alias("k"))
                 .groupBy("doc").agg(F.max(F.struct("k", "hub")).alias("h"))
                 .select(F.col("doc").alias("b"), F.col("h.hub").alias("a")).checkpoint())
        found = verified(pairs) if not pairs.isEmpty() else pairs
        if not found.isEmpty():
            links = found if links is None else links.union(found)
        release(spark)
        left = _still_apart(lists, links, r)
        # pairs that remain, at most: of each token, those in different components
        per = left.groupBy("token", "of").agg(F.count("*").cast("double").alias("k"))
        rest = per.groupBy("token").agg(((F.sum("k") ** 2 - F.sum(F.col("k") ** 2)) / 2).alias("pairs"))
        total = rest.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
        if total <= LEFT_PER_DOCUMENT * count or total > 0.75 * before:
            break
        before = total
    if total == 0:
        return links
    release(spark)
    # sizes that fit are in the same band or in neighbouring ones
    band = F.floor(F.log(F.col("n").cast("double")) / max(float(np.log(100 / per_cent)) * (1 + 1e-9), 1e-3))
    rows = left.select("token", "doc", "n", "of", band.alias("band"))
    one = rows.select("token", F.col("doc").alias("a"), F.col("n").alias("na"), F.col("of").alias("oa"), "band")
    two = rows.select("token", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("of").alias("ob"),
                      F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    needed = (F.ceil((F.col("na") + F.col("nb")) * per_cent / (100 + per_cent))
              - F.ceil(F.greatest("na", "nb") * per_cent / 100) + 1)
    pairs = (one.join(two, ["token", "band"]).where("a < b AND oa <> ob").where(_fits(F.col("na"), F.col("nb"), per_cent))
             .groupBy("a", "b").agg(F.count("*").alias("k"), F.min(needed).alias("needed"))
             .where("k >= needed").select("a", "b").checkpoint())
    found = verified(pairs)
    if found.isEmpty():
        return links
    return found if links is None else links.union(found)


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): a node that is connected with ``node``, mostly the smallest within four links.

    It costs two joins, not rounds until nothing changes: nodes with one label are connected, and those
    that could have the same one but do not only stay apart for longer.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).checkpoint()
    wider = (both.join(near.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("label")))
    wider = wider.select(F.col("a").alias("node"), "label").checkpoint()
    again = wider.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
    return (wider.join(again, "label", "left")
            .select("node", F.least("label", "beyond").alias("label")).checkpoint())


def _still_apart(lists: DataFrame, links: DataFrame | None, r: int) -> DataFrame:
    """The lists with each document's component and another hub, without tokens that are in one component only."""
    known = lists.select("token", "doc", "n")
    if links is None:
        known = known.withColumn("of", F.col("doc"))
    else:
        known = (known.join(_labels(links).withColumnRenamed("node", "doc"), "doc", "left")
                 .select("token", "doc", "n", F.coalesce("label", "doc").alias("of")))
    hub = F.min(F.struct(F.xxhash64("doc", F.lit(r)).alias("rank"), "doc", "n", "of"))
    several = (known.groupBy("token").agg(F.min("of").alias("x"), F.max("of").alias("y"), hub.alias("h")).where("x <> y")
               .select("token", F.col("h.doc").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.of").alias("hub_of")))
    return known.join(several, "token").checkpoint()


def keep_one(docs: DataFrame, joined: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` but for those of a component whose smallest id is another.

    Ids to remove are broadcast where they were counted to be few, else joined by a shuffle.
    """
    gone = joined.where("component_id <> doc_id").select(F.col("doc_id").alias(id_column)).checkpoint()
    return docs.join(_small(gone), id_column, "left_anti").select(*docs.columns)
