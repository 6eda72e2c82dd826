"""The trie of turn prefixes of conversations, by fixed-length block hashing.

Turns are reduced to digests. Every ``BLOCK`` turns of a conversation are a block, and a chain of block
digests stands for all turns up to the end of a block. Conversations are grouped by their chains first,
block after block, so copies and shared beginnings fall together in one row for each block. Where all
members of a chain go on with the same block, the nodes at its turns have the members of the block.
Only where they diverge (different blocks, or some end) are the turn boundaries inside refined, over one
row for each distinct block, not for each conversation.

Sums over subtrees need no walk down the trie. A node is owned by its smallest member; what a member owns
is the end of its path. The leaves and bytes below a node are then sums, over its members, of what these
own, less what its owner owns above it.

No conversation, node or list of ids is gathered in one task: turns are numbered and chained along a
range-partitioned order, ids of a node are joined in runs before the digest that has to read them in order.

Defined cases: a null role or text is empty; rows with a null conv_id are left out; turns are ordered by
turn, null first, equal ones by the digest of role and text; repeated rows are turns of their own; a
conversation without turns is a member of the root alone; an empty table gives no rows; further columns are
not looked at; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crmlake.llm.running import chains, positions

#: Turns of a block.
BLOCK = 4
#: Blocks of a conversation, and ids of a node, that are handled together.
CHUNK = 1024
#: The most turns a conversation borrows from the head of its group.
BORROWED = 8


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, bytes) of every turn, numbered from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", _digest(
                F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
                F.octet_length(text).cast("long").alias("bytes")))
    return positions(rows, "conv_id", [F.col("turn"), F.col("digest")], "at").drop("turn")


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 32)


def with_borrowed_starts(numbered: DataFrame, group: int = 5, most: int = BORROWED) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation begins with the first h turns of the conversation whose id
    is its own less the remainder by ``group``, and goes on with its own turns after its first h; h is the
    crc32 of its id modulo ``most`` + 1."""
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    own = F.col("conv_id") % group == 0
    convs = numbered.where("at = 0").select("conv_id")
    heads = (numbered.where(own & (F.col("at") < most)).groupBy(F.col("conv_id").alias("head"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "bytes"))).alias("first")))
    starts = (convs.where(~own & (borrowed > 0)).withColumn("head", F.col("conv_id") - F.col("conv_id") % group)
              .join(heads, "head").select("conv_id", F.explode(F.slice("first", F.lit(1), borrowed.cast("int"))).alias("t"))
              .select("conv_id", F.lit(0).alias("part"), "t.*"))
    rest = numbered.where(own | (F.col("at") >= borrowed)).select("conv_id", F.lit(1).alias("part"), "at", "digest", "bytes")
    both = starts.unionByName(rest).withColumnRenamed("at", "was")
    return positions(both, "conv_id", [F.col("part"), F.col("was")], "at").drop("part", "was"), convs


def trie(numbered: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the turns (conv_id, at, digest, bytes) of ``conversations`` (conv_id, distinct).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256
    of each distinct prefix, the root included.
    """
    n_all, least = conversations.agg(F.count("*"), F.min("conv_id")).first()
    blocks = _blocks(numbered, block)
    groups = (blocks.groupBy("block", "after").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("owner"), F.first("before").alias("before"),
        F.first("turns").alias("turns"), F.first("bytes_before").alias("bytes_before")).checkpoint())
    above = groups.select((F.col("block") + 1).alias("block"), F.col("after").alias("before"), F.col("n").alias("n_above"))
    # first blocks all stand below the root, whose members are known
    first = groups.where("block = 0").withColumn("diverges", F.col("n") != n_all)
    later = (groups.where("block > 0").join(above, ["block", "before"])
             .withColumn("diverges", F.col("n_above") != F.col("n")).select(*first.columns))
    groups = first.unionByName(later).checkpoint()

    bounds = _boundaries(groups, block, "n", "owner")
    same = ["parent", "bytes", "bytes_before"]
    refined = (bounds.where("diverges").groupBy("depth", "key")
               .agg(F.sum("n").alias("n"), F.min("owner").alias("owner"), *(F.first(c).alias(c) for c in same)))
    nodes = bounds.where("not diverges").select("depth", "key", "n", "owner", *same).unionByName(refined)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = (nodes.join(children, ["depth", "key"], "left")
             .withColumn("n_children", F.coalesce("n_children", F.lit(0))).checkpoint())

    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.sum("bytes").alias("owned"), F.min("bytes_before").alias("owned_from"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    totals = blocks.groupBy("conv_id").agg(F.sum("bytes").alias("total"), F.max("block").alias("last"))
    members = (conversations.join(totals, "conv_id", "left").join(owners, "conv_id", "left")
               .select("conv_id", "last", "owned_from", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "owned", "leaf")))
               .checkpoint())
    # a conversation of very many blocks meets its own sums in chunks
    chunked = members.where("last is not null").select("*", F.explode(F.sequence(F.lit(0), _chunk(F.col("last")))).alias("chunk"))
    paths = blocks.withColumn("chunk", _chunk(F.col("block"))).join(
        chunked.select("conv_id", "chunk", "last", "total", "owned", "leaf"), ["conv_id", "chunk"])
    sums = ("total", "owned", "leaf")
    summed = paths.groupBy("block", "after").agg(*(F.sum(c).alias(c) for c in sums))
    bounds = _boundaries(groups.join(summed, ["block", "after"]), block, *sums)
    refined = bounds.where("diverges").groupBy("depth", "key").agg(*(F.sum(c).alias(c) for c in sums))
    below = bounds.where("not diverges").select("depth", "key", *sums).unionByName(refined)

    ended = paths.where("block = last").select(
        (F.col("block") * block + F.size("turns")).alias("depth"), _key(block, F.size("turns")).alias("key"), "conv_id")
    ended = ended.unionByName(members.where("last is null").select(F.lit(0).cast("long").alias("depth"), F.lit("").alias("key"), "conv_id"))
    ends = _id_digests(ended)

    froms = chunked.select(F.col("conv_id").alias("owner"), "chunk", "owned_from")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("owner").alias("parent_conv_id"))
    told = (nodes.withColumn("chunk", _chunk(F.floor((F.col("depth") - 1) / block)))
            .join(froms, ["owner", "chunk"]).join(below, ["depth", "key"]))
    # the children of the root need no join; those of another node are split by adaptive execution where they are many
    told = (told.where("depth > 1").join(parents, ["depth", "parent"])
            .unionByName(told.where("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("long")))
            .select("depth", "key", F.col("owner").alias("conv_id"), "parent_conv_id",
                    F.col("n").alias("n_convs"), "n_children", F.col("leaf").alias("n_leaves"),
                    (F.col("total") - F.col("n") * F.col("bytes_before")
                     - F.col("owned") + F.col("bytes_before") - F.col("owned_from")).alias("saved_tokens")))
    n_first = nodes.where("depth = 1").count()
    root = members.agg(F.count("*").alias("n_convs"), F.sum("leaf").alias("leaves"),
                       (F.sum("total") - F.sum("owned")).alias("saved_tokens")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), F.lit("").alias("key"), F.lit(least).cast("long").alias("conv_id"),
                       F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                       F.lit(n_first).cast("long").alias("n_children"),
                       F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens")
    return (told.unionByName(root).join(ends, ["depth", "key"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def _chunk(number: Column) -> Column:
    return F.floor(number / CHUNK).cast("long")


def _blocks(numbered: DataFrame, block: int) -> DataFrame:
    """One row for each block of a conversation: its turns, and the chains before and after it."""
    held = (numbered.groupBy("conv_id", F.floor(F.col("at") / block).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "bytes"))).alias("turns"), F.sum("bytes").alias("bytes"))
            .withColumn("digest", _digest(F.array_join("turns.digest", ""))))
    return chains(held, "conv_id", [F.col("block")], "digest", "bytes", "before", "after", "bytes_before").drop("digest").checkpoint()


def _key(block: int, size: Column) -> Column:
    """What stands for the turns up to turn ``size`` of a block: at the block's end the chain, so that the
    next block's nodes find their parent."""
    return F.when(size == block, F.col("after")).otherwise(
        F.concat(F.lit("in:"), _digest(F.concat("before", F.array_join(F.slice("turns.digest", F.lit(1), size), "")))))


def _boundaries(groups: DataFrame, block: int, *values: str) -> DataFrame:
    """A row for each turn of each block: depth, key, parent key, and the bytes of the turn and before it."""
    rows = groups.select("*", F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("size"))
    inner = F.aggregate(F.slice("turns.bytes", F.lit(1), F.col("size") - 1), F.lit(0).cast("long"), lambda a, b: a + b)
    parent = F.when(F.col("size") == 1, F.col("before")).otherwise(_key(block, F.greatest(F.col("size") - 1, F.lit(1))))
    return rows.select((F.col("block") * block + F.col("size")).alias("depth"), _key(block, F.col("size")).alias("key"),
                       parent.alias("parent"), F.element_at("turns.bytes", F.col("size")).alias("bytes"),
                       (F.col("bytes_before") + inner).alias("bytes_before"), "diverges", *values)


def _id_digests(ended: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) over the ids of each node in numeric order.

    A SHA-256 is read in order, so a node's ids pass through one task in the end; they do so as strings of
    up to CHUNK ids, one in memory at a time.
    """
    runs = (ended.groupBy("depth", "key", F.floor(F.col("conv_id") / CHUNK).alias("run"))
            .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
            .select("depth", "key", "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))
    return (runs.repartition("depth", "key").sortWithinPartitions("depth", "key", "run")
            .mapInArrow(_hashed, "depth long, key string, ends_sha256 string"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["depth", "key", "ends_sha256"]
    types = [pa.int64(), pa.string(), pa.string()]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    node, digest, out = None, None, []
    for b in batches:
        for depth, key, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
            if (depth, key) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (depth, key), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 1000:
            yield batch(out)
            out = []
    if node is not None:
        out.append((*node, digest.hexdigest()))
    if out:
        yield batch(out)
