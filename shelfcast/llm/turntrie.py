"""The trie of conversations that begin alike, from adaptive radix trees over ranges of the sorted conversations.

A conversation's key is its turns' ids, each of the same number of big-endian bytes, one after the other. Distinct keys
are sorted and dealt out by ranges, so that a prefix that very many conversations share takes several ranges instead of
one task. Each block of a range is put into a radix tree; only byte depths that are whole turns become nodes. A block
knows all there is below a prefix unless its first or its last key has that prefix: such open nodes, a few paths a block,
are added up over the blocks afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.radix import ascending, insert
from shelfcast.session import materialize

#: Bytes of a turn's id (an MD5 digest).
TURN = 16
#: Keys in one radix tree, and the bytes of keys beyond which a tree is finished earlier.
BLOCK = 20_000
BLOCK_BYTES = 8 << 20
#: The turns that a conversation takes from another are fewer than this.
HEADS = 6
#: Conversations whose turns are copied over: those at multiples of this.
FAMILY = 100

_NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, id hex, size in code points) of every turn, in the order of turn (nulls first), role and id."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.length(text).alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "id")
    return turns.select("conv_id", F.row_number().over(order).alias("pos"), "id", "size")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): each conversation with the first turns of its family's head in place of its own.

    The first h turns come from conversation c - c % 100 (all if it has fewer, none if there is no such one) and are
    followed by the conversation's own turns after its first h; h is the crc32 of the decimal c, modulo 6.
    """
    turns = materialize(numbered_turns(conversations))
    taken: Column = F.crc32(F.col("conv_id").cast("string")) % HEADS
    own = turns.filter(F.col("pos") > taken)
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "head")
    all_ids = turns.filter("pos = 1").select("conv_id")  # every conversation has a first turn
    asked = all_ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"), taken.alias("h"))
    copied = asked.join(heads, "head").filter("pos <= h").select("conv_id", "pos", "id", "size")
    empty = all_ids.select("conv_id", F.lit(None).cast("int").alias("pos"), F.lit("").alias("id"), F.lit(0).alias("size"))
    parts = own.unionByName(copied).unionByName(empty)
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "size"))
    listed = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    return listed.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


# ---- digests of the conversations that end together ---------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, conv_id) in order to (k, first conv_id, conv_ids joined by commas), one row for each run in a batch."""
    for batch in batches:
        rows = zip(*[column.to_pylist() for column in batch.columns])
        joined = [(k, [conv for _, conv in run]) for k, run in groupby(rows, key=lambda row: row[0])]
        columns = [[k for k, _ in joined], [ids[0] for _, ids in joined], [",".join(map(str, ids)) for _, ids in joined]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _RUN)], ["k", "first", "ids"])


_RUN = (pa.string(), pa.int64(), pa.string())


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order of (k, first) to (k, SHA-256 of all ids joined by commas); nothing but the digest's state is held."""
    at, digest = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k == at:
                digest.update(b"," + ids.encode())
                continue
            if digest:
                done.append((at, digest.hexdigest()))
            at, digest = k, hashlib.sha256(ids.encode())
        yield _pairs(done)
    if digest:
        yield _pairs([(at, digest.hexdigest())])


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["k", "ends"])


def _ends(rows: DataFrame) -> DataFrame:
    """(k, ends): digest of the ascending ids of the conversations with each key; ids are joined up before they are dealt
    out by key, so that a key of very many conversations is a few long rows."""
    order = ["k", "conv_id"]
    dealt = rows.select(F.md5("key").alias("k"), "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)
    runs = dealt.mapInArrow(_runs, "k string, first long, ids string")
    return runs.repartition("k").sortWithinPartitions("k", "first").mapInArrow(_digested, "k string, ends string")


# ---- trees --------------------------------------------------------------------------------------

_FOUND = (
    "id long, up long, above array<long>, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, size long, ends string"
)
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]
_TYPES = [pa.list_(pa.int64()) if n == "above" else pa.string() if n == "ends" else pa.int64() for n in _NAMES]


def _prefix_ids(key: bytes) -> list[int]:
    """Ids of the prefixes of a key, the empty one first, as signed longs."""
    state, ids = xxhash.xxh64(), []
    for at in range(0, len(key) + 1, TURN):
        state.update(key[at - TURN : at] if at else b"")
        ids.append(state.intdigest() - (1 << 63))
    return ids


def _nodes(block: list[tuple[bytes, int, int, list[int], str]]) -> Iterator[tuple]:
    """Nodes of one block of sorted keys with (least conv_id, conversations, sizes, digest), as rows of `_FOUND`.

    Open nodes have an `id`, and their children, leaves and saved tokens are those of the nodes that are not open. The
    others are finished, but for the parent's conv_id where the parent is open: then `up` is its id.
    """
    root = None
    for n, (key, *_) in enumerate(block):
        root = insert(root, key, n)
    last = len(block) - 1
    ids = {0: _prefix_ids(block[0][0]), last: _prefix_ids(block[-1][0])}
    done: list[tuple] = []  # what nodes hand up, in the order in which they were finished
    for node, start, end in ascending(root):
        kids = sum(1 for _ in node.below)
        below = done[len(done) - kids :]
        del done[len(done) - kids :]
        low, high = min((b[0] for b in below), default=last), max((b[1] for b in below), default=0)
        least, n = min((b[2] for b in below), default=1 << 63), sum(b[3] for b in below)
        leaves, saved, tops = sum(b[4] for b in below), sum(b[5] for b in below), [t for b in below for t in b[6]]
        ends = _NOTHING
        if node.value is not None:
            _, own, count, _, ends = block[node.value]
            low, high, least, n = min(low, node.value), max(high, node.value), min(least, own), n + count
        sizes = block[low][3]
        for at in range(end // TURN * TURN, start, -TURN):
            depth = at // TURN
            size = sizes[depth - 1] if depth else 0
            closing = ends if at == end else _NOTHING
            if low and high < last:
                for top in tops:
                    yield (None, None, None, *top[:2], least, *top[2:])
                kept, leaves, saved = len(tops), leaves if tops else 1, saved + (n - 1) * size
                tops = [(least, depth, n, kept, leaves, saved, None, closing)]
                continue
            path = ids[0 if not low else last]
            for top in tops:
                yield (None, path[depth], None, *top[:2], None, *top[2:])
            up = path[depth - 1] if depth else None
            digest = closing if at == end and node.value is not None else None
            yield (path[depth], up, path[: depth + 1], least, depth, None, n, len(tops), leaves, saved, size, digest)
            tops = []
        done.append((low, high, least, n, leaves, saved, tops))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, held = [], 0

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*_nodes(block)), _TYPES)], _NAMES)

    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            block.append(row)
            held += len(row[0])
            if len(block) >= BLOCK or held >= BLOCK_BYTES:
                yield rows()
                block, held = [], 0
    if block:
        yield rows()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of `rebuilt` conversations, the textless root first in depth.

    A node is a distinct sequence of first turns (role and text). conv_id: the smallest id of its members, the
    conversations that begin with it; depth: its turns; parent_conv_id: the parent's conv_id, null for the root;
    n_convs: members; n_children; n_leaves: childless nodes at or below it; saved_tokens: over the nodes at and below
    it, members beyond the first times code points of the node's last text; ends_sha256: digest of the ascending
    decimal ids, joined by commas, of the members that end there.

    Null roles and texts are empty. Turns are ordered by number, nulls first, where numbers tie by role and then by the
    digest of role and text; repeated rows are turns like any other. Rows without a conv_id take no part, an empty table
    has no nodes, and other columns are ignored. One conversation is one row of 16 bytes a turn.
    """
    rows = materialize(rebuilt(conversations))
    sums = [F.min("conv_id").alias("least"), F.count("*").alias("n"), F.any_value("sizes").alias("sizes")]
    keys = rows.groupBy("key").agg(*sums).withColumn("k", F.md5("key")).join(_ends(rows), "k")
    keys = materialize(keys.select("key", "least", "n", "sizes", "ends"))
    found = keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_found, _FOUND)
    found = materialize(found)
    finished, parts = found.filter("id IS NULL"), found.filter("id IS NOT NULL")
    added = parts.groupBy("id").agg(
        F.any_value("up").alias("up"),
        F.any_value("above").alias("above"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("closed"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.any_value("size").alias("size"),
        F.max("ends").alias("ends"),
    )
    added = materialize(added)
    open_kids = added.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(F.count("*").alias("opened"))
    kids = F.col("closed") + F.coalesce("opened", F.lit(0))
    named = materialize(added.join(open_kids, "id", "left").withColumn("n_children", kids))
    own = named.select(
        F.explode("above").alias("id"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("own"),
    )
    own = own.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    parents = named.select(F.col("id").alias("up"), F.col("conv_id").alias("parent"))
    opened = named.join(own, "id").join(parents, "up", "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("own")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NOTHING)).alias("ends_sha256"),
    )
    closed = finished.join(parents, "up", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )
    return opened.unionByName(closed)
