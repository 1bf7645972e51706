"""Near-duplicates by MinHash signatures, through an inverted join over the coordinates of the signatures.

A text's signature has the smallest hash of its shingles under each of many hash functions; similar texts agree in many
coordinates. Texts are posted under their coordinate-value pairs, rare pairs first. Two texts that agree in `MATCHES`
coordinates meet `HITS` times among the first pairs of both in that one order, so the longest posting lists are never
merged: the coordinates they stand for are counted only for pairs that met. Pairs with enough matches are confirmed on
the full sets. In long lists each member is tried with one of them first. A pair that has met too seldom in short lists
needs the long lists for the rest of its meetings: texts in too few long lists leave here, the others are tried in blocks
of texts, each pair of blocks once and not once for each list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.components import components
from shelfcast.llm.shingles import set_keys, shingle_sets
from shelfcast.llm.substrings import _MIX, _mixed, _small
from shelfcast.session import materialize

#: Coordinates of a signature, and how many of them a pair has to agree in. Two sets at a similarity of 0.8 agree in
#: fewer than 30 of 64 with a probability of 9e-10.
COORDINATES = 64
MATCHES = 30
#: Meetings that are asked of a pair among its first coordinates, one more of which is posted for each.
HITS = 3
#: Similarity that makes a link, in hundredths.
LEAST = 80
#: Texts that common coordinate-value pairs are counted in, and how many of these are put last; they steer the layout,
#: never the result.
ORDERED_FROM = 20_000
COMMON = 100_000
#: Texts in a posting list up to which all its pairs are listed, in a block of a longer one, and in a salted part of a
#: list that is expected to be very long.
SMALL_LIST = 24
BLOCK = 256
SALTED = 50_000
#: Partners in its own block that a text is tried with before all blocks are, and lists, the shortest that it is in, in
#: which it is.
SOME = 4
LISTS = 4
#: Texts whose postings are made at once.
AT_ONCE = 1024
#: Partners in a block up to which each is tried by itself.
FEW = 8
#: Bytes of a shingle's hash where full sets are compared, and texts that are compared with one in a task.
SHINGLE_BYTES = 5
LEAVES = 1000
#: Bits of the filter for the ids whose full sets are wanted: at least 16 for each, up to this many (16 MB).
FILTER_BITS = 1 << 27

_SEEDS = np.random.default_rng(80).integers(0, 1 << 63, (2, COORDINATES), np.uint64) * np.uint64(2) + np.uint64(1)
_POSTED = COORDINATES - MATCHES + HITS


def _signatures(of: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """32 bits of the smallest hash of each of `count` sets under each function; sets without members have zeros."""
    out = np.zeros((count, COORDINATES), np.uint32)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])[: len(of)]
    with np.errstate(over="ignore"):
        for c in range(COORDINATES if len(of) else 0):
            least = np.minimum.reduceat(_mixed((hashes + _SEEDS[0, c]) * _SEEDS[1, c]), starts)
            out[of[starts], c] = _mixed(least).astype(np.uint32)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _pair_keys(signatures: np.ndarray) -> np.ndarray:
    """One number for each coordinate-value pair."""
    with np.errstate(over="ignore"):
        place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
        return _mixed((signatures.astype(np.uint64) | place) * _MIX[0])


def _size_class(n: np.ndarray) -> np.ndarray:
    """Classes of set sizes: sets that are similar enough are in the same class or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / LEAST) + 1e-9).astype(np.int32)


def _common(nodes: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate-value pairs that more than one of some texts have, commonest first, and the share of texts with each."""
    share = min(1.0, ORDERED_FROM / max(total, 1))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_pair_keys(_matrix(batch.column(0))).ravel().view(np.int64))], ["key"])

    some = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share * (1 << 30)).select("sig")
    often = some.mapInArrow(keys, "key long").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    often = often.orderBy(F.desc("n"), "key").limit(COMMON).collect()
    seen = max(share * total, 1)
    return np.array([r.key for r in often], np.int64).view(np.uint64), np.array([r.n / seen for r in often])


def _postings(common: np.ndarray, shares: np.ndarray, total: int):
    by_key, place = np.sort(common), np.argsort(common, kind="stable")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, AT_ONCE) for b in batches for at in range(0, len(b), AT_ONCE)):
            node = batch.column(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            keys = _pair_keys(_matrix(batch.column(2)))
            late, parts = np.zeros(keys.shape, np.int64), np.ones(keys.shape, np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(by_key, keys), len(common) - 1)
                known = by_key[at] == keys
                late[known] = (len(common) - place[at])[known]
                parts[known] = 1 + (shares[place[at]] * total / SALTED).astype(np.int64)[known]
            first = np.lexsort((keys, late), axis=1)[:, :_POSTED]
            keys, parts = (np.take_along_axis(x, first, 1) for x in (keys, parts))
            salt = np.where(parts > 1, 1 + np.abs(node)[:, None] % parts, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.ravel().view(np.int64)),
                    pa.array(salt.ravel().astype(np.int32)),
                    pa.array(np.repeat(_size_class(n), _POSTED)),
                    pa.array(np.repeat(node, _POSTED)),
                    pa.array(np.repeat(n, _POSTED)),
                ],
                ["key", "salt", "cls", "node", "n"],
            )

    return post


def _listed(key, salt, cls, node, n) -> list[pa.RecordBatch]:
    """What whole posting lists give: pairs (a, b) of the short ones; of the long ones each member b with the first
    member a of its size class, and its block."""
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
    sizes = np.diff(np.r_[starts, len(key)])
    size = np.repeat(sizes, sizes)
    short = np.flatnonzero((size <= SMALL_LIST) & (size > 1) & (salt == 0))
    pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for step in range(1, SMALL_LIST):
        same = short[:-step][key[short[step:]] == key[short[:-step]]]
        if not len(same):
            break
        pairs.append((same, same + step))
    a, b = np.concatenate([x for x, _ in pairs]), np.concatenate([y for _, y in pairs])
    on = 100 * np.minimum(n[a], n[b]).astype(np.int64) >= LEAST * np.maximum(n[a], n[b]).astype(np.int64)
    a, b = node[a[on]], node[b[on]]
    none = pa.nulls(len(a), pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], _MET)
    long = (size > SMALL_LIST) | (salt > 0)
    if long.any():
        run = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (cls[1:] != cls[:-1])])
        first = np.repeat(run, np.diff(np.r_[run, len(key)]))[long]
        block = (np.flatnonzero(long) - first) // BLOCK
        columns = [key[long], salt[long], cls[long], block, node[first], node[long]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], _MET)


_MET = ["key", "salt", "cls", "block", "a", "b"]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in order; the last list of a batch may go on in the next one."""
    held = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        ends = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])) + 1
        if len(ends):
            yield from _listed(*[x[: ends[-1]] for x in held])
            held = [x[ends[-1] :] for x in held]
    if held is not None and len(held[0]):
        yield from _listed(*held)


def _matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, signature, signature) to (a, b, matches) of those that agree in enough coordinates."""
    for batch in batches:
        matches = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
        on = pa.array(matches >= MATCHES)
        columns = [batch.column(0), batch.column(1), pa.array(matches.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([c.filter(on) for c in columns], ["a", "b", "matches"])


def _packed(of: np.ndarray, hashes: np.ndarray, count: int) -> pa.Array:
    """Sets as binary values of 40 bits a shingle, in order. Within one pair of sets of 500, two different shingles
    have the same bits with a probability of 2e-7."""
    short = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, 3:]
    offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=count))].astype(np.int64) * SHINGLE_BYTES
    data = pa.py_buffer(np.ascontiguousarray(short).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _unpacked(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // SHINGLE_BYTES, 8), np.uint8)
    wide[:, :SHINGLE_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, SHINGLE_BYTES)
    return wide.view("<u8").ravel()


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    if 100 * min(len(x), len(y)) < LEAST * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= LEAST * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hub, part, leaf, node, s) in order, a hub's own row before its leaves, to the links of hubs and leaves."""
    hub, held = None, np.empty(0, np.uint64)
    for batch in batches:
        found = []
        for name, leaf, node, packed in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3, 4)]):
            if not leaf:
                hub, held = name, _unpacked(packed)
            elif name == hub and _alike(held, _unpacked(packed)):
                found.append((name, node))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Links between the two sides of one pair of blocks, (key, i, j, side, node, component, signature, set) rows;
    components that are joined here count as one from then on."""
    node, comp, side = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 3))
    signatures = np.frombuffer(b"".join(r[6] for r in rows), np.uint32).reshape(-1, COORDINATES)
    sets, found = [_unpacked(r[7]) for r in rows], []
    for x in np.flatnonzero(side == 0):
        other = np.flatnonzero((side == 1) & (comp != comp[x]))
        for y in other[(signatures[other] == signatures[x]).sum(axis=1) >= MATCHES]:
            if comp[y] != comp[x] and _alike(sets[x], sets[y]):
                found.append((node[x], node[y]))
                comp[comp == comp[y]] = comp[x]
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _agreeing(rows: list[tuple], some: bool = False, once: bool = False) -> pa.RecordBatch:
    """Of one pair of blocks, (key, i, j, side, node, component, signature, long) rows: pairs (a, b) of different components
    that agree in enough coordinates, each from the first of the long lists that have both, or, where the blocks stand for
    all lists, `once`. A text with more than `FEW` such partners is named with the blocks instead; with `some`, it is paired
    with those that it agrees with most, from any list."""
    node, comp, side = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 3))
    signatures = np.frombuffer(b"".join(r[6] for r in rows), np.uint32).reshape(-1, COORDINATES)
    if not some and not once:
        long = np.unpackbits(np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(bool)
        here = np.argmax(_pair_keys(signatures[:1]).view(np.int64)[0] == rows[0][0])
    theirs, found = np.flatnonzero(side == 1), []
    for x in np.flatnonzero(side == 0):
        equal = signatures[theirs] == signatures[x]
        matches = equal.sum(axis=1)
        on = (matches >= MATCHES) & (comp[theirs] != comp[x])
        if not some and not once:
            on &= (equal & long[theirs] & long[x]).argmax(axis=1) == here
        near, matches = theirs[on], matches[on]
        if some and len(near) > SOME:
            near = near[np.argsort(-matches, kind="stable")[:SOME]]
        if not some and len(near) > FEW:
            found.append((*rows[0][:3], node[x], None))
        else:
            found.extend((None, None, None, node[x], node[y]) for y in near)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], ["key", "i", "j", "a", "b"])


def _by_blocks(compared):
    """A function of batches in the order of their pairs of blocks (key, i, j) that takes each pair's rows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if row[:3] != at and group:
                    yield compared(group)
                    group = []
                at = row[:3]
                group.append(row)
        if group:
            yield compared(group)

    return run


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits that are set at the places of all ids (a column of longs); of bounded size, so it may let others through."""
    bits, count = 1 << 16, ids.count()
    while bits < min(FILTER_BITS, 16 * count):
        bits *= 2
    place = F.col(ids.columns[0]).bitwiseAND(F.lit(bits - 1))
    words = ids.select(F.shiftright(place, 15).alias("w"), place.bitwiseAND(F.lit(32767)).alias("b"))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for r in words.groupBy("w").agg(F.bitmap_construct_agg("b").alias("held")).collect():
        out[r.w] = np.frombuffer(r.held, np.uint8)
    return out.ravel()


def _rows(texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, n, sig) of every text: its set's key and size, and its signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            of, hashes = shingle_sets(batch.column(1), width)
            n = np.bincount(of, minlength=len(batch))
            columns = [pa.array(set_keys(of, hashes, len(batch))), pa.array(n.astype(np.int32))]
            sig = _binary(_signatures(of, hashes, len(batch)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, sig], ["doc_id", "node", "n", "sig"])

    return texts.mapInArrow(sign, "doc_id long, node long, n int, sig binary")


def _full_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, s) of the nodes in `wanted` and a few others, from another reading of the texts that passes over most: a
    node's set is made from the text with its smallest id, or from any where it has no id."""
    ids = wanted.join(nodes.select("node", "least"), "node").select("least")
    held = _id_filter(ids.filter("least IS NOT NULL"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ids = whole.column(0)
            place = ids.fill_null(0).to_numpy(zero_copy_only=False) & (8 * len(held) - 1)
            on = (held[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            on |= ids.is_null().to_numpy(zero_copy_only=False)
            for batch in _small([whole.filter(pa.array(on))]):
                of, hashes = shingle_sets(batch.column(1), width)
                node = set_keys(of, hashes, len(batch))
                first = np.unique(node, return_index=True)[1]
                sets = _packed(of, hashes, len(batch)).take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array(node[first]), sets], ["node", "s"])

    return texts.mapInArrow(shingle, "node long, s binary").dropDuplicates(["node"])


def _confirmed(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Those of the pairs (hub, leaf) whose full sets are similar, as (a, b).

    Each leaf's set is sent to its hub, where only the hub's own is held; a hub of very many leaves is there several times.
    """
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / LEAVES).cast("int").alias("parts"))
    sized = pairs.join(parts, "hub")
    leaves = sized.select(F.col("leaf").alias("node"), "hub", F.pmod(F.xxhash64("leaf"), "parts").cast("int").alias("part"), F.lit(True).alias("leaf"))
    hubs = parts.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("leaf"))
    roles = materialize(leaves.unionByName(hubs))
    sets = _full_sets(texts, nodes, roles.select("node").distinct(), width)
    sent = sets.join(roles, "node").select("hub", "part", "leaf", "node", "s").repartition("hub", "part")
    return materialize(sent.sortWithinPartitions("hub", "part", "leaf").mapInArrow(_confirm, "a long, b long"))


def _short_list_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) that meet `HITS` times in short lists, or less often where both are in enough long lists for the rest."""
    hits = materialize(met.filter("key IS NULL").groupBy("a", "b").agg(F.count("*").alias("hits")))
    often, seldom = hits.filter(F.col("hits") >= HITS), hits.filter(F.col("hits") < HITS)
    lists = met.filter("key IS NOT NULL").groupBy(F.col("b").alias("node")).agg(F.count("*").alias("lists"))
    for end in ("a", "b"):
        enough = (F.col("node") == F.col(end)) & (F.col("lists") + F.col("hits") >= HITS)
        seldom = seldom.join(lists, enough, "left_semi")
    return often.select("a", "b").unionByName(seldom.select("a", "b"))


def _long_list_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of the members of long lists with the first of their size class, and of these firsts in a row."""
    long = met.filter("key IS NOT NULL")
    heads = long.filter("a = b").select("key", "cls", "salt", "a").distinct()
    heads = heads.withColumn("b", F.lag("a").over(Window.partitionBy("key").orderBy("cls", "salt", "a")))
    pairs = long.select("a", "b").unionByName(heads.filter("b IS NOT NULL").select("a", "b")).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _members(met: DataFrame, linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, cls, j, node, comp) of the texts in `HITS` long lists or more, j their block, and those outside their list's
    largest component."""
    members = met.filter("key IS NOT NULL").select("key", "salt", "cls", "block", F.col("b").alias("node"))
    often = members.groupBy("node").agg(F.count("*").alias("lists")).filter(F.col("lists") >= HITS)
    members = members.join(often, "node", "left_semi").join(linked, "node", "left").withColumn("comp", F.coalesce("root", F.xxhash64("node")))
    members = materialize(members.select("key", "cls", F.concat_ws(":", "cls", "salt", "block").alias("j"), "node", "comp"))
    counts = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"))
    apart = members.join(main, "key").filter(F.col("comp") != F.col("main")).drop("main")
    return members, materialize(apart)


def _in_own_blocks(members: DataFrame, apart: DataFrame) -> DataFrame:
    """(key, i, j, side, node, comp): the members apart, each with all members of its own block in its shortest lists."""
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("size", "key"))
    apart = apart.join(sizes, "key").withColumn("place", place).filter(F.col("place") <= LISTS)
    apart = materialize(apart.select("key", "j", "node", "comp"))
    blocks = apart.select("key", "j").distinct()
    sides = [
        apart.select("key", F.col("j").alias("i"), "j", F.lit(0).alias("side"), "node", "comp"),
        members.join(blocks, ["key", "j"], "left_semi").select("key", F.col("j").alias("i"), "j", F.lit(1).alias("side"), "node", "comp"),
    ]
    return sides[0].unionByName(sides[1])


def _in_all_blocks(members: DataFrame) -> DataFrame:
    """(key, i, j, side, node, comp): the members in blocks that have `HITS` long lists in common.

    A text is in one block: of the longest list that it is in, its size class, and the largest component there or the others.
    Blocks meet once, however many lists they share, if their size classes are neighbours and not all of both is in
    one component. The smaller one goes to the larger, with others that meet it, up to about `BLOCK` texts at once.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("size"))
    homes = members.join(sizes, "key").groupBy("node", "cls", "comp").agg(F.max_by("key", F.struct("size", "key")).alias("home"))
    homes = materialize(homes)
    counts = homes.groupBy("home", "comp").agg(F.count("*").alias("n"))
    main = counts.groupBy("home").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"))
    part = ["home", "cls", "others"]
    place = F.row_number().over(Window.partitionBy(*part).orderBy("node")) - 1
    dealt = homes.join(main, "home").withColumn("others", F.col("comp") != F.col("main"))
    dealt = dealt.withColumn("block", F.xxhash64(*part, F.floor(place / BLOCK)))
    dealt = materialize(dealt.select("block", "cls", "node", "comp"))
    one = F.when(F.min("comp") == F.max("comp"), F.min("comp")).alias("one")
    blocks = dealt.groupBy("block").agg(F.count("*").alias("size"), F.min("cls").alias("cls"), one)
    lists = members.select("key", "node").join(dealt.select("node", "block"), "node").select("key", "block").distinct()
    lists = materialize(lists.join(blocks, "block").select("key", F.struct("size", "block", "cls", "one").alias("x")))
    both = lists.join(lists.withColumnRenamed("x", "y"), "key").filter("x.size < y.size OR x.size = y.size AND x.block <= y.block")
    both = both.filter("abs(x.cls - y.cls) <= 1 AND NOT coalesce(x.one = y.one, false)")
    asked = both.groupBy(F.col("x.block").alias("other"), F.col("y.block").alias("key")).agg(F.count("*").alias("lists"), F.first("x.size").alias("size"))
    before = F.sum("size").over(Window.partitionBy("key").orderBy("other")) - F.col("size")
    asked = asked.filter(F.col("lists") >= HITS).withColumn("i", F.floor(before / BLOCK).cast("string"))
    asked = materialize(asked.select("key", "i", "other"))
    sides = [
        asked.join(dealt.withColumnRenamed("block", "other"), "other").withColumn("side", F.lit(0)),
        asked.select("key", "i").distinct().join(dealt.withColumnRenamed("block", "key"), "key").withColumn("side", F.lit(1)),
    ]
    first, second = [side.select("key", "i", F.lit("").alias("j"), "side", "node", "comp") for side in sides]
    return first.unionByName(second)


def _linked(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, root) of the nodes that links join, from (node, n, sig); of a group of texts that are all similar to some
    of it, only as many links are confirmed as join it."""
    total = nodes.count()
    common, shares = _common(nodes, total)
    post = _postings(common, shares, total)
    postings = nodes.select("node", "n", "sig").mapInArrow(post, "key long, salt int, cls int, node long, n int")
    dealt = postings.repartition("key", "salt").sortWithinPartitions("key", "salt", "cls", "node")
    shape = ", ".join(f"{name} long" for name in _MET)
    met = materialize(dealt.mapInArrow(_meet, shape))

    pairs = _short_list_pairs(met).unionByName(_long_list_pairs(met)).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("y"))
    signed = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    pairs = materialize(signed.mapInArrow(_matching, "a long, b long, matches int"))

    # Each text with the one that it agrees with most; then what this leaves in different components.
    both = pairs.select("matches", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
    best = both.groupBy(F.col("p.a").alias("leaf")).agg(F.max_by("p.b", F.struct("matches", F.col("p.b"))).alias("hub"))
    found = _confirmed(texts, nodes, best.select("hub", "leaf"), width)
    linked = materialize(components(found))
    named = linked.select("node", "root")
    of = lambda end: named.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    apart = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter(~(F.coalesce(F.col("root_a") == F.col("root_b"), F.lit(False))))
    tried = best.select(F.least("hub", "leaf").alias("a"), F.greatest("hub", "leaf").alias("b")).distinct()
    apart = materialize(apart.join(tried, ["a", "b"], "left_anti").select(F.col("a").alias("hub"), F.col("b").alias("leaf")))
    if not apart.isEmpty():
        found = found.unionByName(_confirmed(texts, nodes, apart, width))
        linked = materialize(components(found))

    return _with_long_lists(texts, nodes, met, pairs, found, linked, width)


def _with_long_lists(texts, nodes, met, pairs, found, linked, width: int) -> DataFrame:
    """`linked` with what the members of long lists have in common besides the pairs tried before.

    Members outside the largest component of their list are tried with a few texts of their own block first, which joins
    nearly all of a group of near copies; then what is still apart is tried in blocks of texts.
    """
    order = ["key", "i", "j"]
    shape = "key long, i string, j string, a long, b long"
    tried, signatures = pairs.select("a", "b"), nodes.select("node", "sig", F.lit(None).cast("binary").alias("long"))
    for some in (True, False):
        members, apart = _members(met, linked)
        if apart.isEmpty():
            return linked
        rows = _in_own_blocks(members, apart) if some else _in_all_blocks(members)
        signed = rows.join(signatures, "node").select(*order, "side", "node", "comp", "sig", "long").repartition(*order)
        agreeing = _by_blocks(lambda group, some=some: _agreeing(group, some, not some))
        close = materialize(signed.sortWithinPartitions(*order).mapInArrow(agreeing, shape))
        new = close.filter("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = materialize(new.join(tried, ["a", "b"], "left_anti"))
        if not new.isEmpty():
            found = found.unionByName(_confirmed(texts, nodes, new.select(F.col("a").alias("hub"), F.col("b").alias("leaf")), width))
            linked = materialize(components(found))
            tried = tried.unionByName(new)
    dense = close.filter("key IS NOT NULL").select(*order).distinct()
    if dense.isEmpty():
        return linked
    # Texts with many partners: their blocks are compared set by set.
    rows = rows.drop("comp").join(dense, order, "left_semi").join(linked, "node", "left")
    rows = materialize(rows.withColumn("comp", F.coalesce("root", F.xxhash64("node"))).drop("root"))
    wanted = rows.select("node").distinct()
    sets = _full_sets(texts, nodes, wanted, width).join(wanted, "node", "left_semi")
    full = rows.join(sets, "node").join(nodes.select("node", "sig"), "node")
    full = full.select(*order, "side", "node", "comp", "sig", "s").repartition(*order).sortWithinPartitions(*order)
    more = materialize(full.mapInArrow(_by_blocks(_compared), "a long, b long"))
    return materialize(components(found.unionByName(more)))


def near_duplicates(documents: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `documents`.

    A text's set are its distinct shingles of `width` words, A-Z in lower case; one with fewer words has them all as one
    shingle. Texts are linked if they share `LEAST` hundredths of their union or more; component_id is the smallest id
    that a chain of links reaches, the row's own included, and a row is kept if that is its own. Texts without words,
    null ones too, are linked with nothing. Repeated rows are rows like any other: all are kept, or none. A null id is
    linked, but never the smallest: it is named by the others of its component, and null and kept where there are none.
    Other columns are ignored, an empty table has no rows.

    Texts of one set are one node, so copies cost an aggregated row each. Shingles are compared by 64-bit hashes.
    """
    texts = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = materialize(_rows(texts, width))
    some = rows.filter("n > 0").groupBy("node")
    nodes = materialize(some.agg(F.min("doc_id").alias("least"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")))
    linked = _linked(texts, nodes, width)
    named = nodes.select("node", "least").join(linked, "node", "left")
    named = materialize(named.select("node", "least", F.coalesce("root", F.xxhash64("node")).alias("root")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = materialize(named.join(smallest, "root").select("node", "component_id"))
    # Texts without words share a node that has no label.
    labelled = rows.select("doc_id", "n", "node").join(labels, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return labelled.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
