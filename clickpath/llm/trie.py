"""Prefix trie of conversations: sorted sequences, LCPs and a sparse table of range minima.

1. A conversation is the sequence of its turns; a turn is named by 128 bits of
   (role, text).  The names, in hexadecimal, make a sort key, so that
   conversations with a common prefix are neighbours.
2. The conversations are range-partitioned by key and id (a conversation that
   a third of them repeat spreads over many ranges) and sorted.  A block is one
   range, with the last row of the block before and the first of the one after.
3. In a block, ``lcp[i]`` counts the turns that rows i-1 and i share, and a
   sparse table holds the minima of ``lcp`` over all ranges of 2**k rows.  The
   prefixes (i, d) with lcp[i] < d <= length are the trie's nodes, each at its
   first member.  Every candidate prefix searches its last member to the right
   and its parent's first member to the left, each by steps of powers of two
   through the table, without any stack.
4. What a node counts is a difference of prefix sums over its interval.
5. Nodes that run beyond their block leave a fragment a block: at most as many
   as its last and first row have turns.  At each depth the fragments of
   consecutive blocks that belong together are islands; a window over the
   block numbers adds them up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickpath.llm.neardup import _groups
from clickpath.llm.storage import materialize

MAX_PREFIX = 5
GROUP = 100
BLOCK_ROWS = 20_000

NAME = 32  # characters of a turn's name in the key
_NO_PARENT, _INSIDE, _OPENED, _CONTINUED = 0, 1, 2, 3  # where a node's parent is: none, in the block, a fragment of the block

# kind 0: a node inside its block; 1: the fragment of a node that runs on beyond the block's end, in its first block;
# 2: a fragment of a node of an earlier block.  n_texts: summed code points of the members' texts below depth - 1; new_texts:
# those of the nodes that start in the fragment.  ends: ids of the members that end at the node (kind 0: their hash).
_NODE = ("kind int, block long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, n_texts long, "
         "new_texts long, parent int, parent_conv_id long, ends binary")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, chars): every conversation rebuilt, as names and text lengths of its turns.

    Turns are ordered by turn (null first), then role, then text.  The first h
    turns come from conversation c - c % 100 with h = crc32(c) % 6, the others
    are the conversation's own behind its first h.
    """
    blank = F.lit("")
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    name = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(x), "role", "text")), NAME // 2, "0") for x in ("a", "b")])
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    named = materialize(turns.select("conv_id", (F.row_number().over(order) - 1).alias("at"), name.alias("name"), F.length("text").cast("long").alias("chars")), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_PREFIX + 1)
    convs = named.select("conv_id").distinct().withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    heads = named.where(F.col("at") < MAX_PREFIX).select(F.col("conv_id").alias("base"), "at", "name", "chars")
    opening = convs.join(heads, "base").where("at < h").select("conv_id", "at", "name", "chars")
    own = named.withColumn("h", h).where("at >= h").select("conv_id", "at", "name", "chars")
    sequence = opening.unionByName(own).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "name", "chars"))).alias("t"))
    return convs.select("conv_id").join(sequence, "conv_id", "left").select(
        "conv_id", F.coalesce(F.array_join("t.name", ""), blank).alias("key"), F.coalesce("t.chars", F.array().cast("array<long>")).alias("chars"))


class RangeMinimum:
    """Minima of all ranges of 2**k values; the searches step through it by halving powers."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > (half := 1 << (len(self.levels) - 1)):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def last(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The last j >= i such that all values behind i up to j are at least d."""
        j = i.copy()
        for k in reversed(range(len(self.levels))):
            low = self.levels[k]
            at = j + 1
            ok = at < len(low)
            ok[ok] = low[at[ok]] >= d[ok]
            j[ok] += 1 << k
        return j

    def first(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The first j <= i such that all values behind j up to i are at least d."""
        j = i.copy()
        for k in reversed(range(len(self.levels))):
            low = self.levels[k]
            at = j - (1 << k) + 1
            ok = at >= 1
            ok[ok] = low[at[ok]] >= d[ok]
            j[ok] -= 1 << k
        return j

    def lowest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The smallest value of a..b (both inside)."""
        out = np.empty(len(a), self.levels[0].dtype)
        level = np.log2(b - a + 1).astype(np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            low = self.levels[k]
            out[m] = np.minimum(low[a[m]], low[b[m] - (1 << k) + 1])
        return out


def _shared(x: str, y: str) -> int:
    """Turns that two keys share at the front."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n // NAME
    low, high = 0, n // NAME
    while low + 1 < high:
        mid = (low + high) // 2
        if x[:mid * NAME] == y[:mid * NAME]:
            low = mid
        else:
            high = mid
    return low


def _sums(x: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(x))


def _block_nodes(block: int, ids: np.ndarray, keys: list[str], chars: pa.Array, before: str | None, after: str | None) -> pa.RecordBatch:
    n = len(ids)
    size = np.array([len(k) // NAME for k in keys], np.int64)
    lcp = np.array([-1 if before is None else _shared(before, keys[0])] + [_shared(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    next_lcp = np.append(lcp[1:], -1 if after is None else _shared(keys[-1], after))
    table, low_id = RangeMinimum(lcp), RangeMinimum(ids)

    # text lengths: sums along each sequence (path[at[i] + d]: the first d turns of row i)
    at = _sums(size)
    flat = chars.flatten().to_numpy()
    along = _sums(flat)
    total = along[at[1:]] - along[at[:-1]]

    def path(i, d):
        return along[at[i] + d] - along[at[i]]

    new = total - path(np.arange(n), np.clip(lcp, 0, None))
    leaf = next_lcp < size
    texts, news, leaves = _sums(total), _sums(new), _sums(leaf)

    # the nodes that start here, and the fragments of nodes that started before (depth 0 .. lcp[0] of the first row)
    i = np.repeat(np.arange(n), size - lcp)
    d = np.arange(len(i)) - np.repeat(_sums(size - lcp)[:-1], size - lcp) + lcp[i] + 1
    before_d = np.arange(lcp[0] + 1)
    i, d = np.append(np.zeros(len(before_d), np.int64), i), np.append(before_d, d)
    earlier = np.arange(len(i)) < len(before_d)
    r = table.last(i, d)
    runs_on = (r == n - 1) & (next_lcp[-1] >= d)
    members = r - i + 1

    # parents: the first member is the same, or is searched to the left where the node branches off
    left = np.where(d - 1 > lcp[i], i, table.first(i, np.maximum(d - 1, 0)))
    up_earlier = (left == 0) & (d - 1 <= lcp[0])
    up_r = table.last(left, d - 1)
    up_on = (up_r == n - 1) & (next_lcp[-1] >= d - 1)
    parent = np.where(d == 0, _NO_PARENT, np.where(up_earlier, _CONTINUED, np.where(up_on, _OPENED, _INSIDE)))
    parent_id = low_id.lowest(left, up_r)

    # children: nodes that start here, counted at the parent
    where = {}
    for x, (a, b) in enumerate(zip(np.where(earlier, -1, i).tolist(), d.tolist())):
        where[a, b] = x
    children = np.zeros(len(i), np.int64)
    starts = np.flatnonzero(~earlier & (d > 0))
    up = [where[(-1 if e else a), b] for e, a, b in zip(up_earlier[starts].tolist(), left[starts].tolist(), (d[starts] - 1).tolist())]
    np.add.at(children, np.array(up, np.int64), 1)

    kind = np.where(earlier, 2, np.where(runs_on, 1, 0))
    up_path = path(i, np.maximum(d - 1, 0))
    n_texts = texts[r + 1] - texts[i] - members * up_path
    first_new = np.where(earlier, new[i], total[i] - up_path)
    new_texts = news[r + 1] - news[i + 1] + first_new

    ends = []
    listed = ids.tolist()
    for a, b, depth in zip(i.tolist(), r.tolist(), d.tolist()):
        z = a
        while z <= b and size[z] == depth and (z == a or lcp[z] == depth):
            z += 1
        ends.append(",".join(map(str, listed[a:z])).encode())
    closed = kind == 0
    ends = [hashlib.sha256(e).digest() if c else e for e, c in zip(ends, closed.tolist())]
    long = lambda x: pa.array(np.asarray(x, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), long(np.full(len(i), block)), long(d), long(low_id.lowest(i, r)), long(members),
         long(children), long(leaves[r + 1] - leaves[i]), long(n_texts), long(new_texts), pa.array(parent.astype(np.int32)),
         pa.array(parent_id, pa.int64(), mask=parent != _INSIDE), pa.array(ends, pa.binary())], [c.split()[0] for c in _NODE.split(", ")])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by (block, part, key, conv_id); part 0: the row before, 1: the rows, 2: the row behind."""
    for table in _groups(batches, ["block"]):
        blocks = table.column("block").to_numpy()
        cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])).tolist() + [len(blocks)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = table.slice(a, b - a).combine_chunks()
            part = rows.column("part").to_numpy()
            keys = rows.column("key").to_pylist()
            mine = np.flatnonzero(part == 1)
            lo, hi = int(mine[0]), int(mine[-1]) + 1
            yield _block_nodes(int(blocks[a]), rows.column("conv_id").to_numpy()[lo:hi], keys[lo:hi], rows.column("chars").slice(lo, hi - lo).combine_chunks(),
                               keys[0] if part[0] == 0 else None, keys[-1] if part[-1] == 2 else None)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(owner, depth, ends_sha256): the id lists of the fragments, in order, hashed as one stream."""
    now, digest, some = None, None, False

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([digest.hexdigest()])], ["owner", "depth", "ends_sha256"])

    for batch in batches:
        for owner, depth, ends in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ends"))):
            if (owner, depth) != now:
                if now:
                    yield done()
                now, digest, some = (owner, depth), hashlib.sha256(), False
            if ends:
                digest.update((b"," if some else b"") + ends)
                some = True
    if now:
        yield done()


def conversation_trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Null roles and texts are
    empty; rows without a conv_id belong to no conversation and are left out;
    repeated rows are turns of their own; turns with equal numbers are ordered
    by role, then text.  A table without conversations has no nodes, not even
    a root.  A conversation travels as one row of 40 bytes a turn; texts of any
    length are read once.
    """
    spark = conversations.sparkSession
    rows = materialize(rebuilt(conversations), "rebuilt")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // block_rows)
    order = ["key", "conv_id"]
    # a block is a range; empty ranges have no rows and no number
    blocks = materialize(rows.repartitionByRange(parts, *order).withColumn("block", F.spark_partition_id().cast("long")), "ranges")
    place = F.struct("key", "conv_id", "chars")
    edges = blocks.groupBy("block").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    near = Window.orderBy("block")  # a row a block
    edges = edges.withColumn("prev", F.lag("last").over(near)).withColumn("next", F.lead("first").over(near))
    shape = ["block", "part", "conv_id", "key", "chars"]
    around = [edges.where(F.col(c).isNotNull()).select("block", F.lit(p).alias("part"), f"{c}.conv_id", f"{c}.key", f"{c}.chars") for c, p in (("prev", 0), ("next", 2))]
    every = blocks.withColumn("part", F.lit(1)).select(shape).unionByName(around[0]).unionByName(around[1])
    nodes = materialize(every.repartition(parts, "block").sortWithinPartitions("block", "part", *order).mapInArrow(_nodes, _NODE), "nodes")

    # islands: at one depth a fragment that starts a node owns those of the next blocks, up to the one that ends it
    by_depth = Window.partitionBy("depth").orderBy("block", F.col("kind").desc())
    owner = F.last(F.when(F.col("kind") == 1, F.col("block")), True).over(by_depth)
    fragments = materialize(nodes.where("kind > 0").withColumn("owner", owner), "fragments")
    island = ["owner", "depth"]
    sums = fragments.groupBy(*island).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "n_texts", "new_texts")])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashes = (fragments.select(*island, "block", "ends").repartition(parts, *island).sortWithinPartitions(*island, "block")
              .mapInArrow(_end_hashes, "owner long, depth long, ends_sha256 string"))
    ids = fragments.select("block", "depth", "kind", "owner").join(sums.select(*island, "conv_id"), island)
    up = ids.select("block", (F.col("depth") + 1).alias("depth"), (F.when(F.col("kind") == 1, _OPENED).otherwise(_CONTINUED)).alias("parent"),
                    F.col("conv_id").alias("up_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("n_texts") - F.col("new_texts")).alias("saved_tokens"), "ends_sha256"]
    parent = F.coalesce("parent_conv_id", "up_id")
    closed = (nodes.where("kind = 0").join(up, ["block", "depth", "parent"], "left").withColumn("parent_conv_id", parent)
              .withColumn("ends_sha256", F.lower(F.hex("ends"))))
    started = nodes.where("kind = 1").select(F.col("block").alias("owner"), "block", "depth", "parent", "parent_conv_id")
    spread = (started.join(up, ["block", "depth", "parent"], "left").withColumn("parent_conv_id", parent)
              .join(sums, island).join(hashes, island))
    return closed.select(columns).unionByName(spread.select(columns))
