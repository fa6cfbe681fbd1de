"""Conversation prefix trie over padded turn-id matrices.

Conversations that begin alike share a prefix of the trie (and of an attention
cache). Each conversation is rebuilt from the first turns of its group's leader
and its own later turns, and becomes one row of turn ids, sorted by them; a node
of depth d is then a run of rows that agree in the first d ids.

Spark range-partitions the rows by their ids and so cuts the order into shards.
A shard is a padded matrix of ids: numpy's lexsort orders its rows, the columns
in which a row differs from the one above, OR-accumulated along the row, mark
where nodes start, and reduceat sums every depth. All figures of a node are sums
over its rows of what a row and its neighbours tell:

* n_convs, conv_id: count and minimum;
* n_children: rows that start a node one level deeper;
* n_leaves: rows that no later row continues or repeats;
* saved_tokens: words of the turns that a row shares with the row above, from
  the node's depth on (a node of n members is shared n - 1 times).

So each shard also gets the last row before and the first row after it, nodes
that reach into these are summed over their shards by their prefix hash, and the
digests of their long lists of ends are streamed over pieces of these lists.

Long conversations are cut into segments of ``BLOCK`` turns, sorted behind the
hash of all turns before; what deeper segments add to a node is a suffix sum per
conversation. Turn positions come from a range partition too (rank inside it,
plus the counts of earlier ones), so no task holds a whole conversation.

A turn id is 128 bits of hash over its position, role and text, so it also tells
positions apart, and the hash of a prefix is the XOR of its ids.

Defined results: rows of a null conversation id take no part; a null role or
text is empty; turns are ordered by turn (null first), equal ones by role and
then by the hash of role and text; repeated rows are turns of their own; gaps do
not matter; remainders have the sign of the id, as in SQL; an empty table gives
an empty result (no root); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, quoted, ship, stored

#: A conversation's group, whose smallest id leads it, and how many of the
#: leader's turns it may take at most, plus one.
GROUP, HEADS = 20, 4
BLOCK = 64
#: Rows of a shard, turns of a range of positions, ids of a piece of a list.
SHARD, TURNS, PIECE = 1 << 14, 1 << 18, 256
NO_ENDS = sha256(b"").hexdigest()
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _hash(seed: int, *of) -> Column:
    # The least long is kept for padding.
    return F.greatest(F.xxhash64(F.lit(seed), *of), F.lit(_LEAST + 1))


def positions(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, c1, c2, words): every turn's place, content hash and words."""
    spark = turns.sparkSession
    r, t = F.coalesce(quoted(role), F.lit("")), F.coalesce(quoted(text), F.lit(""))
    narrow = turns.where(quoted(conv).isNotNull()).select(
        quoted(conv).cast("long").alias("conv"), quoted(turn).alias("turn"), r.alias("role"),
        F.xxhash64(F.lit(1), r, t).alias("c1"), F.xxhash64(F.lit(2), r, t).alias("c2"), F.regexp_count(t, F.lit(WORD)).alias("words"),
    )
    narrow = stored(narrow, "narrow-turns")
    order = [F.col("turn").asc_nulls_first(), "role", "c1", "c2"]
    n = max(spark.sparkContext.defaultParallelism, -(-narrow.count() // TURNS))
    ranged = stored(narrow.repartitionByRange(n, "conv", *order).withColumn("part", F.spark_partition_id()), "ranged-turns")
    parts = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("conv", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(parts))
    rank = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    return (
        ranged.withColumn("rank", rank)
        .join(sizes.where("before > 0").select("conv", "part", "before"), ["conv", "part"], "left")
        .select("conv", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("pos"), "c1", "c2", "words")
    )


def segments(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, seg, p1, p2, ids, words, more): the rebuilt conversations, BLOCK
    turns a row, with the hash of the turns before and whether turns follow."""
    own = stored(positions(turns, conv, turn, role, text), "turn-positions")
    taken = F.crc32(F.col("conv").cast("string")) % HEADS
    leader = F.col("conv") - F.col("conv") % GROUP
    sizes = own.groupBy("conv").agg(F.count("*").alias("own"))
    lead = sizes.where(F.col("conv") % GROUP == 0).select(F.col("conv").alias("leader"), F.col("own").alias("led"))
    convs = sizes.withColumns({"taken": taken, "leader": leader}).join(lead, "leader", "left")
    convs = convs.withColumn("head", F.least("taken", F.coalesce("led", F.lit(0))))
    convs = stored(convs.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("taken"), F.lit(0))), "conversations")

    heads = own.where((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "leader")
    first = convs.join(heads, "leader").where(F.col("pos") <= F.col("taken")).select("conv", "pos", "c1", "c2", "words")
    later = own.where(F.col("pos") > taken).join(convs.select("conv", "taken", "head"), "conv")
    later = later.select("conv", (F.col("pos") - F.col("taken") + F.col("head")).alias("pos"), "c1", "c2", "words")
    ids = first.unionAll(later).select(
        "conv", F.floor((F.col("pos") - 1) / BLOCK).alias("seg"), "pos",
        _hash(1, "pos", "c1", "c2").alias("t1"), _hash(2, "pos", "c1", "c2").alias("t2"), "words",
    )
    cut = ids.groupBy("conv", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "words"))).alias("turns"), F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2")
    )
    rows = stored(convs.select("conv", "length").join(cut, "conv", "left").withColumn("seg", F.coalesce("seg", F.lit(0))), "segments")
    upto = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.where(F.col("length") > BLOCK).select("conv", "seg", F.bit_xor("x1").over(upto).alias("p1"), F.bit_xor("x2").over(upto).alias("p2"))
    rows = rows.withColumn("turns", F.coalesce("turns", F.array())).join(before.where("seg > 0"), ["conv", "seg"], "left")
    return rows.select(
        "conv", "seg", F.coalesce("p1", F.lit(0)).alias("p1"), F.coalesce("p2", F.lit(0)).alias("p2"),
        F.transform("turns", lambda x: F.struct(x["t1"].alias("t1"), x["t2"].alias("t2"))).alias("ids"),
        F.transform("turns", lambda x: x["words"].cast("long")).alias("words"),
        (F.col("length") > (F.col("seg") + 1) * BLOCK).cast("int").alias("more"),
    )


class Matrix:
    """A shard's rows in order, its neighbours' rows (``ghost``) included."""

    def __init__(self, table: pa.Table):
        def column(name):
            return table[name].to_numpy().astype(np.int64)

        ids, words = (table[c].combine_chunks() for c in ("ids", "words"))
        ids, words = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (ids, words))
        size = pc.list_value_length(ids).to_numpy().astype(np.int64)
        pairs = ids.flatten()
        a, b = (pairs.field(i).to_numpy() for i in (0, 1))
        by = np.lexsort((b, a))
        new = np.append([False], (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1]))[: len(a)]
        rank = np.empty(len(a), dtype=np.int32)
        rank[by] = np.cumsum(new) + 1
        self.width = int(size.max(initial=0))
        filled = np.arange(self.width) < size[:, None]
        turn = np.zeros(filled.shape, dtype=np.int32)
        turn[filled] = rank
        keys = {c: column(c) for c in ("seg", "p1", "p2", "more", "conv", "ghost")}
        self.order = order = np.lexsort((keys["conv"], keys["more"], *turn.T[::-1], keys["p2"], keys["p1"], keys["seg"]))
        for name, values in keys.items():
            setattr(self, name, values[order])
        self.size, self.real = size[order], self.ghost == 0
        turn = turn[order]

        # Where a row leaves the one above it, and so starts a node.
        change = np.ones((len(order), self.width + 1), dtype=bool)
        change[1:, 0] = (self.seg[1:] != self.seg[:-1]) | (self.p1[1:] != self.p1[:-1]) | (self.p2[1:] != self.p2[:-1])
        change[1:, 1:] = turn[1:] != turn[:-1]
        self.change = np.logical_or.accumulate(change, axis=1)
        self.reach = self.size[:, None] >= np.arange(self.width + 1)
        #: Turns shared with the row above; -1 if the prefix before differs.
        self.shared = (self.reach & ~self.change).sum(axis=1) - 1

        def along(values, start) -> np.ndarray:
            grid = np.zeros((len(order), self.width + 1), dtype=np.int64)
            grid[:, 1:][filled] = values
            grid = grid[order]
            grid[:, 0] = start
            return grid

        count = np.zeros(len(a), dtype=np.int64)
        count[np.repeat(keys["ghost"] == 0, size)] = words.flatten().to_numpy()
        self.words = np.cumsum(along(count, 0), axis=1)
        self.key1 = np.bitwise_xor.accumulate(along(a, self.p1), axis=1)
        self.key2 = np.bitwise_xor.accumulate(along(b, self.p2), axis=1)
        below = np.append(self.shared[1:], -1)
        self.leaf = self.real & (self.more == 0) & (below < self.size)

    def saved(self, depth: int) -> np.ndarray:
        """Words of the turns from ``depth`` on that a row shares."""
        upto = np.take_along_axis(self.words, np.maximum(self.shared, 0)[:, None], axis=1)[:, 0]
        return np.where(self.real & (self.shared >= depth), upto - self.words[:, max(depth - 1, 0)], 0)


_DEEP = "conv long, seg long, saved long, leaves long"


def _contributions(table: pa.Table) -> pa.Table:
    """What each segment's row adds to all nodes above its segment."""
    m = Matrix(table)
    columns = [x[m.real] for x in (m.conv, m.seg, m.saved(1), m.leaf.astype(np.int64))]
    return pa.table([pa.array(x, pa.int64()) for x in columns], names=["conv", "seg", "saved", "leaves"])


#: A node that is complete, one whose parent is not in the shard alone, a part
#: of a node that other shards or deeper segments share, a piece of its ends.
DONE, CHILD, PART, ENDS = range(4)
_FIGURES = ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
#: Columns in which the greatest long stands for null.
_NULLS = ("y1", "y2", "conv_id", "parent_conv_id")
_NODES = "kind int, depth long, x1 long, x2 long, y1 long, y2 long, " + ", ".join(f"{c} long" for c in _FIGURES) + ", ends string"


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _nodes(root_conv: int):
    def run(table: pa.Table) -> pa.Table:
        m = Matrix(table)
        deep = {c: table[c].to_numpy()[m.order] for c in ("saved", "leaves")}
        conv = np.where(m.real, m.conv, _MOST)
        out: list[list] = [[] for _ in range(13)]
        above = None
        for k in range(m.width + 1):
            rows = np.flatnonzero(m.reach[:, k])
            first = np.flatnonzero(m.change[rows, k])
            top = rows[first]
            run_of = np.full(len(m.conv), -1)
            run_of[rows] = np.cumsum(m.change[rows, k]) - 1

            def total(x):
                return np.add.reduceat(x[rows].astype(np.int64), first)

            n_convs, n_leaves, saved = total(m.real), total(m.leaf + deep["leaves"]), total(m.saved(k) + deep["saved"])
            least = np.minimum.reduceat(conv[rows], first)
            n_children = total(m.real & m.change[:, k + 1] & m.reach[:, k + 1]) if k < m.width else np.zeros(len(top), dtype=np.int64)
            part = np.maximum.reduceat(m.ghost[rows], first) > 0
            part |= (k == 0) | ((k == BLOCK) & (np.maximum.reduceat(m.more[rows], first) > 0))
            here = n_convs > 0
            # The start of a deeper segment is a node of the segment before.
            stub = (k == 0) & (m.seg[top] > 0)
            for x in (n_convs, n_leaves, saved):
                x[stub] = 0
            kind = np.where(part, PART, DONE)
            parent = np.full(len(top), _MOST)
            y1 = y2 = parent
            if above is not None:
                of, conv_above, part_above = above
                unknown = part_above[of[top]]
                is_root = (k == 1) & (m.seg[top] == 0)
                parent = np.where(is_root, root_conv, np.where(unknown, _MOST, conv_above[of[top]]))
                kind = np.where(~part & unknown & ~is_root, CHILD, kind)
                y1, y2 = m.key1[top, k - 1], m.key2[top, k - 1]

            # Rows that end here are the first of their node, by id.
            ending = rows[(m.size[rows] == k) & (m.more[rows] == 0) & m.real[rows]]
            owner = run_of[ending]
            digest = np.full(len(top), NO_ENDS, dtype=object)
            starts = np.flatnonzero(np.append([True], owner[1:] != owner[:-1])) if len(ending) else []
            for i, j in zip(starts, [*starts[1:], len(ending)]):
                node, ids = owner[i], m.conv[ending[i:j]]
                if not part[node]:
                    digest[node] = sha256(_joined(ids).encode()).hexdigest()
                    continue
                for p in range(0, len(ids), PIECE):
                    t = top[node]
                    for column, value in zip(out, (ENDS, m.seg[t] * BLOCK + k, m.key1[t, k], m.key2[t, k], 0, 0, ids[p], _MOST, 0, 0, 0, 0, _joined(ids[p : p + PIECE]))):
                        column.append([value])
            values = (kind, m.seg[top] * BLOCK + k, m.key1[top, k], m.key2[top, k], y1, y2, np.where(stub, _MOST, least), parent, n_convs, n_children, n_leaves, saved, digest)
            for column, value in zip(out, values):
                column.append(value[here])
            above = run_of, least, part
        names = [c.split()[0] for c in _NODES.split(", ")]
        columns = []
        for name, parts in zip(names, out):
            if name == "ends":
                columns.append(pa.array([x for p in parts for x in p], pa.string()))
            elif name == "kind":
                columns.append(pa.array(np.concatenate(parts).astype(np.int32)))
            else:
                values = np.concatenate(parts).astype(np.int64)
                columns.append(pa.array(values, mask=(values == _MOST) if name in _NULLS else None))
        return pa.table(columns, names=names)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list of ends, streamed over its sorted pieces."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x], pa.int64()) for x in key] + [pa.array([state.hexdigest()])], names=["depth", "x1", "x2", "ends"])

    for batch in batches:
        for *k, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "x1", "x2", "ends"))):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    yield done()
                key, state = k, sha256()
            state.update(piece.encode())
    if key is not None:
        yield done()


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    ship(spark)
    rows = stored(segments(turns, conv, turn, role, text), "trie-segments")
    n = max(spark.sparkContext.defaultParallelism, -(-rows.count() // SHARD))
    key = ["seg", "p1", "p2", "ids", "more", "conv"]
    ranged = stored(rows.repartitionByRange(n, *key).withColumn("shard", F.spark_partition_id()), "trie-shards")

    # Each shard's neighbours; the driver sees one number a shard.
    ends = stored(ranged.groupBy("shard").agg(F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key)).alias("last")), "shard-ends")
    shards = sorted(r[0] for r in ends.select("shard").collect())
    near = spark.createDataFrame(list(zip(shards[1:], shards[:-1])), "after int, before int")
    ghosts = near.join(ends, F.col("shard") == F.col("before")).select(F.col("after").alias("at"), "last.*").unionAll(
        near.join(ends, F.col("shard") == F.col("after")).select(F.col("before").alias("at"), "first.*")
    )
    ghosts = ghosts.withColumnRenamed("at", "shard").withColumns({"words": F.array().cast("array<bigint>"), "ghost": F.lit(1)})
    real = ranged.withColumn("ghost", F.lit(0))

    tall = real.where("seg > 0").unionByName(ghosts.where("seg > 0"))
    added = tall.groupBy("shard").applyInArrow(_contributions, _DEEP)
    deeper = Window.partitionBy("conv").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deep = added.select(
        "conv", (F.col("seg") - 1).alias("seg"), F.sum("saved").over(deeper).alias("saved"), F.sum("leaves").over(deeper).alias("leaves")
    )
    whole = real.join(deep, ["conv", "seg"], "left").unionByName(ghosts.withColumns({"saved": F.lit(0), "leaves": F.lit(0)}))
    whole = whole.fillna(0, ["saved", "leaves"])
    root = rows.agg(F.min("conv")).first()[0] or 0
    nodes = stored(whole.groupBy("shard").applyInArrow(_nodes(root), _NODES), "trie-nodes")

    place = ["depth", "x1", "x2"]
    parts = nodes.where(F.col("kind") == PART).groupBy(*place).agg(
        *[F.max(c).alias(c) for c in ("y1", "y2")], F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in _FIGURES[2:]],
    )
    pieces = nodes.where(F.col("kind") == ENDS).select(*place, "conv_id", "ends")
    pieces = pieces.repartition(*place).sortWithinPartitions(*place, "conv_id").drop("conv_id")
    digests = pieces.mapInArrow(_digests, "depth long, x1 long, x2 long, ends string")
    parts = stored(parts.join(digests, place, "left").fillna(NO_ENDS, ["ends"]), "trie-parts")
    above = parts.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("conv_id").alias("above"))
    cols = ["depth", "y1", "y2", *_FIGURES, "ends"]
    open_ = nodes.where(F.col("kind") == CHILD).select(*cols).unionByName(parts.select(*cols))
    found = open_.join(above, ["depth", "y1", "y2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    last = ["conv_id", "depth", *_FIGURES[1:], F.col("ends").alias("ends_sha256")]
    return nodes.where(F.col("kind") == DONE).select(*last).unionByName(found.select(*last))
