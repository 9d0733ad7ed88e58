"""The prefix trie of conversations, with totals of every subtree by time-forward processing.

A node is a distinct sequence of first turns. It is known by its depth and by the exclusive or of one
128-bit hash for each turn and place, so that prefixes come from running aggregates that any number of
tasks can share, also inside one conversation.

Conversations are dealt over shards by a hash, and depths are cut into bands. One shard and band is a
piece: its nodes are sorted by reverse level order outside memory (Spark's sort), and each passes the
totals of its subtree to its parent through a priority queue that spills (``Messages``). A node's own
share counts in one shard only, that of its smallest member, so the totals of a node that several
shards hold are added up afterwards. What the deeper bands of a conversation amount to is
known from sums over its nodes, and enters its piece as a message to the deepest node there.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import prepare, records
from assay.operators.surrogate import with_surrogate_key
from assay.session import stage

BAND = 1 << 16  # levels in a piece
BLOCK = 1 << 12  # turns of one conversation that one window takes
ENDS = 16  # bits of the ids that are joined in one step
QUEUE = 200_000  # messages held in memory

NODE = ["depth", "pa", "pb"]
TOTALS = [*NODE, "children", "leaves", "saved"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turns, ha, hb, points)`` of each turn: its place from 1 in its conversation.

    Turns follow each other by number, null first, level ones by a hash of role and text; a null role
    or text is empty. Rows without ``conv_id`` take no part. All tasks share the numbering, so a
    conversation of any length is no task's alone.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("ha"),
        F.xxhash64(F.lit(2), role, text).alias("hb"),
        F.length(text).cast("long").alias("points"),
    )
    numbered = with_surrogate_key(rows, "number", ["conv_id", "turn"], ["ha", "hb"])
    spans = numbered.groupBy("conv_id").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("turns")
    )
    place = F.col("number") - F.col("first") + 1
    return numbered.join(spans, "conv_id").select(
        "conv_id", place.alias("place"), "turns", "ha", "hb", "points"
    )


def branched(
    conversations: DataFrame, block: int = 100, classes: int = 6
) -> tuple[DataFrame, DataFrame]:
    """Conversations that share first turns: the turns, and all ids with their number of turns.

    Each conversation ``c`` is the first ``crc32(c) mod classes`` turns of the conversation
    ``c - c % block`` (all if fewer, none if absent), then its own turns after as many.
    """
    turns = stage(numbered_turns(conversations), "turns")
    heads = (
        turns.where((F.col("conv_id") % block == 0) & (F.col("place") < classes))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "ha", "hb", "points"))).alias("head"))
    )
    shared = F.crc32(F.col("conv_id").cast("string")) % classes
    listed = (
        turns.groupBy("conv_id")
        .agg(F.first("turns").alias("own"))
        .withColumns({"base": F.col("conv_id") - F.col("conv_id") % block, "h": shared})
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h").cast("int")))
        .withColumn("taken", F.size("head").cast("long"))
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    first = listed.select("conv_id", F.inline("head")).withColumnRenamed("place", "depth")
    rest = (
        turns.join(listed.select("conv_id", "h", "taken"), "conv_id")
        .where("place > h")
        .withColumn("depth", F.expr("place - h + taken"))
    )
    columns = ["conv_id", "depth", "ha", "hb", "points"]
    return first.select(*columns).unionByName(rest.select(*columns)), listed.select("conv_id", "length")


def prefix_trie(
    turns: DataFrame, lengths: DataFrame, levels: int = BAND, queue: int = QUEUE
) -> DataFrame:
    """One row per node of the trie of all conversations, the textless root among them.

    ``turns`` has ``conv_id, depth`` (from 1, without gaps), ``ha, hb`` (a 128-bit hash of the turn)
    and ``points`` (what a token saved counts); ``lengths`` has ``conv_id, length`` once for every
    conversation, also those without a turn. Per node: ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, the hash of the ids that end there. Without conversations
    there is no row. ``levels`` of a piece and messages in a ``queue`` bound memory, not results.
    """
    spark = turns.sparkSession
    prepare(spark)
    paths = stage(_paths(turns, lengths), "paths")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shard(conv_id: str) -> Column:
        return F.pmod(F.xxhash64(conv_id), F.lit(shards)).cast("int")

    band = F.expr(f"depth div {levels}")
    held = paths.groupBy(shard("conv_id").alias("shard"), *NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("length").alias("length"),
        *(F.max(c).alias(c) for c in ("points", "qa", "qb")),
    )
    held = stage(held.withColumn("band", band), "held")
    nodes = held.groupBy(*NODE, "band").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        (F.max("length") == F.col("depth")).cast("long").alias("leaves"),
        ((F.sum("n_convs") - 1) * F.max("points")).alias("saved"),
        *(F.max(c).alias(c) for c in ("qa", "qb")),
    )
    nodes = stage(nodes, "nodes")

    place = ["shard", "band", *NODE, "qa", "qb"]
    none = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved", "own")}
    pieces = (
        held.select(*place).withColumns(none)
        .unionByName(
            nodes.withColumn("shard", shard("conv_id"))
            .withColumns({"own": F.lit(1).cast("long"), "children": F.lit(0).cast("long")})
            .select(*place, *none)
        )
        .unionByName(_from_deeper(paths, nodes, levels, shard).select(*place, *none))
        .repartition("shard", "band")
        .sortWithinPartitions("shard", "band", F.desc("depth"), "pa", "pb")
    )
    passed = partial(_time_forward, levels=levels, most=queue)
    totals = (
        pieces.mapInArrow(passed, ", ".join(f"{c} long" for c in TOTALS))
        .groupBy(*NODE)
        .agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("pa").alias("qa"),
        F.col("pb").alias("qb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nothing = hashlib.sha256().hexdigest()
    return (
        nodes.drop("leaves", "saved")
        .join(totals, NODE)
        .join(_ends(paths), NODE, "left")
        .join(parents, ["depth", "qa", "qb"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def _paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each conversation at each of its depths: the node there (pa, pb) and its parent (qa, qb)."""
    salted = turns.withColumns(
        {
            "za": F.xxhash64("ha", "depth"),
            "zb": F.xxhash64("hb", "depth"),
            "block": F.floor((F.col("depth") - 1) / BLOCK),
        }
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    running = salted.withColumns({x: F.bit_xor(z).over(inside) for x, z in (("xa", "za"), ("xb", "zb"))})
    blocks = salted.groupBy("conv_id", "block").agg(F.bit_xor("za").alias("ya"), F.bit_xor("zb").alias("yb"))
    blocks = blocks.withColumns({y: F.coalesce(F.bit_xor(y).over(before), F.lit(0)) for y in ("ya", "yb")})
    below = (
        running.join(blocks, ["conv_id", "block"])
        .withColumns({"pa": F.expr("xa ^ ya"), "pb": F.expr("xb ^ yb")})
        .withColumns({"qa": F.expr("pa ^ za"), "qb": F.expr("pb ^ zb")})
        .join(lengths, "conv_id")
    )
    zero = F.lit(0).cast("long")
    root = lengths.withColumns({c: zero for c in ("depth", "pa", "pb", "qa", "qb", "points")})
    columns = ["conv_id", "length", *NODE, "qa", "qb", "points"]
    return below.select(*columns).unionByName(root.select(*columns))


def _from_deeper(paths: DataFrame, nodes: DataFrame, levels: int, shard) -> DataFrame:
    """What the deeper bands of each conversation add to the deepest node of each of its bands."""
    own = nodes.groupBy("conv_id", "band").agg(
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.max((F.col("depth") % levels == 0).cast("long")).alias("children"),
    )
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    below = (
        own.where("band > 0")
        .withColumns({c: F.sum(c).over(deeper) for c in ("leaves", "saved")})
        .withColumns({"band": F.col("band") - 1, "own": F.lit(0).cast("long")})
    )
    # A conversation's own nodes are the deepest of its path: they may begin below a band's top, but
    # once begun they hold every deeper band. Bands above the first own one get its sum each.
    edges = paths.where((F.col("depth") % levels == levels - 1) & (F.col("length") > F.col("depth")))
    edges = edges.withColumn("band", F.expr(f"depth div {levels}"))
    first = below.groupBy("conv_id").agg(
        F.min("band").alias("lowest"), *(F.max_by(c, -F.col("band")).alias(c) for c in ("leaves", "saved"))
    )
    upper = (
        edges.join(first, "conv_id")
        .where("band < lowest")
        .withColumns({"children": F.lit(0).cast("long"), "own": F.lit(0).cast("long")})
        .drop("lowest")
    )
    exact = edges.join(below, ["conv_id", "band"])
    return exact.unionByName(upper).withColumn("shard", shard("conv_id"))


class Messages:
    """A priority queue of additions to nodes, of which it holds a bounded number in memory.

    When full, it adds up what is meant for the same node and writes the rest in order to a file that
    has no name and goes with the task, as Spark's own spills do; no other task reads it.
    """

    ROW = np.dtype([(c, "<i8") for c in TOTALS])  # the level in place of the depth
    READ = 4096

    def __init__(self, most: int):
        self.most, self.heap, self.runs = most, [], []

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.most:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        added: dict[tuple, list] = {}
        for message in self.heap:
            sums = added.setdefault(message[:3], [0, 0, 0])
            for k in range(3):
                sums[k] += message[3 + k]
        rows = np.array([(*key, *sums) for key, sums in sorted(added.items())], self.ROW)
        file = tempfile.TemporaryFile()
        file.write(rows.tobytes())
        file.seek(0)
        self.heap = []
        self._next(self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while part := file.read(self.READ * self.ROW.itemsize):
                yield from np.frombuffer(part, self.ROW).tolist()

    def _next(self, run: Iterator[tuple]) -> None:
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.runs, (message, id(run), run))

    def take(self, node: tuple) -> tuple[int, int, int]:
        """The sum of all messages to a node."""
        children = leaves = saved = 0
        while self.heap and self.heap[0][:3] == node:
            _, _, _, c, n, s = heapq.heappop(self.heap)
            children, leaves, saved = children + c, leaves + n, saved + s
        while self.runs and self.runs[0][0][:3] == node:
            (_, _, _, c, n, s), _, run = heapq.heappop(self.runs)
            children, leaves, saved = children + c, leaves + n, saved + s
            self._next(run)
        return children, leaves, saved


def _time_forward(
    batches: Iterator[pa.RecordBatch], levels: int, most: int
) -> Iterator[pa.RecordBatch]:
    """Totals of every node within its piece; rows come sorted, several of a node in a row."""
    piece = node = None
    parent = (0, 0)
    sums = [0, 0, 0, 0]
    queue = Messages(most)
    out: list[tuple] = []

    def finish() -> None:
        """Send the node on: what is sent reaches its parent later, since levels only decrease."""
        children, leaves, saved = queue.take(node)
        children, leaves, saved = children + sums[0], leaves + sums[1], saved + sums[2]
        depth = -node[0]
        out.append((depth, node[1], node[2], children, leaves, saved))
        if depth % levels:
            queue.push((1 - depth, *parent, sums[3], leaves, saved))

    def batch() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], TOTALS)
        out.clear()
        return made

    for part in records(batches):
        for shard, band, depth, pa_, pb, qa, qb, *values in zip(
            *(part.column(k).to_pylist() for k in range(part.num_columns))
        ):
            if (-depth, pa_, pb) != node or (shard, band) != piece:
                if node is not None:
                    finish()
                if (shard, band) != piece:
                    piece, queue = (shard, band), Messages(most)
                node, parent, sums = (-depth, pa_, pb), (qa, qb), [0, 0, 0, 0]
            for k in range(4):
                sums[k] += values[k]
        if len(out) >= 4096:
            yield batch()
    if node is not None:
        finish()
    if out:
        yield batch()


def _ends(paths: DataFrame) -> DataFrame:
    """``ends`` of each node at which conversations end: the hash of their ids, in order, by commas.

    Ids are joined by ranges of ``2 ** ENDS`` before they move on, so a node at which a third of all
    conversations end is a few long rows to the task that hashes it, which holds one at a time.
    """
    joined = (
        paths.where("depth = length")
        .groupBy(*NODE, F.shiftright("conv_id", ENDS).alias("range"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .withColumn("ids", F.array_join(F.transform("ids", lambda c: c.cast("string")), ","))
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "range")
        .select(*NODE, "ids")
    )
    return joined.mapInArrow(_hashed, "depth long, pa long, pb long, ends string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*((c, pa.int64()) for c in NODE), ("ends", pa.string())])
    node = digest = None
    out: list[tuple] = []
    for part in records(batches, 64):
        for *key, ids in zip(*(part.column(k).to_pylist() for k in range(4))):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 4096:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema)
            out = []
    if node is not None:
        out.append((*node, digest.hexdigest()))
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema)
