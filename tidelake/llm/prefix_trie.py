"""The trie of conversations that begin with the same turns, with totals of its subtrees.

A node is a distinct sequence of first turns (role and text). It is told by 128 bits: the
exclusive or of the hashes of its turns, each hashed with its place, so that the key of a
prefix is a running value and that of its parent one step back. A node bears the smallest
id of the conversations through it, which with its depth names it.

Totals come by time-forward processing. The nodes are dealt into shards, ranges of an
order that keeps conversations with the same first turns together; Spark sorts each shard
by reverse level order, and one pass over it hands the total of every node to its parent
through a priority queue that spills to disk. What a parent in another shard should get
leaves the shard, summed for each such parent. These parents make a much smaller tree, in
which a node's parent is the one its piece of a shard reports to; it is solved in the same
way, and a second pass over the shards then has all that comes from outside.

Conversations of any length are numbered in sorted ranges, not in one task; of copies only
counts and, for the digest of ids, blocks of ids in ascending order meet.

Rows without a conversation id take no part; null role or text is empty; turns are ordered
by number (null first), then role and text, and repeated rows are turns of their own. An
empty table gives no nodes. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidelake.llm.tables import small_batches, written

# Entries of a queue in memory, and entries of a spilled run that are read at a time.
QUEUE_ENTRIES = 200_000
RUN_ENTRIES = 1_000
# Trees of contracted shards up to this size are solved in one pass.
ONE_SHARD = 100_000
# First turns by which nodes are dealt into shards.
ORDER_TURNS = 3
# Ids of one block of a digest.
BLOCK_IDS = 1_024

_WORD = r"[^\x20\x09-\x0D]+"
_PLACE_BITS = 33


class SpillingQueue:
    """A priority queue whose entries beyond ``limit`` lie in sorted runs on disk."""

    def __init__(self, limit: int = QUEUE_ENTRIES):
        self._limit, self._heap, self._runs, self._spills = limit, [], [], 0

    def __bool__(self) -> bool:
        return bool(self._heap or self._runs)

    def push(self, entry: tuple) -> None:
        heapq.heappush(self._heap, entry)
        if len(self._heap) >= self._limit:
            run = self._read(self._write(sorted(self._heap)))
            self._heap = []
            heapq.heappush(self._runs, (next(run), self._spills, run))
            self._spills += 1

    def peek(self) -> tuple:
        if not self._heap or not self._runs:
            return self._heap[0] if self._heap else self._runs[0][0]
        return min(self._heap[0], self._runs[0][0])

    def pop(self) -> tuple:
        if not self._runs or self._heap and self._heap[0] <= self._runs[0][0]:
            return heapq.heappop(self._heap)
        entry, number, run = self._runs[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self._runs)
        else:
            heapq.heapreplace(self._runs, (following, number, run))
        return entry

    @staticmethod
    def _write(entries: list[tuple]):
        file = tempfile.TemporaryFile()  # of this task only, gone with it
        for at in range(0, len(entries), RUN_ENTRIES):
            pickle.dump(entries[at : at + RUN_ENTRIES], file)
        file.seek(0)
        return file

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    block = pickle.load(file)
                except EOFError:
                    return
                yield from block


def _climb(batches: Iterator[pa.RecordBatch], queue_entries: int):
    """Subtree sums within shards, from rows in reverse level order.

    Yields a batch with the lists of its sums, and between them (target, sums, open nodes
    below) of what has to leave a shard.
    """
    shard, queue = None, SpillingQueue(queue_entries)

    def leave(bound: tuple | None):
        """What is for nodes before ``bound``, which this shard does not have."""
        while queue and (bound is None or queue.peek()[:2] < bound):
            target, first, second, inside = queue.peek()[:2], 0, 0, []
            while queue and queue.peek()[:2] == target:
                _, _, a, b, more = queue.pop()
                first, second = first + a, second + b
                inside.extend(more)
            yield target, first, second, inside

    for batch in batches:
        firsts, seconds = [], []
        columns = [batch.column(name).to_pylist() for name in ("shard", "depth", "conv_id", "up_depth", "up_conv")]
        own = [batch.column(name).to_pylist() for name in ("leaves", "saved", "open")]
        for of, depth, conv, up_depth, up_conv, first, second, is_open in zip(*columns, *own, strict=True):
            if of != shard:
                yield from leave(None)
                shard = of
            here = (-depth, conv)
            yield from leave(here)
            inside = [(depth, conv)] if is_open else []
            while queue and queue.peek()[:2] == here:
                _, _, a, b, more = queue.pop()
                first, second = first + a, second + b
                if len(more) > len(inside):
                    inside, more = more, inside
                inside.extend(more)
            if up_conv is not None:
                queue.push((-up_depth, up_conv, first, second, inside))
            firsts.append(first)
            seconds.append(second)
        yield batch, firsts, seconds
    yield from leave(None)


_LEAVING = "up_depth long, up_conv long, leaves long, saved long, inside array<struct<depth:long,conv_id:long>>"


def _leaving(sharded: DataFrame, queue_entries: int) -> DataFrame:
    """A row for each shard and node outside that it reports to, with the open nodes whose pieces do."""
    kind = pa.list_(pa.struct([("depth", pa.int64()), ("conv_id", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            depths, convs, firsts, seconds, inside = zip(*rows, strict=True)
            inside = [[{"depth": d, "conv_id": c} for d, c in nodes] for nodes in inside]
            columns = [pa.array(c, pa.int64()) for c in (depths, convs, firsts, seconds)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(inside, kind)], ["up_depth", "up_conv", "leaves", "saved", "inside"]
            )

        for step in _climb(batches, queue_entries):
            if len(step) == 4:
                (depth, conv), first, second, inside = step
                rows.append((-depth, conv, first, second, inside))
                if len(rows) >= RUN_ENTRIES:
                    yield out()
                    rows.clear()
        if rows:
            yield out()

    return sharded.mapInArrow(work, _LEAVING)


def _totals(sharded: DataFrame, queue_entries: int) -> DataFrame:
    """The rows with their sums in place of what they had of their own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in _climb(batches, queue_entries):
            if len(step) == 3:
                batch, firsts, seconds = step
                for name, values in (("leaves", firsts), ("saved", seconds)):
                    batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, pa.int64()))
                yield batch

    return sharded.mapInArrow(work, sharded.schema)


def _in_reverse_levels(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "conv_id")


def subtree_sums(
    nodes: DataFrame, order: list[str], one_shard: int = ONE_SHARD, queue_entries: int = QUEUE_ENTRIES
) -> DataFrame:
    """``nodes`` with ``leaves`` and ``saved`` summed over the subtrees.

    Columns: depth, conv_id (together unique), up_depth, up_conv (the parent, which lies at
    a smaller depth; null for a root), leaves, saved, and any others.
    """
    spark = nodes.sparkSession
    sharded = written(
        nodes.repartitionByRange(*order, "conv_id", "depth").withColumn("shard", F.spark_partition_id()), "trie-shards"
    )
    # Parents with a child in another shard.
    sides = sharded.filter("up_conv IS NOT NULL").select("up_depth", "up_conv", F.col("shard").alias("below")).distinct()
    at = [F.col("up_depth") == F.col("depth"), F.col("up_conv") == F.col("conv_id")]
    opened = sides.join(sharded.select("depth", "conv_id", "shard"), at).filter("below <> shard")
    opened = written(opened.select("depth", "conv_id").distinct(), "trie-open")
    count = opened.count()
    if not count:
        ready = sharded.withColumn("open", F.lit(False))
        return _totals(_in_reverse_levels(ready), queue_entries).drop("shard", "open")
    marked = sharded.join(opened.withColumn("open", F.lit(True)), ["depth", "conv_id"], "left").fillna(False, "open")
    marked = _in_reverse_levels(marked.select("shard", "depth", "conv_id", "up_depth", "up_conv", "leaves", "saved", "open"))
    leaving = written(_leaving(marked, queue_entries), "trie-leaving")
    came = leaving.groupBy(F.col("up_depth").alias("depth"), F.col("up_conv").alias("conv_id")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    links = leaving.select("up_depth", "up_conv", F.explode("inside").alias("node")).select(
        F.col("node.depth").alias("depth"), F.col("node.conv_id").alias("conv_id"), "up_depth", "up_conv"
    )
    between = came.join(links, ["depth", "conv_id"], "left")
    if count <= one_shard or 2 * count > sharded.count():
        whole = between.withColumn("shard", F.lit(0)).withColumn("open", F.lit(False)).coalesce(1)
        solved = _totals(whole.sortWithinPartitions("shard", F.desc("depth"), "conv_id"), queue_entries)
    else:
        solved = subtree_sums(between, [], one_shard, queue_entries)
    inflow = written(solved.select("depth", "conv_id", F.col("leaves").alias("_l"), F.col("saved").alias("_s")), "trie-inflow")
    fed = (
        sharded.join(inflow, ["depth", "conv_id"], "left")
        .withColumn("leaves", F.col("leaves") + F.coalesce("_l", F.lit(0)))
        .withColumn("saved", F.col("saved") + F.coalesce("_s", F.lit(0)))
        .withColumn("open", F.lit(False))
        .drop("_l", "_s")
    )
    return _totals(_in_reverse_levels(fed), queue_entries).drop("shard", "open")


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), a, b (128 bits of role and text) and words of each turn.

    The turns are sorted in ranges and numbered by them, so that one conversation may
    hold any share of the rows. Only the beginnings of texts travel to find the ranges.
    """
    rows = df.select(
        df[conv].cast("long").alias("conv_id"),
        df[turn].alias("turn"),
        F.coalesce(df[role], F.lit("")).alias("role"),
        F.coalesce(df[text], F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    first = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first()]
    ordered = rows.repartitionByRange(*first, F.substring("role", 1, 64), F.substring("text", 1, 64))
    ordered = ordered.sortWithinPartitions(*first, "role", "text")
    stored = written(
        ordered.select(
            "conv_id",
            F.monotonically_increasing_id().alias("id"),
            F.xxhash64(F.lit(1), "role", "text").alias("a"),
            F.xxhash64(F.lit(2), "role", "text").alias("b"),
            F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"),
        ),
        "trie-turns",
    )
    part = F.shiftright("id", _PLACE_BITS).alias("part")
    within = F.col("id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    earlier = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    # One row for each partition.
    numbered = stored.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("number", F.col("earlier") + within)
    firsts = numbered.groupBy("conv_id").agg(F.min("number").alias("first"))
    placed = numbered.join(firsts, "conv_id")
    return placed.select("conv_id", (F.col("number") - F.col("first") + 1).alias("place"), "a", "b", "words")


def share_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Let each conversation begin with the first turns of the one that opens its block of ids.

    Conversation c takes the first h = crc32(c) % ``most`` turns of c - c % ``every`` (as
    many as that has), followed by its own turns after its first h. Returns the turns
    (conv_id, depth, length of the conversation, a, b, words) and all (conv_id, length).
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = written(
        convs.withColumn("h", h).withColumn("opens", F.col("conv_id") - F.col("conv_id") % every), "trie-conversations"
    )
    there = convs.select(F.col("conv_id").alias("opens"), F.col("n").alias("given"))
    k = F.least("h", F.coalesce("given", F.lit(0)))
    length = k + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    known = convs.join(there, "opens", "left").select("conv_id", "opens", "h", k.alias("k"), length.alias("length"))
    own = (
        turns.join(known.drop("opens"), "conv_id")
        .filter("place > h")
        .select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "length", "a", "b", "words")
    )
    # At most ``most`` - 1 turns for each of at most 2 * ``every`` - 1 conversations.
    heads = turns.filter((F.col("conv_id") % every == 0) & (F.col("place") < most)).withColumnRenamed("conv_id", "opens")
    shared = (
        known.join(heads, "opens").filter("place <= k").select("conv_id", F.col("place").alias("depth"), "length", "a", "b", "words")
    )
    return own.unionByName(shared), known.select("conv_id", "length")


def _running(turns: DataFrame) -> DataFrame:
    """The turns with p and q, the running exclusive ors of u and v within a conversation."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, [np.int64(0)] * 2
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            begins = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]])
            segment = np.cumsum(begins)
            for k, (name, to) in enumerate((("u", "p"), ("v", "q"))):
                hashes = batch.column(name).to_numpy()
                total = np.bitwise_xor.accumulate(hashes)
                base = np.concatenate([[carry[k]], (total ^ hashes)[begins]])
                value = total ^ base[segment]
                carry[k] = value[-1]
                batch = batch.set_column(batch.schema.get_field_index(to), to, pa.array(value))
            last = conv[-1]
            yield batch

    hashed = [F.xxhash64(F.lit(side), "depth", "a", "b").alias(name) for side, name in ((1, "u"), (2, "v"))]
    rows = (
        turns.select("conv_id", "depth", "length", "words", *hashed)
        .repartitionByRange("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth")
        .withColumns({"p": F.lit(0).cast("long"), "q": F.lit(0).cast("long"), "part": F.spark_partition_id()})
    )
    local = written(rows.mapInArrow(work, rows.schema), "trie-prefixes")
    # A conversation may begin in an earlier partition: one row for each partition.
    ends = local.groupBy("part").agg(
        F.min("conv_id").alias("first"),
        F.max("conv_id").alias("last"),
        F.max_by(F.struct("p", "q"), F.struct("conv_id", "depth")).alias("end"),
    )
    so_far = Window.partitionBy("last").orderBy("part")
    running = [F.bit_xor(f"end.{name}").over(so_far).alias(name) for name in ("p", "q")]
    chained = ends.select("part", "first", "last", *running).select(
        "part", "first", F.lag(F.struct("last", "p", "q")).over(Window.orderBy("part")).alias("earlier")
    )
    carried = chained.filter("earlier.last = first").select(
        "part", F.col("first").alias("conv_id"), F.col("earlier.p").alias("_p"), F.col("earlier.q").alias("_q")
    )
    joined = local.join(F.broadcast(carried), ["part", "conv_id"], "left")
    return joined.select(
        "conv_id", "depth", "length", "words", "u", "v",
        *[F.col(name).bitwiseXOR(F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in ("p", "q")],
    )


_KEY = ["depth", "p", "q"]


def _digests(ends: DataFrame) -> DataFrame:
    """The digest of the ids of each node's conversations that end there, in ascending order.

    Sorted ranges are joined to blocks of ids, and the blocks of a node are then read one
    by one: a digest has no parallel form, but no more than a block is held.
    """
    kinds = [pa.int64()] * 4 + [pa.string()]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        for batch in batches:
            rows = []
            for *key, conv in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if ids and (key != node or len(ids) >= BLOCK_IDS):
                    rows.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = key
                ids.append(conv)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [*_KEY, "first", "ids"]
                )
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], k) for value, k in zip((*node, ids[0], ",".join(map(str, ids))), kinds, strict=True)],
                [*_KEY, "first", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, seen = None, None
        names = [*_KEY, "ends_sha256"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [*kinds[:3], kinds[4]], strict=True)], names)

        for batch in batches:
            rows = []
            columns = [batch.column(name).to_pylist() for name in (*_KEY, "ids")]
            for *key, ids in zip(*columns, strict=True):
                if key == node:
                    seen.update(b",")
                else:
                    if seen is not None:
                        rows.append((*node, seen.hexdigest()))
                    node, seen = key, hashlib.sha256()
                seen.update(ids.encode())
            if rows:
                yield out(rows)
        if seen is not None:
            yield out([(*node, seen.hexdigest())])

    ordered = ends.select(*_KEY, "conv_id").repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    joined = ordered.mapInArrow(blocks, "depth long, p long, q long, first long, ids string")
    return (
        joined.repartition(*_KEY)
        .sortWithinPartitions(*_KEY, "first")
        .mapInArrow(digest, "depth long, p long, q long, ends_sha256 string")
    )


def trie(turns: DataFrame, convs: DataFrame, one_shard: int = ONE_SHARD, queue_entries: int = QUEUE_ENTRIES) -> DataFrame:
    """The nodes of the conversations, from their turns (conv_id, depth, length, a, b, words).

    ``convs`` has every conversation with its length, also those without a turn. Columns:
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (words of the last turn for each member but one, over the subtree) and
    ends_sha256 (of the members that end here).
    """
    small_batches(turns.sparkSession)
    prefixes = written(_running(turns), "trie-keys")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    nodes = prefixes.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.max("u").alias("u"),
        F.max("v").alias("v"),
    )
    nodes = nodes.unionByName(root.select(*[zero.alias(n) for n in (*_KEY, "words", "u", "v")], "conv_id", "n_convs"))
    firsts = prefixes.filter(F.col("depth") <= ORDER_TURNS).groupBy("conv_id").agg(
        *[F.max(F.when(F.col("depth") == i, F.col("p"))).alias(f"turn{i}") for i in range(1, ORDER_TURNS + 1)]
    )
    ends = prefixes.filter("depth = length").select(*_KEY, "conv_id").unionByName(
        convs.filter("length = 0").select(*[zero.alias(n) for n in _KEY], "conv_id")
    )
    up = [(F.col("depth") - 1).alias("up_depth"), F.col("p").bitwiseXOR(F.col("u")).alias("up_p"), F.col("q").bitwiseXOR(F.col("v")).alias("up_q")]
    nodes = written(
        nodes.select(*_KEY, *up, "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-nodes"
    )
    below = nodes.filter("depth > 0")
    children = below.groupBy("up_depth", "up_p", "up_q").agg(F.count(F.lit(1)).alias("n_children")).toDF(*_KEY, "n_children")
    parents = nodes.select(*[F.col(n).alias(f"up_{n}") for n in _KEY], F.col("conv_id").alias("up_conv"))
    tree = written(
        nodes.join(parents, [f"up_{n}" for n in _KEY], "left").drop("up_p", "up_q"), "trie-parents"
    )
    tree = (
        tree.join(children, _KEY, "left")
        .join(_digests(ends), _KEY, "left")
        .join(firsts, "conv_id", "left")
        .fillna(0, "n_children")
        .fillna(hashlib.sha256().hexdigest(), "ends_sha256")
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .drop("p", "q")
    )
    done = subtree_sums(tree, [f"turn{i}" for i in range(1, ORDER_TURNS + 1)], one_shard, queue_entries)
    return done.select(
        "conv_id",
        "depth",
        F.col("up_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def whole_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations for :func:`trie`, as they are."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return turns.withColumnRenamed("place", "depth").join(convs, "conv_id"), convs
