"""Join of documents whose sets of five-word shingles have a Jaccard similarity of 0.8.

1. Documents with equal sets are one class, so that copies never meet pair by pair.
2. Two linked sets share k shingles among the first n - ceil(0.8 n) + k of each, in any
   order that is the same everywhere (prefix filter, with k = 0.15 n). Order: by hash,
   with the most frequent shingles last, so that passages that many documents share
   bring few together. A task combines its own rows first; a shingle then has one row
   for each task at most. Sets that share too little of their prefix with all others
   together are left out, twice, as this may deprive others; the rest that share a
   shingle are chained to the least of them.
3. Components of these chains hold every link. In a large corpus passages that a few
   sets share chain most of them into one, so those too large for one tile are parted:
   only pairs that share enough of their prefixes stay, of sizes that can be linked. Of
   a shingle with few owners the pairs are counted; one with many may be shared by any
   two that hold such ones, and only sets with enough of them are still chained.
   Components are dealt into tiles of bounded size by size class (linked sets differ by
   a quarter at most, so only neighbouring classes meet) and a hash.
4. A tile, or a pair of them, is joined by a signature tree: leaves are bitmaps of the
   shingles of a set, nodes combine them by OR and hold the range of sizes; a dual
   traversal from the root drops node pairs whose largest possible overlap is too
   small, or whose sizes are too far apart. What remains is verified on the sets,
   unless the two are already connected, so that a group of near copies costs about
   one verification for each.
5. Components too large for one tile are first joined within tiles and with the first
   tile of each size class. Only sets outside of the largest class thus connected are
   then joined with all tiles. No link between different components is lost.

Null and empty texts have empty sets and link with nothing. Rows that repeat a key are
documents of their own, of which each gives a row. The null key comes last among ids. An
empty table gives no rows. Columns other than key and text are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.graph import components
from tidelake.llm.memory import enter
from tidelake.llm.shingles import shingle_sets
from tidelake.llm.tables import keyed, probable, sieve, sifted, written

# Similarity of 0.8 in whole numbers: 100 * shared >= 80 * (a + b - shared).
SHARE, OF = 4, 5

# The most frequent shingles that the order puts last; it only changes the work.
HEAVY = 100_000
HEAVY_PER_TASK = 20_000

TILE_SETS = 512
TILE_SHINGLES = 2_000_000
# All leaves of a signature tree together.
SIGNATURE_BYTES = 64 << 20


# Percent of its size by which the prefix of a set is longer, and which it then has to share.
MORE = 15
ROUNDS = 2
# Of a shingle with so many owners at most, pairs are counted.
FEW = 8


def extra(n: int) -> int:
    return max(1, n * MORE // 100)


def least_overlap(n: int) -> int:
    return (SHARE * n + OF - 1) // OF


def prefix_size(n: int) -> int:
    return n - least_overlap(n) + extra(n)


def wanted(n: int) -> int:
    """What a set of n shares at least of its prefix with that of a linked set.

    Prefixes longer by k have k in common; the linked set has 0.8 n or more and so may
    have the smaller k.
    """
    return extra(least_overlap(n))


def enough(shared: int, a: int, b: int) -> bool:
    return (SHARE + OF) * shared >= SHARE * (a + b)


def _batches_of_sets(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    for at in range(0, batch.num_rows, 512):
        part = batch.column(column).slice(at, 512)
        yield from shingle_sets([v.as_buffer().to_pybytes() if v.is_valid else b"" for v in part])


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _table(schema: dict[str, pa.DataType], **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    arrays = [pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in schema.items()]
    return pa.RecordBatch.from_arrays(arrays, list(schema))


_SCAN = {"doc_id": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "shingle": pa.int64()}


def _heavy(sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The shingles that several sets of a task share, the most frequent ones."""
    shingle, n = np.unique(np.concatenate(sets), return_counts=True)
    often = np.flatnonzero(n > 1)
    often = often[np.argsort(-n[often], kind="stable")[:HEAVY_PER_TASK]]
    if len(often):
        yield _table(_SCAN, n=n[often], shingle=shingle[often].view(np.int64))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n and digest of each set; with a shingle instead, how often a task met it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard_join")
        sets, size, seen = [], 0, set()
        for batch in batches:
            n, digests = [], []
            for shingles in _batches_of_sets(batch, 1):
                n.append(len(shingles))
                digests.append(_digest(shingles) if len(shingles) else None)
                if digests[-1] is not None and digests[-1] not in seen:
                    seen.add(digests[-1])
                    sets.append(shingles)
                    size += len(shingles)
            yield _table(_SCAN, doc_id=batch.column(0), n=n, digest=digests)
            if size > TILE_SHINGLES:
                yield from _heavy(sets)
                sets, size, seen = [], 0, set()
        if sets:
            yield from _heavy(sets)

    return documents.mapInArrow(work, "doc_id long, n long, digest binary, shingle long")


class Order:
    """By hash, the heavy shingles last and by frequency."""

    _BITS = 20

    def __init__(self, heavy: np.ndarray):
        """``heavy``: from the least to the most frequent."""
        self._by_hash = np.argsort(heavy)
        self._sorted = heavy[self._by_hash]
        self._maybe = np.zeros(1 << self._BITS, bool)
        self._maybe[heavy >> np.uint64(64 - self._BITS)] = True

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        size = prefix_size(len(shingles))
        maybe = np.flatnonzero(self._maybe[shingles >> np.uint64(64 - self._BITS)])
        if len(maybe):
            at = np.searchsorted(self._sorted, shingles[maybe])
            is_heavy = self._sorted[np.minimum(at, len(self._sorted) - 1)] == shingles[maybe]
            maybe, at = maybe[is_heavy], at[is_heavy]
        if not len(maybe):
            return shingles[:size]
        light = np.delete(shingles, maybe)
        if len(light) >= size:
            return light[:size]
        ranked = shingles[maybe[np.argsort(self._by_hash[at])]]
        return np.concatenate([light, ranked[: size - len(light)]])


# What a row of a shingle says of its class: that it is alone with it in its task, that
# it stands for several of its task, or that it is known to share it.
_ALONE, _SEVERAL, _SHARED = 0, 1, 2
_ROW = {"shingle": pa.int64(), "class": pa.int64(), "state": pa.int8()}
_ROW_KIND = "shingle long, class long, state byte"


def _rows(shingle: np.ndarray, owner: np.ndarray, state) -> pa.RecordBatch:
    state = np.broadcast_to(np.asarray(state, np.int8), shingle.shape)
    return _table(_ROW, **{"shingle": shingle, "class": owner, "state": state})


def _combined(shingles: list[np.ndarray], classes: list[int]) -> Iterator[pa.RecordBatch]:
    """The rows of a task: one for each shingle, and one for each class that shares it here."""
    shingle = np.concatenate(shingles).view(np.int64)
    owner = np.repeat(np.array(classes, np.int64), [len(s) for s in shingles])
    order = np.lexsort((owner, shingle))
    shingle, owner = shingle[order], owner[order]
    opens = np.r_[True, shingle[1:] != shingle[:-1]]
    first = np.flatnonzero(opens)
    several = np.diff(np.r_[first, len(shingle)]) > 1
    yield _rows(shingle[first], owner[first], several)
    shared = several[np.cumsum(opens) - 1]
    if shared.any():
        yield _rows(shingle[shared], owner[shared], _SHARED)


def _shared_across(shingle: np.ndarray, owner: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    """Of rows sorted by shingle and class, those alone in their task but not over all tasks."""
    opens = np.r_[True, shingle[1:] != shingle[:-1]]
    of = np.cumsum(opens) - 1
    other = np.r_[False, ~opens[1:] & (owner[1:] != owner[:-1])]
    met = np.bincount(of, other | (state == _SEVERAL)) > 0
    # Equal sets of several tasks give one row.
    kept = met[of] & (state == _ALONE) & np.r_[True, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1]) | (state[:-1] != _ALONE)]
    return _rows(shingle[kept], owner[kept], _SHARED)


def shared_rows(documents: DataFrame, heavy: np.ndarray) -> DataFrame:
    """shingle and class of each shingle in the prefixes of two or more classes.

    Equal sets in several tasks may give a row twice: once from where their task had
    others that share the shingle, once from where it had none.
    """
    broadcast = documents.sparkSession.sparkContext.broadcast(heavy)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("jaccard_join")
        order, seen, shingles, classes, size = Order(broadcast.value), set(), [], [], 0
        for batch in batches:
            for found in _batches_of_sets(batch, 1):
                if not len(found) or (owner := _short(_digest(found))) in seen:
                    continue
                seen.add(owner)
                shingles.append(order.prefix(found))
                classes.append(owner)
                size += len(shingles[-1])
            if size > TILE_SHINGLES // 2:
                yield from _combined(shingles, classes)
                seen, shingles, classes, size = set(), [], [], 0
        if shingles:
            yield from _combined(shingles, classes)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8)]
        last = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            ready = columns[2] == _SHARED
            if ready.any():
                shingle, owner = columns[0][ready], columns[1][ready]
                new = np.r_[(shingle[0], owner[0]) != last, (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])]
                last = shingle[-1], owner[-1]
                yield _rows(shingle[new], owner[new], _SHARED)
            columns = [np.concatenate([h, c[~ready]]) for h, c in zip(held, columns, strict=True)]
            if len(columns[0]):
                # The last shingle may go on in the next batch; it has a row for each task at most.
                whole = np.searchsorted(columns[0], columns[0][-1])
                if whole:
                    yield _shared_across(*(c[:whole] for c in columns))
                held = [c[whole:] for c in columns]
        if len(held[0]):
            yield _shared_across(*held)

    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.mapInArrow(prefixes, _ROW_KIND)
    # Rows known to be shared go by class, so that no shingle brings many rows to one place.
    spread = F.when(F.col("state") == _SHARED, F.col("class")).otherwise(F.col("shingle"))
    by_shingle = rows.repartition(partitions, spread).sortWithinPartitions("shingle", "class")
    return by_shingle.mapInArrow(runs, _ROW_KIND).select("shingle", "class")


def _wanted(n):
    """As `wanted`, for a column."""
    return F.greatest(F.lit(1), F.floor(F.ceil(n * SHARE / OF) * MORE / 100))


def enough_rows(documents: DataFrame, classes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """shingle, class, its n, and whether the shingle has ``many`` rows, of all classes that may be linked.

    The rounds only leave out what cannot be linked; that repeated rows keep a few
    classes too many does no harm. Sieves only spare the joins that follow them most rows:
    what stays is the same when they let everything through.
    """
    rows = written(shared_rows(documents, heavy), "shared")
    sizes = classes.groupBy(_short_of(F.col("digest")).alias("class")).agg(F.min("n").alias("n"))
    for _ in range(ROUNDS):
        counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("c"))
        enough_shared = counts.join(sizes, "class").filter(F.col("c") >= _wanted(F.col("n")))
        enough_shared = written(enough_shared.select("class", "n"), "enough")
        rows = sifted(rows.select("shingle", "class"), {"class": sieve(enough_shared)})
        rows = written(rows.join(enough_shared, "class").select("shingle", "class", "n"), "enough")
        owners = rows.groupBy("shingle").agg(
            F.min("class").alias("a"), F.max("class").alias("b"), (F.count(F.lit(1)) > FEW).alias("many")
        )
        owned = written(owners.filter("a <> b").select("shingle", "many"), "owned")
        rows = written(sifted(rows, {"shingle": sieve(owned)}).join(owned, "shingle"), "shared")
    return rows


def _chained(rows: DataFrame) -> DataFrame:
    least = rows.groupBy("shingle").agg(F.min("class").alias("least"))
    return rows.join(least, "shingle").filter("class <> least").select("class", "least").distinct()


def chains(documents: DataFrame, classes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """Pairs (class, least) that connect all classes that may be linked."""
    return _chained(enough_rows(documents, classes, heavy))


def _bucket(n):
    return F.floor(F.log(n) / math.log(OF / SHARE)).cast("int")


def parted(rows: DataFrame) -> DataFrame:
    """Pairs (class, least) that connect all that may be linked, of less that may not than `_chained`.

    Linked sets share the greater of their wanted numbers in both prefixes. As many of
    these as each of the two has shingles with many owners may be such ones; the others
    are counted. Two that share no other have enough of them each.
    """
    held = written(rows.filter("many").groupBy("class", "n").agg(F.count(F.lit(1)).alias("held")), "held")
    few = rows.filter("not many").drop("many")
    a, b = (few.select("shingle", F.col("class").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    fit = (F.col("a") < F.col("b")) & (OF * F.col("n_a") >= SHARE * F.col("n_b")) & (OF * F.col("n_b") >= SHARE * F.col("n_a"))
    pairs = a.join(b, "shingle").filter(fit).groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c"))
    wanted_of_both = F.greatest(_wanted(F.col("n_a")), _wanted(F.col("n_b")))
    for x in "ab":
        pairs = pairs.join(held.select(F.col("class").alias(x), F.col("held").alias(f"held_{x}")), x, "left")
    spare = F.least(F.coalesce("held_a", F.lit(0)), F.coalesce("held_b", F.lit(0)))
    counted = pairs.filter(F.col("c") + spare >= wanted_of_both).select(F.col("b").alias("class"), F.col("a").alias("least"))
    # Sets of neighbouring size classes meet in one of the two windows that each is in.
    rich = held.filter(F.col("held") >= _wanted(F.col("n"))).select("class")
    windows = F.explode(F.array(_bucket(F.col("n")), _bucket(F.col("n")) - 1)).alias("window")
    among = written(rows.filter("many").join(rich, "class", "left_semi").select("shingle", "class", windows), "rich")
    least = written(among.groupBy("shingle", "window").agg(F.min("class").alias("least")), "least")
    chained = among.join(least, ["shingle", "window"]).filter("class <> least").select("class", "least")
    return counted.union(chained).distinct()


class SignatureTree:
    """Bitmaps and sizes of sets, combined in pairs up to one root."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        """Sets that hold the same least hashes are neighbours, as near copies mostly do."""
        self.order = sorted(range(len(sets)), key=lambda i: sets[i][:2].tolist())
        longest = max(len(s) for s in sets)
        bits = max(256, 1 << (2 * longest - 1).bit_length())
        # A long set beside many others gets a narrower bitmap, which only prunes less.
        bits = min(bits, max(256, 1 << max(8 * SIGNATURE_BYTES // len(sets), 1).bit_length() - 1))
        signature = np.zeros((len(sets), bits // 8), np.uint8)
        for row, i in enumerate(self.order):
            at = (sets[i] >> np.uint64(20)).astype(np.int64) & bits - 1
            present = np.zeros(bits, bool)
            present[at] = True
            signature[row] = np.packbits(present)
        leaves = signature.view(np.uint64)
        size = np.array([len(sets[i]) for i in self.order])
        spare = size - np.bitwise_count(leaves).sum(axis=1)  # shingles that share a bit
        # Of each node: bitmap, least and greatest size, most spare shingles, label or -1.
        self.levels = [(leaves, size, size, spare, labels[self.order])]
        while len(self.levels[-1][0]) > 1:
            bitmap, low, high, spare, label = self.levels[-1]
            odd = len(bitmap) % 2
            if odd:
                bitmap, low, high, spare, label = (np.concatenate([x, x[-1:]]) for x in (bitmap, low, high, spare, label))
            self.levels.append(
                (
                    bitmap[::2] | bitmap[1::2],
                    np.minimum(low[::2], low[1::2]),
                    np.maximum(high[::2], high[1::2]),
                    np.maximum(spare[::2], spare[1::2]),
                    np.where(label[::2] == label[1::2], label[::2], -1),
                )
            )

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which node pairs may hold a link between different labels."""
        bitmap, low, high, spare, label = self.levels[level]
        keep = (OF * high[a] >= SHARE * low[b]) & (OF * high[b] >= SHARE * low[a])
        keep &= (label[a] < 0) | (label[a] != label[b])
        at = np.flatnonzero(keep)
        for start in range(0, len(at), 4096):  # a bounded piece of bitmaps at a time
            part = at[start : start + 4096]
            x, y = a[part], b[part]
            most = np.bitwise_count(bitmap[x] & bitmap[y]).sum(axis=1) + np.minimum(spare[x], spare[y])
            keep[part] = (SHARE + OF) * np.minimum(most, np.minimum(high[x], high[y])) >= SHARE * (low[x] + low[y])
        return np.flatnonzero(keep)

    def candidates(self) -> Iterator[tuple[int, int]]:
        """Pairs of sets that may be linked, by dual traversal from the root."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            below = len(self.levels[level - 1][0])
            x = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a + 1])
            y = np.concatenate([2 * b, 2 * b + 1, 2 * b, 2 * b + 1])
            own = (x <= y) & (y < below)  # each pair once; the last node may have one child
            x, y = x[own], y[own]
            # A leaf has no link with itself; above, a node pairs with itself.
            inner = x != y if level == 1 else np.ones(len(x), bool)
            x, y = x[inner], y[inner]
            kept = self._possible(level - 1, x, y)
            a, b = x[kept], y[kept]
        if len(self.levels) > 1:
            yield from zip(a.tolist(), b.tolist(), strict=True)


def tree_join(sets: list[np.ndarray], labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect sets exactly as all links between different labels would."""
    if len(sets) < 2:
        return []
    labels = np.arange(len(sets)) if labels is None else labels
    tree = SignatureTree(sets, labels)
    parent = {label: label for label in labels.tolist()}
    label_of = labels.tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for x, y in tree.candidates():
        i, j = tree.order[x], tree.order[y]
        a, b = root(label_of[i]), root(label_of[j])
        if a == b:
            continue
        first, second = sets[i], sets[j]
        if len(first) > len(second):
            first, second = second, first
        at = np.searchsorted(second, first)
        shared = int((second[np.minimum(at, len(second) - 1)] == first).sum())
        if enough(shared, len(first), len(second)):
            parent[a] = b
            links.append((i, j))
    return links


_LINKS = "a binary, b binary"


def _join_unit(table: pa.Table) -> pa.Table:
    """Links of one unit: rows with digest, shingles and label (its digest where it has none)."""
    digests = table.column("digest").to_pylist()
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for chunk in table.column("shingles").chunks for v in chunk]
    names: dict[bytes, int] = {}
    labels = np.array([names.setdefault(label, len(names)) for label in table.column("label").to_pylist()])
    links = tree_join(sets, labels)
    return pa.table({"a": pa.array([digests[i] for i, _ in links], pa.binary()), "b": pa.array([digests[j] for _, j in links], pa.binary())})


def _joined(units: DataFrame) -> DataFrame:
    return units.groupBy("unit").applyInArrow(_join_unit, _LINKS)


def member_sets(documents: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` with the shingles of one document of each class.

    A sieve of their ids spares most texts the work and all texts a shuffle.
    """
    bits = documents.sparkSession.sparkContext.broadcast(sieve(members.select(F.xxhash64("doc_id").alias("h"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = np.flatnonzero(probable(bits.value, batch.column(2).to_numpy()))
            for at in range(0, len(asked), 512):
                part = batch.take(pa.array(asked[at : at + 512]))
                sets = [found.tobytes() for found in _batches_of_sets(part, 1)]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                yield _table(_SET, of=part.column(0), of_digest=digests, shingles=sets)

    sets = documents.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(
        work, "of long, of_digest binary, shingles binary"
    )
    # Rows that repeat a key with another text have another digest.
    same = (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of"))
    return members.join(sets, same).drop("doc_id", "of", "of_digest")


_SET = {"of": pa.int64(), "of_digest": pa.binary(), "shingles": pa.binary()}


def links(documents: DataFrame, classes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """Pairs (a, b) of digests that connect all classes with links between them.

    ``classes``: digest, n, doc_id of one document; ``documents``: doc_id, text.
    """
    rows = enough_rows(documents, classes, heavy)
    chain = components(_chained(rows))
    grouped = classes.withColumn("node", _short_of(F.col("digest"))).join(
        chain.select("node", F.col("component").alias("group")), "node"
    )
    members = grouped.select("doc_id", "digest", "n", "node", "group", _bucket(F.col("n")).alias("bucket"))
    members = written(members, "members")
    sums = members.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    wide = written(sums.filter((F.col("sets") > TILE_SETS) | (F.col("shingles") > TILE_SHINGLES)).select("group"), "wide")
    if not wide.isEmpty():
        inside = written(members.join(wide, "group", "left_semi"), "inside")
        narrow = components(parted(rows.join(inside.select(F.col("node").alias("class")).distinct(), "class", "left_semi")))
        narrowed = inside.drop("group").join(narrow.withColumnRenamed("component", "group"), "node")
        members = written(members.join(wide, "group", "left_anti").unionByName(narrowed), "members")
    # Parts by number of sets and of shingles; a component that fits one tile is one unit.
    in_bucket = members.groupBy("group", "bucket").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("sets") / TILE_SETS), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    buckets = in_bucket.withColumn("parts", parts)
    whole = in_bucket.groupBy("group").agg(F.sum("sets").alias("all_sets"), F.sum("shingles").alias("all_shingles"))
    small = (F.col("all_sets") <= TILE_SETS) & (F.col("all_shingles") <= TILE_SHINGLES)
    layout = written(
        buckets.join(whole, "group").select("group", "bucket", "parts", small.alias("small")), "tiles"
    )
    placed = members.join(layout, ["group", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    )
    sets = written(member_sets(documents, placed.select("doc_id", "digest", "group", "bucket", "part", "small")), "sets")

    # First: small components whole; tiles of the others alone and with the first of their bucket.
    unlabelled = sets.withColumn("label", F.col("digest"))
    spread = unlabelled.join(layout.filter("not small").select("group", "bucket", "parts"), ["group", "bucket"])
    alone = F.array(F.col("part"))
    with_first = F.when(F.col("part") > 0, alone).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    first = written(
        _joined(
            unlabelled.filter("small")
            .select(F.concat_ws("/", "group").alias("unit"), "digest", "shingles", "label")
            .union(
                spread.withColumn("other", F.explode(with_first)).select(
                    F.concat_ws("/", "group", "bucket", "other").alias("unit"), "digest", "shingles", "label"
                )
            )
        ),
        "links",
    )
    large = layout.filter("not small")
    if large.isEmpty():
        return first

    # Then: what is outside the largest class of each large component, with all its tiles.
    labelled = written(
        sets.filter("not small")
        .drop("shingles")
        .join(components(first).withColumnRenamed("node", "digest"), "digest", "left")
        .withColumn("label", F.coalesce("component", "digest"))
        .drop("component"),
        "labels",
    )
    by_label = labelled.groupBy("group", "label").agg(F.count(F.lit(1)).alias("c"))
    main = by_label.groupBy("group").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    rest = labelled.join(main, "group").filter(F.col("label") != F.col("main"))
    rest = rest.select("group", "bucket", "part").distinct()
    other = large.select(F.col("group").alias("g"), F.col("bucket").alias("other_bucket"), F.col("parts").alias("other_parts"))
    pairs = written(
        rest.join(other, (F.col("group") == F.col("g")) & (F.abs(F.col("bucket") - F.col("other_bucket")) <= 1))
        .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
        .select("group", "bucket", "part", "other_bucket", "other_part"),
        "pairs",
    )
    unit = F.concat_ws("/", "group", "bucket", "part", "other_bucket", "other_part").alias("unit")
    with_label = sets.filter("not small").join(
        labelled.join(main, "group").select("digest", "label", (F.col("label") != F.col("main")).alias("outside")), "digest"
    )
    left = with_label.filter("outside").join(pairs, ["group", "bucket", "part"]).select(unit, "digest", "shingles", "label")
    right_pairs = pairs.select(
        unit, F.col("group"), F.col("other_bucket").alias("bucket"), F.col("other_part").alias("part"),
        ((F.col("bucket") == F.col("other_bucket")) & (F.col("part") == F.col("other_part"))).alias("own"),
    )
    right = (
        with_label.join(right_pairs, ["group", "bucket", "part"])
        .filter("not (own and outside)")  # already on the left
        .select("unit", "digest", "shingles", "label")
    )
    return first.union(_joined(left.union(right)))


def _short_of(digest):
    """The class number that `_short` gives: the first eight bytes as a signed number."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def join(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the least id reachable by links) of each document."""
    docs = keyed(documents, key, text)
    scanned = written(scan(docs), "scan")
    rows = scanned.filter("shingle is null").select("doc_id", "n", "digest")
    often = (
        scanned.filter("shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle")
        .limit(HEAVY)
        .toArrow()
    )
    heavy = often.column("shingle").to_numpy().astype(np.int64).view(np.uint64)[::-1].copy()
    classes = rows.filter("digest is not null").groupBy("digest", "n").agg(F.min("doc_id").alias("doc_id"))
    connected = components(links(docs, classes, heavy))
    labelled = rows.join(connected, F.col("digest") == F.col("node"), "left").select(
        "doc_id", "n", F.coalesce("component", "digest").alias("label")
    )
    labelled = written(labelled, "labelled")
    # Written, so that the join has plain shuffles on both sides, which Spark can split.
    least = written(labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")), "least")
    return labelled.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )
