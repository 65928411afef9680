"""Keep-first deduplication: exact, near and semantic. Order is an explicit column; of rows with equal order any may come first."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.functions.vectors import SLOTS, band_sketch, dot, shingle_sets
from loomline.operators.rules import FilterConfig, passes_scale_filter
from loomline.storage import drop, written


def keep_first(rows: DataFrame, key: Column, order: str, condition: Column | None = None) -> DataFrame:
    """rows with parent: the order value of the first row of the same key; null for the first itself.

    Rows that fail the condition neither keep nor lose their place. Firsts are combined in each task before they
    shuffle and join back as a table of their own, so a hot key is a plain skewed join, which adaptive execution splits.
    """
    ok = F.lit(True) if condition is None else condition
    keyed = rows.withColumn("_key", F.when(ok, key))
    firsts = written(keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1"), "firsts").drop("_n")
    met = keyed.join(firsts.withColumnRenamed("_key", "_key2"), F.col("_key") == F.col("_key2"), "left")
    return met.withColumn("parent", F.when(F.col("_first") != F.col(order), F.col("_first"))).drop("_key", "_key2", "_first")


def exact(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """docs with parent: the first document of the same text, null for those that stay."""
    return keep_first(docs, X.content_hash(F.col(text)), order)


#: Memberships (node in bucket) that one task settles by itself.
ONE_TASK = 60_000


def shared_buckets(held: DataFrame) -> DataFrame:
    """bucket, node of the buckets of two and more nodes. Those of the same members are one: those of a group of copies in all bands, mostly.

    Equal sizes and two sums of hashes tell the same members but for a chance of 2 ** -128, and buckets that such a chance
    merges lose no pair. The joins are by shuffle, as Spark sizes exploded keys too low.
    """
    members = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    shared = held.groupBy("bucket").agg(*members).filter("n > 1").select(F.col("bucket").alias("_b"), F.struct("n", "x", "y").alias("_members"))
    return held.join(shared.hint("merge"), F.col("bucket") == F.col("_b")).select(F.col("_members").alias("bucket"), "node").distinct()


def resolve(buckets: DataFrame, payload: DataFrame | Callable[[DataFrame], DataFrame], similarity: Callable, local: Callable, threshold: float, slots: DataFrame | None = None, least: int = 0) -> DataFrame:
    """Sequential keep-first without all pairs: node, parent (null: kept) of every node of buckets (bucket, node).

    A node is dropped if an earlier kept one of its buckets is similar. In rounds, each bucket's earliest undecided node
    leads it. Who leads all its buckets is kept, as nothing before it can drop it; the others of those buckets are
    verified against it, and the similar ones are dropped. Comparisons are with leaders only, so a group of copies costs
    one each. When few memberships are left, one task settles them in order.

    payload has node and a column `value`, or makes that of the nodes that share a bucket; similarity compares two
    values as Columns, local as NumPy arrays. slots, for values that are sets of hashes: node, slots (bytes, as many
    for each); the one task compares values only of nodes that have `least` of them in common.
    """
    held = written(buckets.select("bucket", "node").distinct(), "memberships")
    left = written(shared_buckets(held), "buckets")
    if callable(payload):
        payload = payload(left.select("node").distinct())
    alone = held.select("node").distinct().join(left.select("node").distinct(), "node", "left_anti")
    done = [alone.select("node", F.lit(None).cast(held.schema["node"].dataType).alias("parent"))]
    every = left
    while (n := left.count()) > ONE_TASK:
        heads = written(left.groupBy("bucket").agg(F.min("node").alias("leader")), "leaders")
        led = left.join(heads, "bucket").select("node", "leader")
        free = written(led.groupBy("node").agg(F.min("leader").alias("leader")).filter("leader = node").select("leader"), "free")
        kept = free.select(F.col("leader").alias("node"), F.lit(None).cast(left.schema["node"].dataType).alias("parent"))
        pairs = led.filter("node <> leader").distinct().join(free, "leader")
        a, b = payload.select("node", F.col("value").alias("a")), payload.select(F.col("node").alias("leader"), F.col("value").alias("b"))
        alike = pairs.join(a, "node").join(b, "leader").filter(similarity(F.col("a"), F.col("b")) >= threshold)
        dropped = written(alike.groupBy("node").agg(F.min("leader").alias("parent")), "dropped")
        done += [kept, dropped.select("node", "parent")]
        now = written(left.join(kept.select("node").unionByName(dropped.select("node")), "node", "left_anti"), "buckets")
        drop(*([heads] if left is every else [heads, left]))
        left = now
    if n:
        done.append(_in_order(left, payload, local, threshold, slots, least))
    told = written(reduce(DataFrame.unionByName, done), "resolved")
    return told if left is every else first_parents(told, every, payload, similarity, threshold)


def first_parents(told: DataFrame, buckets: DataFrame, payload: DataFrame, similarity: Callable, threshold: float) -> DataFrame:
    """What resolve() found, each parent replaced by the earliest similar kept node over all the dropped node's buckets.

    In rounds a node meets leaders that are free by then, perhaps a later one first. Only kept nodes before the parent at
    hand are compared.
    """
    dropped = told.filter(F.col("parent").isNotNull())
    kept = buckets.join(told.filter(F.col("parent").isNull()).select("node"), "node", "left_semi").select("bucket", F.col("node").alias("k"))
    pairs = buckets.join(dropped, "node").join(kept, "bucket").filter("k < parent").select("node", "k").distinct()
    a, b = payload.select("node", F.col("value").alias("a")), payload.select(F.col("node").alias("k"), F.col("value").alias("b"))
    alike = pairs.join(a, "node").join(b, "k").filter(similarity(F.col("a"), F.col("b")) >= threshold)
    earlier = written(alike.groupBy("node").agg(F.min("k").alias("k")), "earlier")
    return told.join(earlier, "node", "left").select("node", F.coalesce("k", "parent").alias("parent"))


#: Bins to which the one task deals the members of a set, before it compares sets.
BINS = 1024


def bins(value: np.ndarray) -> np.ndarray:
    return np.bincount(value & (BINS - 1), minlength=BINS).astype(np.int32)


def _in_order(left: DataFrame, payload: DataFrame, local: Callable, threshold: float, slots: DataFrame | None = None, least: int = 0) -> DataFrame:
    """The rest of resolve() in one task."""
    # Written, so that the one task reads the rest alone and not all of the payload.
    met = left.groupBy("node").agg(F.collect_list("bucket").alias("buckets")).join(payload.select("node", "value"), "node")
    met = met.withColumn("slots", F.lit(b"")) if slots is None else met.join(slots.select("node", "slots"), "node")
    nodes = written(met.select("node", "buckets", "value", "slots"), "rest")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_in: dict[tuple, list[int]] = {}
        kept: list[int] = []
        values: list[np.ndarray] = []
        bytes_of, bins_of, sizes = np.empty((0, 0), np.uint8), np.empty((0, BINS), np.int32), np.empty(0, np.int64)
        told: tuple[list, list] = [], []
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_pylist(), strict=True)
            for node, held, value, own in rows:
                held = [tuple(b.values()) for b in held]
                own = np.frombuffer(own, np.uint8)
                earlier = np.array(sorted({k for b in held for k in kept_in.get(b, ())}), np.int64)  # places among the kept, in order
                if least:
                    mine = bins(value)
                    if len(earlier):
                        earlier = earlier[(bytes_of[earlier] == own).sum(1) >= least]
                        # Sets differ in as many members as the numbers in their bins do, at least.
                        apart = np.abs(bins_of[earlier] - mine).sum(1)
                        earlier = earlier[apart * (1 + threshold) <= (1 - threshold) * (sizes[earlier] + len(value)) + 1e-6]
                parent = next((kept[k] for k in earlier.tolist() if local(value, values[k]) >= threshold), None)
                if parent is None:
                    for b in held:
                        kept_in.setdefault(b, []).append(len(kept))
                    if least and len(kept) == len(bytes_of):
                        more = max(1024, len(kept))
                        bytes_of = np.concatenate((bytes_of.reshape(-1, len(own)), np.empty((more, len(own)), np.uint8)))
                        bins_of = np.concatenate((bins_of, np.empty((more, BINS), np.int32)))
                        sizes = np.concatenate((sizes, np.empty(more, np.int64)))
                    if least:
                        bytes_of[len(kept)], bins_of[len(kept)], sizes[len(kept)] = own, mine, len(value)
                    kept.append(node)
                    values.append(value)
                told[0].append(node)
                told[1].append(parent)
        yield pa.RecordBatch.from_arrays([pa.array(told[0], pa.int64()), pa.array(told[1], pa.int64())], ["node", "parent"])

    return nodes.coalesce(1).sortWithinPartitions("node").mapInArrow(settle, "node long, parent long")


def set_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


#: The probability with which bands propose a pair at the threshold, at least.
RECALL = 0.995


def banding(threshold: float, num_perm: int, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the longest rows with which num_perm permutations propose a pair at the threshold with that probability.

    Single rows where none do: a pair is then proposed with probability 1 - (1 - threshold) ** num_perm.
    """
    for rows in range(num_perm, 1, -1):
        if 1 - (1 - threshold**rows) ** (num_perm // rows) >= recall:
            return num_perm // rows, rows
    return num_perm, 1


#: The chance, at most, that signatures part a pair at the threshold that bands propose.
PARTED = 1e-9
#: Texts of a bucket that a task compares with each other, or with as many others.
BLOCK = 2_000


def least_slots(threshold: float, slots: int, parted: float = PARTED) -> int:
    """The number of equal slots that a pair at the threshold has but for that chance."""
    less = 0.0
    for k in range(slots + 1):
        less += comb(slots, k) * threshold**k * (1 - threshold) ** (slots - k)
        if less > parted:
            return k
    return slots


def linked(size: np.ndarray, slots: np.ndarray, side: np.ndarray, threshold: float, least: int) -> np.ndarray:
    """For each text the number of its group: what hangs together by pairs whose sizes allow the threshold and that have `least` equal slots.

    A side of 0 or 1 meets the other one only, -1 meets all. What is in a group is not compared with the rest of it, so
    a group of copies costs one row of comparisons.
    """
    order = np.argsort(size, kind="stable")
    size, side = size[order], side[order]
    pad = -slots.shape[1] % 8
    slots = np.pad(slots[order], ((0, 0), (0, pad)))
    sum_of_bytes = np.uint64(0x0101010101010101)
    group, number = np.full(len(size), -1), 0
    left, z, s = np.arange(len(size)), size, slots
    while len(left):
        queue = [int(left[0])]
        group[left[0]] = number
        left, z, s = left[1:], z[1:], s[1:]
        while queue:
            x = queue.pop()
            low, high = np.searchsorted(z, size[x] * threshold * (1 - 1e-9)), np.searchsorted(z, size[x] / threshold * (1 + 1e-9), "right")
            if low == high:
                continue
            equal = ((s[low:high] == slots[x]).view(np.uint64).sum(1) * sum_of_bytes) >> np.uint64(56)
            hit = equal >= least + pad
            if side[x] >= 0:
                hit &= side[left[low:high]] != side[x]
            if hit.any():
                met = left[low:high][hit]
                group[met] = number
                queue += met.tolist()
                stays = np.ones(len(left), bool)
                stays[low:high] = ~hit
                left, z, s = left[stays], z[stays], s[stays]
        number += 1
    out = np.empty(len(group), np.int64)
    out[order] = group
    return out


def linked_groups(nodes: DataFrame, threshold: float, num_perm: int) -> DataFrame:
    """bucket, node: what may be similar in the buckets of nodes (node, size, slots, keys), by sizes and signatures.

    Unlike texts share bands by chance, the more the more texts there are; so buckets are parted before any set of
    shingles is made. Buckets of over BLOCK texts are dealt to blocks, of which each two meet in a task.
    """
    slots = min(num_perm, SLOTS)
    least = least_slots(threshold, slots)
    shared = written(shared_buckets(written(nodes.select(F.explode("keys").alias("bucket"), "node").distinct(), "memberships")), "band-buckets")
    blocks = F.ceil(F.col("bucket.n") / BLOCK)
    met = nodes.select(F.col("node").alias("_node"), "size", "slots").join(shared.hint("merge"), F.col("_node") == F.col("node"))
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    at = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    dealt = met.select(at.alias("at"), "node", "size", side.cast("int").alias("side"), "slots").repartition("at").sortWithinPartitions("at")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table: pa.Table) -> pa.RecordBatch:
            at, node, size, side = (table.column(k).to_numpy() for k in range(4))
            values = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(-1, slots)
            ends = np.flatnonzero(np.concatenate((at[1:] != at[:-1], [True]))) + 1
            keys, nodes, begin = [], [], 0
            for end in ends.tolist():
                group = linked(size[begin:end], values[begin:end], side[begin:end], threshold, least)
                counts = np.bincount(group)
                for g in np.flatnonzero(counts > 1).tolist():
                    own = np.sort(node[begin:end][group == g])
                    keys.append(np.full(len(own), int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True), np.int64))
                    nodes.append(own)
                begin = end
            none = [np.empty(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys or none)), pa.array(np.concatenate(nodes or none))], ["bucket", "node"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            last = batch.column(0)[-1].as_py() if len(batch) else None
            if last is not None and (held or [batch])[0].column(0)[0].as_py() != last:  # the last bucket may go on
                cut = int(np.searchsorted(batch.column(0).to_numpy(), last))
                yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)
            if len(batch):
                held.append(batch)
        if held:
            yield solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(part, "bucket long, node long")


def near(docs: DataFrame, text: str = "text", order: str = "doc_id", threshold: float = 0.8, num_perm: int = 128, bands: int | None = None, rows: int | None = None, shingle: int = 4) -> DataFrame:
    """order, parent (the first kept near-duplicate), similarity; null for documents that stay.

    MinHash bands propose, sizes and whole signatures part unlike texts of a bucket (linked_groups), the exact Jaccard
    similarity of character shingles decides. Without bands and rows given they
    follow from threshold and num_perm (banding); those of the defaults, 21 of 6, propose a pair at 0.8 with a probability of 0.998.
    Texts without characters are never near-duplicates.
    """
    if bands is None or rows is None:
        bands, rows = banding(threshold, num_perm)
    sketches = written(docs.select(F.col(order).alias("node"), band_sketch(num_perm, bands, rows, shingle)(F.col(text)).alias("s")).select("node", "s.same", "s.size", "s.slots", "s.keys"), "sketches")
    # Equal shingle sets meet first by one key, so exact copies never share the bands' buckets.
    same = written(keep_first(sketches.filter(F.col("same").isNotNull()), F.col("same"), "node").select("node", "size", "slots", "keys", F.col("parent").alias("twin")), "twins")
    single = same.filter(F.col("twin").isNull())
    sets: list[DataFrame] = []

    def payload(nodes: DataFrame) -> DataFrame:
        """The shingles of texts that share a bucket, made a second time: those of all texts are larger than the texts."""
        some = docs.select(F.col(order).alias("node"), F.col(text).alias("text")).join(nodes, "node")
        sets.append(written(some.select("node", shingle_sets(shingle)(F.col("text")).alias("value")), "shingles"))
        return sets[0]

    told = resolve(linked_groups(single, threshold, num_perm), payload, X.jaccard, set_jaccard, threshold, single.select("node", "slots"), least_slots(threshold, min(num_perm, SLOTS))).filter(F.col("parent").isNotNull())
    a, b = sets[0].select("node", F.col("value").alias("a")), sets[0].select(F.col("node").alias("parent"), F.col("value").alias("b"))
    pairs = written(told.join(a, "node").join(b, "parent").select("node", "parent", F.round(X.jaccard(F.col("a"), F.col("b")), 4).alias("similarity")), "near-found")
    # A copy of a dropped text is dropped for the same document, a copy of a kept one for that.
    ups = pairs.select(F.col("node").alias("twin"), F.col("parent").alias("up"), F.col("similarity").alias("as_up"))
    twins = same.filter(F.col("twin").isNotNull()).select("node", "twin").join(ups, "twin", "left").select("node", F.coalesce("up", "twin").alias("parent"), F.coalesce("as_up", F.lit(1.0)).alias("similarity"))
    found = written(pairs.unionByName(twins).withColumnRenamed("node", "_node"), "near-parents")
    return docs.select(F.col(order).alias(order)).join(found, F.col(order) == F.col("_node"), "left").select(order, "parent", "similarity")


def similar_pairs(vectors: DataFrame, threshold: float, order: str = "vec_id", vector: str = "embedding", blocks: int = 0) -> DataFrame:
    """a < b, similarity (rounded to 4 places) of all pairs of unit vectors from the threshold on, exactly.

    For tables of moderate size: vectors are dealt to blocks, and each pair of blocks is one matrix product in a task. A
    vector shuffles once for each block, so there are few: up to 16 (136 products), more only for over 20,000 vectors a block.
    Single-precision vectors shuffle as they are; products are of doubles.
    """
    count = vectors.count()
    blocks = blocks or max(1, min(16, -(-count // 2000)), -(-count // 20_000))
    kind = "array<float>" if vectors.schema[vector].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector].dataType.containsNull) else "array<double>"
    own = vectors.select(F.col(order).alias("id"), F.col(vector).cast(kind).alias("v"), F.pmod(F.xxhash64(order), F.lit(blocks)).cast("int").alias("own"))
    meet = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: F.least(F.col("own"), k) * blocks + F.greatest(F.col("own"), k))
    dealt = own.select(F.explode(meet).alias("meeting"), "id", "v", "own")

    def product(table: pa.Table) -> pa.Table:
        ids, side = table.column("id").to_numpy(), table.column("own").to_numpy()
        v = np.vstack(table.column("v").to_numpy()).astype(np.float64) if len(ids) else np.zeros((0, 1))
        meeting = int(table.column("meeting")[0].as_py())
        left, right = np.flatnonzero(side == meeting // blocks), np.flatnonzero(side == meeting % blocks)
        out = []
        for i in range(0, len(left), 512):
            s = np.round(v[left[i : i + 512]] @ v[right].T, 6)
            x, y = np.nonzero(s >= threshold)
            a, b = ids[left[i + x]], ids[right[y]]
            keep = (a < b) if meeting // blocks == meeting % blocks else a != b
            out.append((np.minimum(a, b)[keep], np.maximum(a, b)[keep], s[x, y][keep]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0) for k in range(3)]
        return pa.table({"a": pa.array(columns[0].astype(np.int64)), "b": pa.array(columns[1].astype(np.int64)), "similarity": pa.array(np.round(columns[2], 4))})

    return dealt.groupBy("meeting").applyInArrow(product, "a long, b long, similarity double")


def greedy(pairs: DataFrame) -> DataFrame:
    """Sequential keep-first over known pairs a < b, similarity: the dropped b, its parent (the most similar kept a; ties: the first) and similarity."""
    edges = written(pairs, "greedy-edges")
    state: DataFrame | None = None
    while True:
        if state is None:
            state = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct().withColumn("kept", F.lit(None).cast("boolean"))
        known = edges.join(state.select(F.col("node").alias("a"), "kept"), "a").groupBy("b").agg(F.max("kept").alias("any_kept"), F.count_if(F.col("kept").isNull()).alias("open"))
        moved = state.join(known.withColumnRenamed("b", "node"), "node", "left").select(
            "node",
            F.coalesce("kept", F.when(F.col("any_kept"), F.lit(False)).when(F.coalesce("open", F.lit(0)) == 0, F.lit(True))).alias("kept"),
        )
        state = written(moved, "greedy-state")
        if state.filter("kept is null").isEmpty():
            break
    kept = state.filter("kept").select(F.col("node").alias("a"))
    best = F.max_by(F.struct("a", "similarity"), F.struct("similarity", -F.col("a")))
    return edges.join(kept, "a").join(state.filter("not kept").select(F.col("node").alias("b")), "b").groupBy("b").agg(best.alias("x")).select(F.col("b").alias("node"), F.col("x.a").alias("parent"), F.col("x.similarity").alias("similarity"))


def semantic(vectors: DataFrame, threshold: float = 0.92, order: str = "vec_id", vector: str = "embedding", exact_up_to: int | None = None, tables: int = 48, bits: int = 12, seed: int = 5) -> DataFrame:
    """order, parent, similarity of unit vectors; null for those that stay.

    All pairs are compared in blocks at every size, and the parent is the most similar kept vector. Copies of a unit
    vector meet first by one key and share its pairs. Only a caller that gives exact_up_to lets larger tables go by sign
    random projections, which lose pairs (a pair at 0.92 is proposed with a probability over 0.999, one at 0.4 with about
    0.17) and report the first kept vector found.
    """
    if exact_up_to is None or vectors.count() <= exact_up_to:
        found = _semantic_exact(vectors, threshold, order, vector)
    else:
        found = _semantic_by_projections(vectors, threshold, order, vector, tables, bits, seed)
    found = found.select(F.col("node").alias("_node"), "parent", "similarity")
    return vectors.select(order).join(found, F.col(order) == F.col("_node"), "left").select(order, "parent", "similarity")


def _semantic_exact(vectors: DataFrame, threshold: float, order: str, vector: str) -> DataFrame:
    own = vectors.select(F.col(order).alias("node"), F.col(vector).alias("v")).withColumn("self", F.round(dot(F.col("v"), F.col("v")), 6))
    unit = (F.abs(F.col("self") - 1) < 1e-3) & (F.col("self") >= threshold)
    met = written(keep_first(own, F.sha2(F.col("v").cast("string"), 256), "node", unit), "vector-twins")
    pairs = written(similar_pairs(met.filter(F.col("parent").isNull()).select("node", "v"), threshold, "node", "v"), "vector-pairs")
    found = written(greedy(pairs), "vector-found")
    twins = met.filter(F.col("parent").isNotNull()).select("node", F.col("parent").alias("first"), F.round("self", 4).alias("self"))
    gone = found.select(F.col("node").alias("gone"))
    # A copy of a kept vector goes for that; one of a dropped vector for the most similar kept vector before the copy.
    of_kept = twins.join(gone, F.col("first") == F.col("gone"), "left_anti").select("node", F.col("first").alias("parent"), F.col("self").alias("similarity"))
    sides = pairs.select(F.col("a").alias("k"), F.col("b").alias("f"), "similarity").unionByName(pairs.select(F.col("b").alias("k"), F.col("a").alias("f"), "similarity"))
    sides = sides.join(twins.select(F.col("first").alias("f")).distinct().join(gone, F.col("f") == F.col("gone"), "left_semi"), "f", "left_semi").join(gone, F.col("k") == F.col("gone"), "left_anti")
    best = F.max_by(F.struct("k", "similarity"), F.struct("similarity", -F.col("k")))
    of_gone = twins.join(sides, (F.col("first") == F.col("f")) & (F.col("k") < F.col("node"))).groupBy("node").agg(best.alias("x")).select("node", F.col("x.k").alias("parent"), F.col("x.similarity").alias("similarity"))
    return found.unionByName(of_kept).unionByName(of_gone)


def _semantic_by_projections(vectors: DataFrame, threshold: float, order: str, vector: str, tables: int, bits: int, seed: int) -> DataFrame:
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes = None
        for batch in batches:
            v = np.vstack(batch.to_numpy(zero_copy_only=False)) if len(batch) else np.zeros((0, 1))
            planes = np.random.default_rng(seed).normal(size=(v.shape[1], tables * bits)) if planes is None else planes
            sign = (v @ planes > 0).reshape(len(v), tables, bits)
            yield pa.array(((sign * (1 << np.arange(bits))).sum(2) + (np.arange(tables) << bits)).tolist(), pa.list_(pa.int64()))

    rows = written(vectors.select(F.col(order).alias("node"), F.col(vector).cast("array<double>").alias("v")).withColumn("keys", keys("v")), "projections")

    told = resolve(rows.select(F.explode("keys").alias("bucket"), "node"), rows.select("node", F.col("v").alias("value")), dot, lambda a, b: float(np.dot(a, b)), threshold)
    found = told.filter(F.col("parent").isNotNull())
    a, b = rows.select("node", F.col("v").alias("a")), rows.select(F.col("node").alias("parent"), F.col("v").alias("b"))
    return found.join(a, "node").join(b, "parent").select("node", "parent", F.round(dot(F.col("a"), F.col("b")), 4).alias("similarity"))


def filter_and_dedup(rows: DataFrame, text: str = "text", order: str | None = None, config: FilterConfig = FilterConfig()) -> DataFrame:
    """The bulk job: normalised text, filter, content_hash, first row of each text (lowest order).

    What passes is normalised, filtered and hashed once and written; firsts and their join read hashes and orders of
    that. Without an order any one row of a text stays, which needs no join: firsts are aggregated with their columns.
    """
    tidy = rows.withColumn(text, X.normalize(F.col(text))).filter(passes_scale_filter(F.col(text), config)).withColumn("content_hash", X.content_hash(F.col(text)))
    if order is None:
        return tidy.dropDuplicates(["content_hash"])
    return keep_first(written(tidy, "tidy"), F.col("content_hash"), order).filter(F.col("parent").isNull()).drop("parent")
