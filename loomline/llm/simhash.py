"""SimHash near-dedup: 64-bit fingerprints, linked within a Hamming radius by shards and vantage-point trees in them, and their components.

**Fingerprints.** Lower-cased (A-Z) ASCII-space words in shingles of ``width``, repeats included; a bit is 1 if set in
over half the XXH64 hashes (seed 42). Fewer words make one shingle; none (null, empty or blank text) make fingerprint 0,
which is linked like any other.

**Search.** Equal fingerprints are one node. Vantage-point trees over whole fingerprints don't prune here, so they aren't the
main way; the README says so as an exit from the method, with figures. Distances crowd near 32: on the 47,236 distinct
fingerprints of a test table a median split with the best of five vantage points leaves 1.37 points to search for each,
and leaves of 256 hold 108 copies of each fingerprint and 0.47 of all pairs. So shards are made by blocks of bits instead. Two
fingerprints within radius r agree on at least ``c`` of ``r + c`` blocks, and every choice of c blocks is one set of shards; c
grows with the number of nodes so that a shard holds about ``LEAF`` of them, and every c finds exactly the same pairs. (A
distance over agreeing blocks is a vantage-point distance of radius 0, whose shards don't overlap.) Inside a shard of over
four times LEAF, a vantage-point tree deals points by whole distance; points near the boundary are searched on both sides.
In a leaf, pairs that the triangle bound lets through are compared exactly; a leaf that no vantage point parts is compared
in blocks by one task, ``HOT`` nodes at most but for groups that ``SPLITS`` splits don't part. A shard of more nodes (a large
group of near copies) is first split over tasks by shells around a vantage point, each shell together with a copy of the
next, which the bound shows to be enough.

**Components.** A shard gives each linked point one edge to its local root (never all pairs); the shards' edges are
merged by rounds of star contraction, each written to the shared folder.

Repeated rows and ids are fine (a document is a row); null ids are ignored in the minimum. An empty table gives an
empty result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import chunks, clear_name, drop, in_arrow, written
from loomline.llm.exact_dedup import may_be_in

WIDTH = 4
RADIUS = 4
SEED = 42
#: Nodes a shard should hold on average, and those from which a shard is split over tasks.
LEAF = 64
HOT = 30_000
#: Distributed splits of a hot shard at most; what is left is still searched, in one task.
SPLITS = 6


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Signed 64-bit value of the text's fingerprint."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return int(np.array([digest(flat, SEED)], np.uint64).view(np.int64)[0])
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width])).tolist()
    view = memoryview(flat)
    return majority(np.array([digest(view[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit value."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def text_key(text: Column) -> Column:
    """What parts rows of one id by their texts; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, keyed: bool = False) -> DataFrame:
    """doc_id, fp (signed 64 bits) of every row; keyed: and key, the text's."""
    own = [F.col(id_col).alias("doc_id"), *([text_key(F.col(text_col)).alias("key")] if keyed else [])]
    rows = docs.select(*own, F.col(text_col).alias("text"))
    out = T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([fingerprint(t, width) for t in texts], pa.int64())], out.names)

    return rows.transform(in_arrow, work, out)


def block_masks(radius: int, agree: int) -> list[int]:
    """For each choice of `agree` of radius + agree blocks of the 64 bits: the bits of the chosen blocks."""
    n = radius + agree
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(n)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def tree_tops(nodes: int, radius: int) -> list[int]:
    """Masks of the block distances, enough for shards of about LEAF nodes."""
    for agree in range(1, 6):
        if nodes / 2 ** (64 * agree // (radius + agree)) <= LEAF:
            break
    return block_masks(radius, agree)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def merge(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots of all positions (up, fully compressed) after joining a to b; the smaller position is the root."""
    while True:
        ra, rb = up[a], up[b]
        apart = ra != rb
        if not apart.any():
            return up
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while (flat := up[up]).tobytes() != up.tobytes():
            up = flat


def leaves(points: np.ndarray, at: np.ndarray, radius: int, leaf: int = 4 * LEAF) -> Iterator[np.ndarray]:
    """Vantage-point tree over points[at]: positions of each leaf, boundaries within the radius in both sides' leaves."""
    todo = [(at, 0)]
    while todo:
        at, tried = todo.pop()
        if len(at) <= leaf or tried > 4:
            yield at
            continue
        far = np.bitwise_count(points[at] ^ points[at[(tried * 7919) % len(at)]])
        middle = int(np.median(far))
        inside, outside = at[far <= middle], at[far > middle - radius]
        if max(len(inside), len(outside)) > 0.9 * len(at):  # this vantage point prunes nothing; try others, then compare
            todo.append((at, tried + 1))
        else:
            todo += [(inside, 0), (outside, 0)]


def near(points: np.ndarray, groups: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions of the same group (groups is sorted) within the radius, in blocks."""
    if len(points) < 2:
        return
    begins = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.append(begins, len(groups)))
    lists = [np.arange(len(points))[np.repeat(sizes <= 4 * LEAF, sizes)]]
    which = [groups[lists[0]]] if len(lists[0]) else [np.empty(0, groups.dtype)]
    tags = [np.zeros(len(lists[0]), np.int64)]
    for b, n in zip(begins[sizes > 4 * LEAF].tolist(), sizes[sizes > 4 * LEAF].tolist(), strict=True):
        for k, x in enumerate(leaves(points, np.arange(b, b + n), radius)):
            lists.append(x)
            which.append(groups[x])
            tags.append(np.full(len(x), k + 1))
    at, key, tag = np.concatenate(lists), np.concatenate(which), np.concatenate(tags)
    # In each leaf, by distance to its first point: only pairs whose distances differ by the radius at most can be near.
    order = np.lexsort((tag, key))
    at, key, tag = at[order], key[order], tag[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])))
    leaf_no = np.cumsum(new) - 1
    far = np.bitwise_count(points[at] ^ points[at[np.flatnonzero(new)]][leaf_no]).astype(np.int16)
    order = np.lexsort((far, leaf_no))
    at, leaf_no, far = at[order], leaf_no[order], far[order]
    rows = np.arange(len(at))
    k = 1
    while len(rows):
        rows = rows[rows + k < len(at)]
        rows = rows[(leaf_no[rows] == leaf_no[rows + k]) & (far[rows + k] - far[rows] <= radius)]
        a, b = at[rows], at[rows + k]
        found = np.bitwise_count(points[a] ^ points[b]) <= radius
        if found.any():
            yield a[found], b[found]
        k += 1


def _local_edges(radius: int):
    """For partitions sorted by shard: an edge from each linked point to its root in the shard."""

    def solve(shards: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        up = np.arange(len(fps))
        for a, b in near(fps.view(np.uint64), shards, radius):
            up = merge(up, a, b)
        at = np.flatnonzero(up != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[at]), pa.array(fps[up[at]])], ["a", "b"]) if len(at) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_s, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            held_s = np.concatenate((held_s, batch.column(0).to_numpy(zero_copy_only=False)))
            held_f = np.concatenate((held_f, batch.column(1).to_numpy(zero_copy_only=False)))
            if len(held_s) and held_s[0] != held_s[-1] and len(held_s) >= 20_000:  # whole shards; the last may go on
                cut = int(np.flatnonzero(held_s != held_s[-1])[-1]) + 1
                if out := solve(held_s[:cut], held_f[:cut]):
                    yield out
                held_s, held_f = held_s[cut:], held_f[cut:]
        if len(held_s) and (out := solve(held_s, held_f)):
            yield out

    return work


def links(nodes: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """Edges a, b (a point and its local root) that connect all distinct fingerprints fp of nodes within the radius."""
    tops = tree_tops(count, radius)
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(tops)])
    shards = nodes.select(F.explode(keys).alias("shard"), "fp")
    for k in range(SPLITS):
        # Shards over HOT are at most len(tops) * count / HOT rows.
        hot = shards.groupBy("shard").agg(F.count("*").alias("n"), (F.min if k % 2 else F.max)("fp").alias("vantage")).filter(F.col("n") > HOT).drop("n")
        if count <= HOT or hot.isEmpty():
            break
        shell = F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))) / (radius + 1))
        split = shards.join(hot, "shard").select(F.explode(F.array(F.xxhash64("shard", F.lit(k), shell), F.xxhash64("shard", F.lit(k), shell + 1))).alias("shard"), "fp")
        shards = written(shards.join(hot, "shard", "left_anti").unionByName(split), "simhash-shards")
    dealt = shards.repartition("shard").sortWithinPartitions("shard")
    return dealt.transform(in_arrow, _local_edges(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node that has an edge; root is the smallest node of its component (signed order).

    Rounds of large-star and small-star contraction; a hub's neighbours are combined before the shuffle, and the join
    that gives them their minimum is one that adaptive execution splits.
    """
    edges = written(edges.filter("a <> b").distinct(), "star-edges")
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "star-large")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        now_edges = written(small.distinct(), "star-small")
        drop(edges, large)
        edges = now_edges
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _roots(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, least id of every distinct fingerprint; node, root of those that are linked to others)."""
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    return nodes, written(components(links(nodes.select("fp"), nodes.count(), radius)), "simhash-roots")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    fps = written(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    nodes, roots = _roots(fps, radius)
    # Linked nodes only: the smallest id of each component. Others keep their own.
    linked = nodes.join(roots, nodes.fp == roots.node).select("fp", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    told = linked.join(least, "root").select(F.col("fp").alias("fp2"), "component")
    # Written, so that both sides of the join are plain exchanges, which adaptive execution can split at a hot fingerprint.
    known = written(nodes.join(told, nodes.fp == told.fp2, "left").select(F.col("fp").alias("fp3"), F.coalesce("component", "least").alias("component_id")), "simhash-known")
    return fps.join(known, fps.fp == known.fp3).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, grouped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group the row of docs with the smallest id (null last), then text key; of equal rows one.

    grouped has doc_id, key (of the text) and group for every row of docs that isn't alone in its group. Rows go by id and
    text together, so a row is judged by its own group even where its id repeats in another.
    """
    pairs = written(grouped.groupBy("doc_id", "key", "group").agg(F.count("*").alias("n")), "group-rows")
    firsts = written(pairs.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")).select(F.col("group").alias("group2"), "first"), "group-firsts")
    met = pairs.join(firsts, F.col("group") == F.col("group2")).withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
    key, gone, may = (clear_name(docs, x) for x in ("key", "gone", "may"))
    of_row = lambda i, t: F.xxhash64(i, t)
    met = met.filter("n > 1 or not stays").select(of_row(F.col("doc_id"), F.col("key")).alias(key), F.col("doc_id").alias(f"{gone}_id"), F.col("key").alias(f"{gone}_key"), "stays")
    met = written(met, "group-told")
    # Rows that are alone in their group or its only first aren't in met; a filter of its keys lets most of them pass straight.
    keyed = may_be_in(docs.withColumn(key, of_row(F.col(id_col), text_key(F.col(text_col)))), key, met.select(key), may)
    same = F.col(id_col).eqNullSafe(F.col(f"{gone}_id")) & (text_key(F.col(text_col)) == F.col(f"{gone}_key"))
    told = met.drop(key)
    stay = keyed.filter(~F.col(may)).unionByName(keyed.filter(may).join(told, same, "left_anti")).select(*docs.columns)
    if met.filter("stays").isEmpty():
        return stay
    # Copies of a first in id and text are rare.
    several = keyed.filter(may).join(told.filter("stays"), same, "left_semi")
    return stay.unionByName(several.dropDuplicates([key]).select(*docs.columns))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The rows of docs that stay: of each component the one with the smallest id, as one_of_each() has it."""
    fps = written(fingerprints(docs, id_col, text_col, width, keyed=True), "simhash-fp")
    _, roots = _roots(fps, radius)
    several = fps.groupBy("fp").agg(F.count("*").alias("n")).join(roots, F.col("fp") == F.col("node"), "left").filter("n > 1 or root is not null")
    # Written, so that both sides of the join are plain exchanges, which adaptive execution can split at a hot fingerprint.
    judged = written(several.select(F.col("fp").alias("fp2"), F.coalesce("root", "fp").alias("group")), "simhash-judged")
    grouped = fps.join(judged, F.col("fp") == F.col("fp2")).select("doc_id", "key", "group")
    return one_of_each(docs, grouped, id_col, text_col)
