"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 builds two bit maps over the texts' hashes: the positions hit at least once and those hit at least twice. Each
task packs the positions that its rows hit, by ``BUCKET`` positions of the map: one row per task and bucket, whatever
the number of its rows, holds the positions seen once and those seen twice. These rows meet by bucket, where a
position is in the second map if some task saw it twice or several tasks saw it. No row per document or position
shuffles. The second map is packed in words of 64 positions.

Pass 2 tests every row against the packed map. A hash with a position that isn't marked is certainly unique, and its row
passes straight through, with no shuffle; only possibly repeated rows meet by hash, where exact groups are formed.

A map has ``MOST_BITS`` bits at most, so that it can be broadcast. For more rows the hashes are split into ranges, each
with a map of its own; the rows are dealt to folders by range (without a shuffle), and the passes run range by range.
So the share of unique rows that take the exact path stays the same at every size.

Texts are equal when identical; null counts as empty. Of equal texts the largest id stays (a null id only if all are
null). Rows that repeat both text and id count as copies of one document: the group's size counts each, all are marked
kept in the report, and ``exact_dedup`` returns one of them. An empty table gives an empty result. Other columns,
whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import clear_name, drop, new_path, reread, written

#: Bits of the filter for each row, and the most bits of one map: 2**27 are 2**21 packed words, a broadcast of 64 MB at most.
BITS_A_ROW = 16
MOST_BITS = 1 << 27
#: Positions a hash takes, and positions whose hits travel together.
POSITIONS = 2
BUCKET = 1 << 15


def _position(key: Column, k: int, bits: int) -> Column:
    """The k-th of a key's positions below bits, a power of two."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(k)), 7).bitwiseAND(F.lit(bits - 1))


def filter_bits(rows: int) -> int:
    """Bits of a map for this many rows: a power of two, two buckets at least."""
    bits = 2 * BUCKET
    while bits < rows * BITS_A_ROW:
        bits *= 2
    return bits


def repeated_positions(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """word, marked: packed words of the positions hit at least twice. Words without a marked bit are left out."""
    shift = BUCKET.bit_length() - 1
    hits = keys.select(F.spark_partition_id().alias("task"), F.explode(F.array(*[_position(F.col(key), k, bits) for k in range(POSITIONS)])).alias("pos"))
    packed = hits.groupBy("task", F.shiftright("pos", shift).alias("bucket")).agg(F.array_sort(F.collect_list(F.col("pos").bitwiseAND(F.lit(BUCKET - 1)).cast("short"))).alias("at"))
    again = lambda at: F.filter(at, lambda x, i: (i > 0) & (F.get(at, i - 1) == x))  # noqa: E731  at is sorted
    maps = packed.select("bucket", F.array_distinct("at").alias("once"), F.array_distinct(again(F.col("at"))).alias("twice"))
    met = maps.groupBy("bucket").agg(F.array_sort(F.flatten(F.collect_list("once"))).alias("once"), F.flatten(F.collect_list("twice")).alias("twice"))
    marked = met.select("bucket", F.explode(F.array_union(again(F.col("once")), F.col("twice"))).alias("at"))
    word = F.shiftleft("bucket", shift - 6) + F.shiftright(F.col("at").cast("long"), 6)
    return marked.groupBy("bucket", word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("marked")).select("word", "marked")


def with_possible(df: DataFrame, key: str, words: DataFrame, bits: int, name: str) -> DataFrame:
    """df with a boolean: whether all of the key's positions are marked. The map is broadcast; MOST_BITS bounds it."""
    test = F.lit(True)
    out = df
    for k in range(POSITIONS):
        at, word, marked = (clear_name(out, f"{x}{k}") for x in ("at", "word", "marked"))
        out = out.withColumn(at, _position(F.col(key), k, bits))
        out = out.join(F.broadcast(words.select(F.col("word").alias(word), F.col("marked").alias(marked))), F.shiftright(F.col(at), 6) == F.col(word), "left")
        test = test & F.coalesce(F.expr(f"(shiftrightunsigned(`{marked}`, cast(`{at}` & 63 as int)) & 1L) = 1L"), F.lit(False))
    return out.withColumn(name, test).select(*df.columns, name)


def may_be_in(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """rows with a boolean, whether the key may be among keys (column `key`). False is certain: such rows need no join.

    The map marks every position hit once. More keys than MOST_BITS are for fill it up, which lets more rows through.
    """
    bits = min(MOST_BITS, filter_bits(keys.count()))
    hits = keys.select(F.explode(F.array(*[_position(F.col(key), k, bits) for k in range(POSITIONS)])).alias("at"))
    words = hits.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("marked"))
    return with_possible(rows, key, written(words, "key-filter"), bits, name)


def _range(key: str, ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(-1)), F.lit(ranges)).cast("int")


def filters(keys: DataFrame, key: str) -> list[tuple[DataFrame, int]]:
    """Pass 1: (packed words, bits) of the second map of each range of hashes; keys has the key of every row."""
    n = keys.count()
    ranges = max(1, -(-n * BITS_A_ROW // MOST_BITS))
    bits = filter_bits(-(-n // ranges))
    if ranges == 1:
        return [(written(repeated_positions(keys, key, bits), "exact-filter"), bits)]
    dealt = written(keys.select(key).withColumn("part", _range(key, ranges)), "exact-dealt", by="part")
    return [(written(repeated_positions(dealt.filter(F.col("part") == r), key, bits), "exact-filter"), bits) for r in range(ranges)]


def possibly_repeated(rows: DataFrame, key: str, name: str, maps: list[tuple[DataFrame, int]]) -> DataFrame:
    """Pass 2: rows with a boolean, whether the key may occur in another row. False is certain."""
    if len(maps) == 1:
        return with_possible(rows, key, *maps[0], name)
    part = clear_name(rows, "part")
    dealt = written(rows.withColumn(part, _range(key, len(maps))), "exact-dealt", by=part)
    path = new_path(rows.sparkSession, "exact-tested")
    for r, (words, bits) in enumerate(maps):
        tested = with_possible(dealt.filter(F.col(part) == r).drop(part), key, words, bits, name)
        tested.write.mode("append").parquet(path)
    drop(dealt)
    return reread(rows.sparkSession, path, tested.schema)


def _sha(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256, and whether the filter passed it straight on."""
    keys = written(docs.select(F.col(id_col).alias("doc_id"), _sha(text_col).alias("sha")), "exact-keys")
    tested = possibly_repeated(keys, "sha", "possible", filters(keys, "sha"))
    alone = tested.filter(~F.col("possible")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha", F.lit(True).alias("straight"))
    rest = tested.filter("possible").select("doc_id", "sha")
    # Written, so that both sides of the join are plain exchanges, which adaptive execution can split at a hot text.
    groups = written(rest.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "exact-groups")
    met = rest.join(groups, "sha").select("doc_id", "keep_id", "group_size", "sha", F.lit(False).alias("straight"))
    return alone.unionByName(met).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "straight")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. Rows that the filter finds unique never shuffle."""
    key, possible, keep, group = (clear_name(docs, x) for x in ("sha", "possible", "keep", "group"))
    hashed = docs.withColumn(key, _sha(text_col))
    keys = written(hashed.select(F.col(key).alias("sha"), F.col(id_col).alias("doc_id")), "exact-keys")
    maps = filters(keys, "sha")
    # Text and id together pick the rows that stay, so the copies of a hot text are spread over all tasks.
    groups = possibly_repeated(keys, "sha", "possible", maps).filter("possible").groupBy("sha").agg(F.max("doc_id").alias(keep)).withColumnRenamed("sha", group)
    tested = possibly_repeated(hashed, key, possible, maps)
    rest = tested.filter(possible).join(groups, (F.col(key) == F.col(group)) & F.col(id_col).eqNullSafe(F.col(keep)), "left_semi")
    return tested.filter(~F.col(possible)).select(*docs.columns).unionByName(rest.dropDuplicates([key]).select(*docs.columns))
