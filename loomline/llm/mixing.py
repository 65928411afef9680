"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Every source has a weight schedule over training time u in [0, 1]; its demand for words up to u is the integral of the
schedule, scaled so that it ends at the source's target. Documents of a source queue in hashed order. The running sum
of the words they give, put through the inverse of cumulative demand, is the time at which each copy is due: its
training position. A range sort by position gives the training order.

Targets: the mix takes ``share`` times all words, split by weight; no target exceeds ``most_repeats`` times its
source's words, and the excess is shared again by weight until none is above. Whole documents are taken, a further
repeat only for the head of the queue, up to the one document in which the target falls: of that one only the words
missing to the target are counted, so each source's sum is its target rounded.

Running sums use two levels (bucket sums, then the rows of one bucket), so no source, however hot, meets in one task;
so do the sums over sources where there are more than ``BROADCAST_SOURCES``.
Null or wordless text has size 0 and gives nothing. Null sources form one source, last. Rows that repeat an id are
documents of their own. Order depends on ids, texts' sizes and sources only, so reruns agree. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import clear_name, n_words, without_outputs, written

#: Weights of the sources in code-point order, repeating; share of all words; bound on repeats.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
#: Slope of the weight schedules, repeating likewise: weight at u is proportional to 1 + slope * (2u - 1).
SLOPES = (0.5, 0.0, -0.5)
#: What the operator adds to the columns it keeps.
OUTPUTS = ("size", "source_size", "target", "taken", "copies", "position", "last_position")
#: A table of sources of at most this many rows is broadcast, and goes through one task.
BROADCAST_SOURCES = 100_000


def running(rows: DataFrame, order: list[Column], sums: dict[str, str], several: bool) -> DataFrame:
    """rows with, by name, the sum of a column over the rows before in this order (0 for the first).

    several: the rows are dealt to tasks by range and sums run on two levels; else (few rows) one task has all.
    """
    if not several:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({name: F.coalesce(F.sum(c).over(before), F.lit(0)) for name, c in sums.items()})
    dealt = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-running")
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    of_part = Window.orderBy("_part2").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    bases = dealt.groupBy(F.col("_part").alias("_part2")).agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()]).select("_part2", *[F.coalesce(F.sum(f"_{name}").over(of_part), F.lit(0)).alias(f"_{name}") for name in sums])
    met = dealt.join(F.broadcast(bases), F.col("_part") == F.col("_part2"))
    return met.withColumns({name: F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"_{name}") for name, c in sums.items()}).drop("_part", "_part2", *[f"_{name}" for name in sums])


def source_targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS, share: float = SHARE, most_repeats: float = MOST_REPEATS, slopes=SLOPES) -> DataFrame:
    """One row per source: src, source_size, target, slope. sizes has a row per document."""
    sums = written(sizes.groupBy(F.col(source).alias("src")).agg(F.sum(size).alias("source_size"), F.lit(1).alias("one")), "mix-sources")
    several = sums.count() > BROADCAST_SOURCES
    by_name = F.col("src").asc_nulls_last()
    pick = lambda values: F.element_at(F.array(*[F.lit(float(x)) for x in values]), (F.col("at") % len(values) + 1).cast("int"))
    listed = running(sums, [by_name], {"at": "one"}, several).withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
    # Sources are capped in order of most_repeats * size / weight. With the first k capped, the others get `level` for
    # each unit of weight; a source is capped if the level of its own place reaches its ratio.
    listed = written(listed.withColumn("full", F.col("source_size") * float(most_repeats)).withColumn("ratio", F.col("full") / F.col("weight")), "mix-listed")
    all_size, all_weight = listed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    placed = running(listed, [F.col("ratio"), by_name], {"full_before": "full", "weight_before": "weight"}, several)
    placed = placed.withColumn("level", (F.lit(float(all_size) * float(share)) - F.col("full_before")) / (F.lit(float(all_weight)) - F.col("weight_before"))).withColumn("capped", F.col("level") >= F.col("ratio"))
    placed = written(placed, "mix-levels")
    # Levels fall after the first source that isn't capped; its level is the one.
    level = F.lit(placed.agg(F.max(F.when(~F.col("capped"), F.col("level")))).first()[0]).cast("double")
    return placed.withColumn("target", F.when(F.col("capped"), F.col("full")).otherwise(F.least(F.col("full"), F.col("weight") * level))).select("src", "source_size", "target", "slope")


def due(demanded: Column, target: Column, slope: Column) -> Column:
    """The time u at which cumulative demand target * ((1 - slope) u + slope u^2) reaches demanded."""
    part = F.when(target > 0, F.least(F.lit(1.0), demanded / target)).otherwise(F.lit(0.0))
    flat = 1 - slope
    return F.when((slope == 0) | (part == 0), part).otherwise((F.sqrt(flat * flat + 4 * slope * part) - flat) / (2 * slope))


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None, prefix: str = "", **options) -> DataFrame:
    """The columns in keep (default: all) with size, source_size, target, taken, copies, position, last_position.

    These, each after the prefix, replace columns of these names.

    position: when the first copy is due, in [0, 1]; null if nothing is taken. A repeat follows at last_position.
    """
    keep = without_outputs(docs.columns if keep is None else keep, (prefix + c for c in OUTPUTS))
    size, src, key, bucket, ahead, got, base, s_size, target, slope, src2, b2, times = (clear_name(docs, x) for x in ("size", "src", "key", "bucket", "ahead", "got", "base", "s_size", "target", "slope", "src2", "b2", "times"))
    # 60 bits of a hash; the queue runs in its order, and its first bits are the bucket.
    digest = F.md5(F.concat_ws(",", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(size).cast("string")))
    marked = docs.withColumn(size, n_words(F.col(text_col)).cast("long")).withColumn(key, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    slim = written(marked.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(key).alias("key"), F.col(size).alias("size")), "mix-sizes")
    rows = slim.count()
    buckets = 16
    while buckets * buckets < rows:  # as many buckets as a bucket has rows, so that neither level is long
        buckets *= 2
    in_bucket = lambda k: F.shiftright(k, 61 - buckets.bit_length())
    targets = written(source_targets(slim, "source", "size", **options), "mix-targets")
    small = targets.count() <= BROADCAST_SOURCES
    hint = F.broadcast if small else (lambda x: x)
    # Sources times buckets rows, at most about the square root of all rows for each source.
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))  # noqa: E731  never null, so window and joins share one partitioning
    sums = slim.groupBy(named(F.col("source")).alias(src2), in_bucket(F.col("key")).alias(b2)).agg(F.sum("size").alias("words"))
    base_of = sums.withColumn(base, F.coalesce(F.sum("words").over(Window.partitionBy(src2).orderBy(b2).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(src2, b2, base)
    queue = Window.partitionBy(src, bucket).orderBy(key, F.col(id_col), F.col(size)).rowsBetween(Window.unboundedPreceding, -1)
    lined = (
        marked.select(*dict.fromkeys([*keep, id_col]), named(F.col(source_col)).alias(src), key, size, in_bucket(F.col(key)).alias(bucket))
        .withColumn(ahead, F.coalesce(F.sum(size).over(queue), F.lit(0)))
        .join(base_of, (F.col(src) == F.col(src2)) & (F.col(bucket) == F.col(b2)))
        .withColumn(ahead, F.col(ahead) + F.col(base))
        .drop(src2, b2)
        .join(hint(targets.select(named(F.col("src")).alias(src2), F.col("source_size").alias(s_size), F.col("target").alias(target), F.col("slope").alias(slope))), F.col(src) == F.col(src2))
    )
    goal = F.round(F.col(target)).cast("long")
    whole = F.when(F.col(s_size) > 0, F.floor(goal / F.col(s_size))).otherwise(F.lit(0))
    more = goal - whole * F.col(s_size)  # words that the queue's head gives once more
    extra = F.greatest(F.lit(0), F.least(F.col(size), more - F.col(ahead)))
    taken = (whole * F.col(size) + extra).cast("long")
    # Each round of the queue is demanded after the one before.
    last = F.col(ahead) + F.col(s_size) * F.when(extra > 0, whole).otherwise(F.greatest(F.lit(0), whole - 1))
    some = F.col(got) > 0
    return (
        lined.withColumn(got, taken)
        .withColumn(times, F.when(some, whole + F.when(extra > 0, 1).otherwise(0)).otherwise(0).cast("int"))
        .select(
            *keep,
            F.col(size).alias(f"{prefix}size"),
            F.col(s_size).alias(f"{prefix}source_size"),
            F.col(target).alias(f"{prefix}target"),
            F.col(got).alias(f"{prefix}taken"),
            F.col(times).alias(f"{prefix}copies"),
            F.when(some, due(F.col(ahead), F.col(target), F.col(slope))).alias(f"{prefix}position"),
            F.when(some, due(last, F.col(target), F.col(slope))).alias(f"{prefix}last_position"),
        )
    )


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows range-sorted by position; those of which nothing is taken come last. Ids part rows of one position."""
    order = [F.col("position").asc_nulls_last(), F.xxhash64(F.col(id_col))]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself, with the columns of docs: a row per copy, range-sorted by the time it is due.

    The document in which a target falls is whole here.
    """
    prefix = clear_name(docs, "mix_")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    copies, first, last, when = (f"{prefix}{x}" for x in ("copies", "position", "last_position", "when"))
    step = (F.col(last) - F.col(first)) / (F.col(copies) - 1)
    times = F.when(F.col(copies) > 1, F.transform(F.sequence(F.lit(0), F.col(copies) - 1), lambda k: F.col(first) + step * k)).otherwise(F.array(first))
    order = [F.col(when), F.xxhash64(F.col(id_col))]
    rows = curriculum(docs, id_col, prefix=prefix, **options).filter(F.col(copies) > 0).withColumn(when, F.explode(times))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
