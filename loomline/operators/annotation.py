"""Annotation quality: agreement statistics, consensus, annotator checks, preference data. Labels are strings.

Every statistic is an aggregate over counts of (item, label), so an item with many raters is a few rows, never pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import strip
from loomline.operators.dedup import keep_first
from loomline.storage import written


def explode_items(items: DataFrame) -> DataFrame:
    """item_id, gold_label, annotator_id, label: a row per annotation of nested items (items without any are left out)."""
    a = F.explode("annotations").alias("a")
    return items.select(F.col("id").alias("item_id"), F.col("gold_label").cast("string").alias("gold_label"), a).select("item_id", "gold_label", "a.annotator_id", F.col("a.label").cast("string").alias("label"))


def percent_agreement(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row: agreement, the share of equal labels; 0 for none."""
    return pairs.agg(F.coalesce(F.avg(F.col(a).eqNullSafe(F.col(b)).cast("double")), F.lit(0.0)).alias("agreement"))


def cohen_kappa(pairs: DataFrame, a: str = "a", b: str = "b", by: tuple[str, ...] = ()) -> DataFrame:
    """kappa (4 places) of two label columns, for each group of `by`; 1 if chance agreement is certain, 0 for no pairs."""
    group = list(by)
    counted = pairs.groupBy(*group, F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("c"))
    sides = counted.select(*group, F.explode(F.array(F.struct(F.col("a").alias("label"), F.col("c").alias("x"), F.lit(0).alias("y")), F.struct(F.col("b").alias("label"), F.lit(0).alias("x"), F.col("c").alias("y")))).alias("s"))
    margins = sides.groupBy(*group, "s.label").agg(F.sum("s.x").alias("x"), F.sum("s.y").alias("y")).groupBy(*group).agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    agreed = counted.groupBy(*group).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("a").eqNullSafe(F.col("b")), F.col("c")).otherwise(0)).alias("same"))
    both = agreed.join(margins, group) if group else agreed.withColumn("_", F.lit(1)).join(margins.withColumn("_", F.lit(1)), "_").drop("_")
    po, pe = F.col("same") / F.col("n"), F.col("xy") / (F.col("n") * F.col("n"))
    kappa = F.when(F.coalesce("n", F.lit(0)) == 0, F.lit(0.0)).when(F.col("xy") == F.col("n") * F.col("n"), F.lit(1.0)).otherwise(F.round((po - pe) / (1 - pe), 4))
    return both.select(*group, kappa.alias("kappa"))


def fleiss_kappa(labels: DataFrame) -> DataFrame:
    """One row: fleiss_kappa of item_id, label rows. Fails unless all items have the same number, 2 at least, of raters."""
    counts = labels.groupBy("item_id", "label").agg(F.count("*").alias("c"))
    items = counts.groupBy("item_id").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("squares"))
    p = items.agg(F.count("*").alias("n"), F.min("m").alias("least"), F.max("m").alias("m"), F.avg(F.try_divide(F.col("squares") - F.col("m"), F.col("m") * (F.col("m") - 1))).alias("p_bar"))
    totals = counts.groupBy("label").agg(F.sum("c").alias("t")).agg(F.sum("t").alias("all"), F.sum(F.col("t") * F.col("t")).alias("squares"))
    row = p.withColumn("_", F.lit(1)).join(totals.withColumn("_", F.lit(1)), "_")
    pe = F.col("squares") / (F.col("all") * F.col("all"))
    uneven = (F.col("least") != F.col("m")) | (F.col("m") < 2)
    kappa = (
        F.when(F.col("n") == 0, F.lit(0.0))
        .when(uneven, F.raise_error(F.lit("Fleiss' kappa needs an equal number (2 at least) of raters per item")).cast("double"))
        .when(F.col("squares") == F.col("all") * F.col("all"), F.lit(1.0))
        .otherwise(F.round((F.col("p_bar") - pe) / (1 - pe), 4))
    )
    return row.select(kappa.alias("fleiss_kappa"))


def krippendorff_alpha_pooled(labels: DataFrame) -> DataFrame:
    """One row: alpha (nominal) of item_id, label rows, with disagreeing pairs pooled over items; missing ratings allowed."""
    counts = labels.groupBy("item_id", "label").agg(F.count("*").alias("c"))
    items = counts.groupBy("item_id").agg(F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("c") - 1)).alias("same")).filter("m > 1")
    observed = items.agg(F.sum("same").alias("same"), F.sum(F.col("m") * (F.col("m") - 1)).alias("pairs"))
    values = counts.join(items.select("item_id"), "item_id", "left_semi").groupBy("label").agg(F.sum("c").alias("t")).agg(F.sum("t").alias("n"), F.sum(F.col("t") * (F.col("t") - 1)).alias("chance"))
    row = observed.withColumn("_", F.lit(1)).join(values.withColumn("_", F.lit(1)), "_")
    expected = 1 - F.col("chance") / (F.col("n") * (F.col("n") - 1))
    alpha = F.when(F.col("pairs").isNull(), F.lit(0.0)).when(F.col("chance") == F.col("n") * (F.col("n") - 1), F.lit(1.0)).otherwise(F.round(1 - (1 - F.col("same") / F.col("pairs")) / expected, 4))
    return row.select(alpha.alias("alpha"))


def consensus(labels: DataFrame) -> DataFrame:
    """item_id, consensus (null on a tie), agreement (4 places), n_annotations, needs_adjudication."""
    counts = labels.groupBy("item_id", "label").agg(F.count("*").alias("c"))
    best = counts.groupBy("item_id").agg(F.sum("c").alias("n"), F.max("c").alias("top"), F.max_by("label", "c").alias("label"))
    tied = counts.join(best.select("item_id", "top"), "item_id").filter("c = top").groupBy("item_id").agg(F.count("*").alias("firsts"))
    share = F.col("top") / F.col("n")
    label = F.when(F.col("firsts") == 1, F.col("label"))
    return best.join(tied, "item_id").select("item_id", label.alias("consensus"), F.round(share, 4).alias("agreement"), F.col("n").alias("n_annotations"), (label.isNull() | (share < 0.66)).alias("needs_adjudication"))


def annotator_accuracy(labels: DataFrame) -> DataFrame:
    """annotator_id, accuracy (4 places) on the annotations of items with a gold_label."""
    return labels.filter(F.col("gold_label").isNotNull()).groupBy("annotator_id").agg(F.round(F.avg((F.col("label").eqNullSafe(F.col("gold_label"))).cast("double")), 4).alias("accuracy"))


def annotator_vs_consensus(labels: DataFrame) -> DataFrame:
    """annotator_id, kappa against the consensus, on items that have one."""
    agreed = consensus(labels).filter(F.col("consensus").isNotNull()).select("item_id", "consensus")
    return cohen_kappa(labels.join(agreed, "item_id"), "label", "consensus", ("annotator_id",))


def annotator_report(labels: DataFrame, least_accuracy: float = 0.8, least_kappa: float = 0.4) -> DataFrame:
    """annotator_id, accuracy, kappa and whether either is under its bound; a missing value counts as fine."""
    both = annotator_accuracy(labels).join(annotator_vs_consensus(labels), "annotator_id", "full")
    flagged = (F.coalesce("accuracy", F.lit(1.0)) < least_accuracy) | (F.coalesce("kappa", F.lit(1.0)) < least_kappa)
    return both.select("annotator_id", "accuracy", "kappa", flagged.alias("flagged"))


def qa_report(items: DataFrame) -> dict:
    """The report over nested items, as a dictionary on the driver (one entry per annotator)."""
    labels = written(explode_items(items), "annotations")
    n = items.count()
    agreed = consensus(labels)
    row = agreed.agg(F.count_if("needs_adjudication").alias("bad"), F.sum("agreement").alias("agreement"), F.count("*").alias("n"), F.min("n_annotations").alias("least"), F.max("n_annotations").alias("most")).first()
    out = {
        "num_items": n,
        "needs_adjudication": row["bad"] + n - row["n"],  # items without annotations have no consensus
        "mean_agreement": round((row["agreement"] or 0.0) / n, 4) if n else 0.0,
        "annotator_accuracy": {r["annotator_id"]: r["accuracy"] for r in annotator_accuracy(labels).collect()},
        "annotator_vs_consensus_kappa": {r["annotator_id"]: r["kappa"] for r in annotator_vs_consensus(labels).collect()},
    }
    if n and n == row["n"] and row["least"] == row["most"] and row["most"] > 1:
        out["fleiss_kappa"] = fleiss_kappa(labels).first()["fleiss_kappa"]
    return out


def preference_issues(pairs: DataFrame, order: str = "ord") -> DataFrame:
    """pairs with issue: chosen_equals_rejected, duplicate_pair (of an earlier one) or null."""
    same = F.coalesce(strip(F.col("chosen")) == strip(F.col("rejected")), F.lit(False))
    key = F.sha2(F.to_json(F.array("prompt", "chosen", "rejected")), 256)
    marked = keep_first(pairs.withColumn("_same", same), key, order, ~F.col("_same"))
    issue = F.when(F.col("_same"), F.lit("chosen_equals_rejected")).when(F.col("parent").isNotNull(), F.lit("duplicate_pair"))
    return marked.withColumn("issue", issue).drop("_same", "parent")


def cyclic_prompts(pairs: DataFrame) -> DataFrame:
    """Prompts whose graph of chosen -> rejected has a cycle.

    Edges whose end has no way on, or whose start has no way in, are no part of a cycle; they are taken off until none
    is left to take. What remains is cyclic. A path of any length needs no recursion.
    """
    edges = written(pairs.select("prompt", F.col("chosen").alias("src"), F.col("rejected").alias("dst")).distinct(), "preference-edges")
    n = edges.count()
    while n:
        starts, ends = edges.select("prompt", F.col("src").alias("node")).distinct(), edges.select("prompt", F.col("dst").alias("node")).distinct()
        both = starts.join(ends, ["prompt", "node"])
        left = edges.join(both.withColumnRenamed("node", "dst"), ["prompt", "dst"], "left_semi").join(both.withColumnRenamed("node", "src"), ["prompt", "src"], "left_semi")
        edges = written(left, "preference-edges")
        n, before = edges.count(), n
        if n == before:
            break
    return edges.select("prompt").distinct()


def preference_report(pairs: DataFrame, order: str = "ord") -> tuple[dict, DataFrame]:
    """(total, clean, cyclic_prompts and the issues by kind; the clean pairs, those of cyclic prompts included)."""
    marked = written(preference_issues(pairs, order), "preferences")
    clean = marked.filter(F.col("issue").isNull()).drop("issue")
    kinds = {r["issue"]: r["count"] for r in marked.filter(F.col("issue").isNotNull()).groupBy("issue").count().collect()}
    cyclic = cyclic_prompts(clean).count()
    return {"total": marked.count(), "clean": clean.count(), "cyclic_prompts": cyclic, "issues": kinds | ({"cyclic_preferences": cyclic} if cyclic else {})}, clean

