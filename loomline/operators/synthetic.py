"""Synthetic instruction data: expansion of seeds, deduplication, validation of instructions and tool trajectories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.operators.dedup import keep_first

#: The templates in order; {0} is the instruction, {1} the same with a small first letter.
TEMPLATES = ("{0}", "Please {1}", "Can you {1}", "{0} Explain briefly.", "As an expert, {1}")


def expand(seeds: DataFrame, per_seed: int = 4, templates: tuple[str, ...] = TEMPLATES) -> DataFrame:
    """per_seed rows per seed, from the templates in turn: the seed's columns with new id, instruction, origin, seed_id and i."""
    plain = F.coalesce("instruction", F.lit(""))
    small = F.concat(F.lower(F.substring(plain, 1, 1)), F.expr("substring(coalesce(instruction, ''), 2)"))

    def filled(template: str) -> Column:
        mark = "{0}" if "{0}" in template else "{1}"
        before, _, after = template.partition(mark)
        return F.concat(F.lit(before), plain if mark == "{0}" else small, F.lit(after))

    turns = seeds.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(per_seed - 1)))) if per_seed > 0 else seeds.withColumn("i", F.lit(0)).limit(0)
    made = F.element_at(F.array(*map(filled, templates)), F.col("i") % len(templates) + 1)
    new = turns.withColumn("seed_id", F.col("id")).withColumn("instruction", made)
    return new.withColumn("id", F.concat(F.lit("syn-"), F.left(F.md5(F.concat_ws("-", "seed_id", "i", "instruction")), F.lit(12)))).withColumn("origin", F.lit("synthetic"))


def build(seeds: DataFrame, per_seed: int = 4, order: str = "ord", generator: Callable[[DataFrame, int], DataFrame] = expand) -> DataFrame:
    """New examples whose instruction no seed has, the first of each in the order of seeds and templates."""
    made = generator(seeds, per_seed).withColumn("_key", X.instruction_key(F.col("instruction")))
    known = seeds.select(X.instruction_key(F.coalesce("instruction", F.lit(""))).alias("_known")).distinct()
    new = made.join(known, F.col("_key") == F.col("_known"), "left_anti").withColumn("_at", F.struct(F.col(order), "i"))
    return keep_first(new, F.col("_key"), "_at").filter(F.col("parent").isNull()).drop("_key", "_at", "parent", "i")


def instruction_issue() -> Column:
    """Of columns instruction and output: the first rule that fails; null if none does."""
    i, o = X.strip(F.coalesce("instruction", F.lit(""))), X.strip(F.coalesce("output", F.lit("")))
    return (
        F.when(F.length(i) == 0, F.lit("empty_instruction"))
        .when(F.length(o) == 0, F.lit("empty_output"))
        .when(F.lower(i) == F.lower(o), F.lit("output_echoes_instruction"))
        .when(F.length("output") < 2, F.lit("output_too_short"))
    )


def as_text() -> Column:
    """Instruction, input if there is one, and output, by lines."""
    return F.concat_ws("\n", "instruction", F.when(F.length("input") > 0, F.col("input")), "output")


def trajectory_problems() -> Column:
    """Of columns goal, final_answer, available_tools, steps (array of struct with tool): all problems in order."""
    blank = lambda c: F.length(X.strip(F.coalesce(c, F.lit("")))) == 0
    steps = F.col("steps")
    limited = F.size("available_tools") > 0

    def of_step(s: Column, i: Column) -> Column:
        tool = F.coalesce(s["tool"], F.lit(""))
        undeclared = limited & ~F.array_contains("available_tools", tool)
        name = F.concat(F.lit("step"), i.cast("string"))
        return F.array(F.when(undeclared, F.concat(name, F.lit("_undeclared_tool:"), tool)), F.when(F.length(tool) == 0, F.concat(name, F.lit("_empty_tool"))))

    own = F.array(F.when(blank(F.col("goal")), F.lit("empty_goal")), F.when(F.coalesce(F.size(steps), F.lit(0)) <= 0, F.lit("no_steps")), F.when(blank(F.col("final_answer")), F.lit("no_final_answer")))
    return F.array_compact(F.concat(own, F.coalesce(F.flatten(F.transform(steps, of_step)), F.array().cast("array<string>"))))
