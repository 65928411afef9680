"""Language by script: shares of code-point ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.functions.text import let

#: Language told for a script, and the script's ranges. Where scripts are shared, one language stands for all.
RANGES = (
    ("hi", r"\x{0900}-\x{097f}"), ("bn", r"\x{0980}-\x{09ff}"), ("pa", r"\x{0a00}-\x{0a7f}"), ("gu", r"\x{0a80}-\x{0aff}"),
    ("or", r"\x{0b00}-\x{0b7f}"), ("ta", r"\x{0b80}-\x{0bff}"), ("te", r"\x{0c00}-\x{0c7f}"), ("kn", r"\x{0c80}-\x{0cff}"),
    ("ml", r"\x{0d00}-\x{0d7f}"), ("si", r"\x{0d80}-\x{0dff}"), ("ur", r"\x{0600}-\x{06ff}\x{0750}-\x{077f}"), ("en", r"\x41-\x7A"),
)
#: Languages whose script others share.
AMBIGUOUS = ("hi", "bn")


def detect(text: Column) -> Column:
    """struct(language, confidence): the script with most characters, on ties the one that occurs first; null, 0.0 for none.

    A script's characters are counted by what is left without the others, one pass each with no array of matches. All
    scripts but the last lie in one range, so they are counted in the text's characters of that; places are looked for on ties.
    """

    def of(t: Column) -> Column:
        count = lambda x, r: F.length(F.regexp_replace(x, f"[^{r}]++", ""))
        latin, last = RANGES[-1][1], RANGES[-1][0]
        best_of = lambda counts: let(F.array_max(counts), lambda top: F.array_max(F.array(*[one(counts[k], top, r, code) for k, (code, r) in enumerate(RANGES)])))

        def one(n: Column, top: Column, r: str, code: str) -> Column:
            first = F.when((n == top) & (n > 0), -F.regexp_instr(t, F.lit(f"[{r}]"))).otherwise(F.lit(0))
            return F.struct(n.alias("n"), first.alias("first"), F.lit(code).alias("code"))

        several = let(F.regexp_replace(t, r"[^\x{600}-\x{dff}]++", ""), lambda s: let(F.array(*[count(s, r) for _, r in RANGES[:-1]], count(t, latin)), best_of))
        # Most texts hold no character of any script but the last: they need its count only.
        best = F.when(t.rlike(r"[\x{600}-\x{dff}]"), several).otherwise(F.struct(count(t, latin).alias("n"), F.lit(0).alias("first"), F.lit(last).alias("code")))
        return let(F.struct(best.alias("best"), F.length(F.regexp_replace(t, r"[\p{C}\p{Z}]++", "")).alias("visible")), told)

    def told(x: Column) -> Column:
        some = (x["best"]["n"] > 0) & (x["visible"] > 0)
        return F.struct(F.when(some, x["best"]["code"]).alias("language"), F.when(some, F.round(x["best"]["n"] / x["visible"], 4)).otherwise(F.lit(0.0)).alias("confidence"))

    return let(text, of)


def tag(text: Column, language: Column, confidence: Column) -> Column:
    """struct(language, confidence, script_ambiguous); a language known for certain stays and isn't marked."""
    known = language.isNotNull() & (confidence >= 1.0)
    return let(
        F.when(known, F.lit(None)).otherwise(detect(text)),
        lambda told: F.struct(
            F.when(known, language).otherwise(told["language"]).alias("language"),
            F.when(known, confidence).otherwise(told["confidence"]).alias("confidence"),
            F.when(~F.coalesce(known, F.lit(False)) & told["language"].isin(*AMBIGUOUS), F.lit(True)).alias("script_ambiguous"),
        ),
    )
