"""Text functions as Columns. Lengths and positions count code points; white space is Python's unless said otherwise."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that str.split() and str.strip() take as white space.
PY_SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, NOT_WS = f"[{PY_SPACE}]", f"[^{PY_SPACE}]"
#: Characters without width that normalising deletes; the joiners only on demand.
INVISIBLE, JOINERS = chr(0x200B) + chr(0xFEFF) + chr(0xAD), chr(0x200C) + chr(0x200D)
WORD = r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*+"
#: Unicode white space, which is Python's without U+001C to U+001F.
UNICODE_SPACE = r"[\t-\r\x20" + PY_SPACE[PY_SPACE.index("x85") - 1 :] + "]"
ANCHOR = rf"\p{{Nd}}+|https?://{NOT_WS}+|[A-Z][a-zA-Z]{{2,}}"


#: Bytes of text and rows that a Python function turns into objects at a time.
PIECE_BYTES, PIECE_ROWS = 1 << 18, 1000


def in_pieces(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch of texts in slices of bounded size (a longer text is one of its own): what Python makes of them doesn't grow with the batch."""
    begin, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch), 0).to_pylist()):
        if i > begin and (held + n > PIECE_BYTES or i - begin >= PIECE_ROWS):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if len(batch) > begin:
        yield batch.slice(begin)


def _compose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for piece in in_pieces(batch):
            yield pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in piece.to_pylist()], pa.string())


@cache
def uncomposed() -> str:
    """A pattern that every text has which canonical composition changes.

    By the quick check of Unicode's annex 15: characters that don't stay, or may be composed with the one before, and marks
    in a row (which may be out of order). All others are in place, whatever is beside them.
    """
    moves, marks = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3)), []  # vowels and ends of Korean syllables
    for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))):
        if unicodedata.combining(c):
            marks.append(ord(c))
        parts = unicodedata.decomposition(c)
        if parts and parts[0] != "<":
            moves |= {int(x, 16) for x in parts.split()[1:]}
            if not unicodedata.is_normalized("NFC", c):
                moves.add(ord(c))

    def ranges(codes: Iterable[int]) -> str:
        found: list[list[int]] = []
        for x in sorted(codes):
            if found and x == found[-1][1] + 1:
                found[-1][1] = x
            else:
                found.append([x, x])
        return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in found) + "]"

    return f"{ranges(moves)}|{ranges(marks)}{{2}}"


def nfc(text: Column) -> Column:
    """Canonical composition. Spark has none built in; only texts that it may change reach Python, the rest are nulls there."""
    composed = F.arrow_udf(_compose, T.StringType())
    return F.coalesce(composed(F.when(text.rlike(r"[^\x00-\x{2FF}]"), F.when(text.rlike(uncomposed()), text))), text)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: inside a lambda an expression would be computed at every element."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"\A{WS}++", ""), rf"{WS}++\z", "")


def collapse(text: Column) -> Column:
    """Words joined by single spaces."""
    return F.trim(F.regexp_replace(text, rf"{WS}++", " "))


#: White space but for the space and the line feed; and the part of it in ASCII.
OTHER_SPACE = r"[\t\x0b-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
OTHER_ASCII_SPACE = r"[\t\x0b-\r\x1c-\x1f]"


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _tidy(t: Column, line_space: str, space_run: str) -> Column:
    """Runs of spaces to one, no spaces at the ends of lines, two line feeds at most. Each pass only where its mark occurs."""
    only = lambda mark, x, pattern, to: F.when(mark, F.regexp_replace(x, pattern, to)).otherwise(x)
    t = let(t, lambda x: F.regexp_replace(x, space_run, " ") if space_run != " {2,}" else only(F.contains(x, F.lit("  ")), x, space_run, " "))
    t = let(t, lambda x: only(F.contains(x, F.lit("\u0964")) | F.contains(x, F.lit("\u0965")), x, rf"{WS}++([\x{{964}}\x{{965}}])", "$1"))
    t = let(t, lambda x: only(F.contains(x, F.lit("\n")), x, rf"\n{line_space}++", "\n"))
    t = let(t, lambda x: only(F.contains(x, F.lit(" \n")) if line_space == " " else F.contains(x, F.lit("\n")), x, rf"{line_space}++\n", "\n"))
    return let(t, lambda x: only(F.contains(x, F.lit("\n\n\n")), x, r"\n{3,}", "\n\n"))


def normalize(text: Column, strip_joiners: bool = False, compose=nfc) -> Column:
    """Canonical text: composed, without invisible characters, tidy spaces, lines and dandas; empty for null.

    Most texts have no white space but spaces and line feeds: they go through cheaper patterns.
    """

    def tidy(t: Column) -> Column:
        other = F.when(is_ascii(t), t.rlike(OTHER_ASCII_SPACE)).otherwise(t.rlike(OTHER_SPACE))
        line_space = OTHER_SPACE.replace(r"[\t", r"[ \t")
        whole = strip(_tidy(F.regexp_replace(t, r"\r\n|\r", "\n"), line_space, r"[ \t\xa0\x{2000}-\x{200a}]++"))
        return F.when(other, whole).otherwise(F.btrim(_tidy(t, " ", " {2,}"), F.lit(" \n")))

    composed = compose(F.coalesce(text, F.lit("")))
    invisible = INVISIBLE + (JOINERS if strip_joiners else "")
    bare = let(composed, lambda t: F.when(is_ascii(t), t).otherwise(F.translate(t, invisible, "")))
    return let(bare, tidy)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Each word becomes one x, and no x is left of anything else."""
    marked = F.when(is_ascii(text), F.regexp_replace(text, "[0-9A-Za-z]++", "x")).otherwise(F.regexp_replace(text, WORD, "x"))
    return let(marked, lambda t: F.length(t) - F.length(F.replace(t, F.lit("x"), F.lit(""))))


def symbol_count(text: Column) -> Column:
    """Characters that are no letter, number, mark or white space: what is left without those."""
    wide = F.regexp_replace(F.regexp_replace(text, r"[\p{L}\p{N}\p{M}]++", ""), f"{UNICODE_SPACE}++", "")
    return F.length(F.when(is_ascii(text), F.regexp_replace(text, r"[0-9A-Za-z\t-\r ]++", "")).otherwise(wide))


def digit_count(text: Column) -> Column:
    """What is lost without digits, counted with no array of matches."""
    return F.length(text) - F.length(F.when(is_ascii(text), F.regexp_replace(text, "[0-9]++", "")).otherwise(F.regexp_replace(text, r"\p{Nd}++", "")))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _strings(*items: Column) -> Column:
    return F.array(*items).cast("array<string>")


def _runs(t: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(t) - (k - 1)), lambda i: F.substring(t, i, F.lit(k)))


def char_shingles(text: Column, k: int) -> Column:
    """Distinct runs of k characters of the collapsed text; a shorter text is its own, an empty one has none."""
    return let(collapse(text), lambda t: F.when(F.length(t) > k, F.array_distinct(_runs(t, k))).when(F.length(t) > 0, F.array(t)).otherwise(_strings()))


def char_ngrams(text: Column, n: int) -> Column:
    """All runs of n characters of the collapsed text, repeats included; a shorter text is its own."""
    return let(collapse(text), lambda t: F.when(F.length(t) >= n, _runs(t, n)).when(F.length(t) > 0, F.array(t)).otherwise(_strings()))


def space_words(text: Column) -> Column:
    """White-space words; none for an empty text."""
    return let(collapse(text), lambda t: F.when(F.length(t) > 0, F.split(t, " ")).otherwise(_strings()))


def word_ngrams(text: Column, n: int) -> Column:
    """Runs of n white-space words in order of position; a text of fewer is one gram, an empty one has none."""

    def grams(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(_strings())

    return let(space_words(text), grams)


def anchors(text: Column) -> Column:
    """Distinct numbers, links and capitalised Latin words."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(ANCHOR), F.lit(0)))


def instruction_key(text: Column) -> Column:
    return collapse(F.lower(text))


def lookup_key(text: Column) -> Column:
    return F.lower(strip(text))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return ratio(both.cast("double"), F.size(F.array_union(a, b)))


def html_text(html: Column) -> Column:
    """Text without scripts, styles and tags, white space collapsed; character references stay."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    return collapse(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))
