"""What the operators share: shared-folder tables, bounded chunks of Arrow batches, byte-level words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline import storage
from loomline.storage import drop as drop
from loomline.storage import new_path as new_path
from loomline.storage import reread as reread

#: Rows and bytes of text that one worker handles at a time.
CHUNK_ROWS = 2000
CHUNK_BYTES = 4 << 20

#: ASCII white space, as bytes.split() and the contracts' [\x20\x09-\x0D] have it.
ASCII_SPACE = r"[\x20\x09-\x0D]"
ASCII_WORD = r"[^\x20\x09-\x0D]"


def clear_name(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_outputs(columns: list[str], outputs: Iterable[str]) -> list[str]:
    """The columns whose names, whatever their case, no output has: an operator's outputs replace such input columns."""
    taken = {c.lower() for c in outputs}
    return [c for c in columns if c.lower() not in taken]


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def n_words(text: Column) -> Column:
    """Number of runs of bytes other than ASCII white space; 0 for null. One replacement a word, no array of them."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), rf"{ASCII_SPACE}*+{ASCII_WORD}++{ASCII_SPACE}*+|{ASCII_SPACE}++", "x")) - F.when(
        F.coalesce(text, F.lit("")).rlike(rf"\A{ASCII_SPACE}+\z"), 1
    ).otherwise(0)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of 1000 rows while a table is written or fetched, so that buffers of long texts stay small; the session's own bound after that."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    if 0 < int(own) <= 1000:
        yield
        return
    spark.conf.set(name, "1000")
    try:
        yield
    finally:
        spark.conf.set(name, own)


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """storage.written() with small Arrow batches."""
    with small_batches(df.sparkSession):
        return storage.written(df, name, by)


def fetched(df: DataFrame) -> pa.Table:
    """A small result on the driver, made with small Arrow batches."""
    with small_batches(df.sparkSession):
        return df.toArrow()


def give_back() -> None:
    """Returns memory that this worker has freed to the system: idle workers stay small beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def in_arrow(df: DataFrame, work, schema) -> DataFrame:
    """mapInArrow, for transform(). What a partition held is given back when it ends."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", max_rows: int = CHUNK_ROWS, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches, each with the column's values as bytes (null: empty); a longer single value makes a slice of its own."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        begin, held = 0, 0
        for i, n in enumerate([*lengths, max_bytes + 1]):
            if i > begin and (held + n > max_bytes or i - begin >= max_rows):
                part = batch.slice(begin, i - begin)
                values = part.column(at)
                kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
                yield part, [x or b"" for x in values.cast(kind).to_pylist()]
                begin, held = i, 0
            held += n


class Numbering(dict):
    """Numbers words as they are first looked up: ``map(numbering.__getitem__, words)``. ``new`` lists those since take()."""

    def __init__(self, known=()):
        super().__init__({w: i for i, w in enumerate(known)})
        self.new: list = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def take(self) -> list:
        new, self.new = self.new, []
        return new
