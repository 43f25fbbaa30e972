"""Words, folds and hash draws shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than blank, tab, \n, \v, \f, \r. `bytes.split()`
# cuts at just these six, and `bytes.lower()` lowers just A-Z.
WORD = r"[^\x20\x09-\x0D]+"


def named(column: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns, under the operator's own names."""
    return df.select(*[named(c).alias(name) for name, c in columns.items()])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key's text modulo folds; a null key is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(folds)), F.lit(0)).cast("int")


def draw(seed: int, *parts: Column) -> Column:
    """60 uniform bits from the md5 of the seed and the parts; nulls differ from empty texts."""
    spelled = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("~")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *spelled)), 1, 15), 16, 10).cast("long")


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text of a batch; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def lower_words(text: bytes) -> list[bytes]:
    return text.lower().split()


# The C library's own means; others than glibc have none.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Arrow and the C library give back what they keep free, such as that of the group or batch before."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def chunks(batch: pa.RecordBatch | pa.Array, rows: int = 512) -> Iterator[pa.RecordBatch | pa.Array]:
    """Slices of a batch or column, so that what is built per slice stays small beside very long texts.

    After each batch its free memory is given back: workers live on for the next stages.
    """
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
    release()


def text_chunks(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts, its last column, have at most `limit` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
    release()
