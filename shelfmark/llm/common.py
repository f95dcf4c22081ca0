"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of a lower-cased text that belong to words; all others separate them.
WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
SPACE_BYTES = b"\x20\t\n\x0b\x0c\r"


def _fold(keep: Callable[[int], bool]) -> bytes:
    lower = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(b if keep(b) else 0x20 for b in lower)


# Lower-case A-Z and turn every separating byte into a space; bytes.split() then gives the words.
WORD_TABLE = _fold(lambda b: b in WORD_BYTES)
TOKEN_TABLE = _fold(lambda b: b not in SPACE_BYTES)


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text``: other columns cannot clash."""
    return bounded_batches(df).select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))


def raw_texts(array: pa.Array) -> Iterator[bytes | None]:
    """The texts of a string column as UTF-8 bytes, None for null."""
    for value in array.cast(pa.binary()):
        yield value.as_py()


def ragged(parts: list[np.ndarray], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return offsets, np.concatenate(parts).astype(dtype) if parts else np.zeros(0, dtype)


BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """See that texts reach Python in batches of a few MB, whatever their length; returns ``df``.

    The session's batch size is lowered where it is larger, which changes no result.
    """
    conf = df.sparkSession.conf
    now = re.fullmatch(r"(\d+)b?", conf.get(BATCH_SETTING))
    if now is None or int(now[1]) > BATCH_BYTES:
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    return df


def free_memory() -> None:
    """Give back what this Python worker holds unused, as left by earlier tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly over the session's shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
