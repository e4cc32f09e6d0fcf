"""A filter of ids of fixed size, which spares a scan most rows that a join would drop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.words import U64, as_long, mix

#: Hash cells: 2 MiB of bits at every size of the input.
BITS = 24


def _cells(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell = (mix(ids.astype(np.int64).view(U64)) >> U64(64 - BITS)).astype(np.int64)
    return cell >> 6, (cell & 63).astype(U64)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, place = _cells(batch.column(0).to_numpy())
        bit = np.left_shift(U64(1), place)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(as_long(bit))], ["word", "bit"])


def filter_of(ids: DataFrame) -> np.ndarray:
    """A bit for each hash cell that one of the ids (a single column, no nulls) falls in.

    It may let others through, more of them the more ids there are, so a join must
    follow; it never holds one of the ids back. At most ``2 ** (BITS - 6)`` words reach the driver.
    """
    rows = ids.mapInArrow(_bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = rows.toPandas()
    flags = np.zeros(1 << (BITS - 6), dtype=np.int64)
    flags[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return flags.view(U64)


def may_hold(flags: np.ndarray, ids: np.ndarray) -> np.ndarray:
    word, place = _cells(ids)
    return ((flags[word] >> place) & U64(1)).astype(bool)


def either(flags: np.ndarray, hit: bool):
    """For mapInArrow: rows whose first column the filter lets through, or those it does not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(flags, batch.column(0).to_numpy()) == hit))

    return run
