"""Sums of large numeric tables that tasks make in parts."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

CELLS = 1 << 16            # cells of a table that travel as one row, compressed: most are zeros or small counts
PARTS = "block int, cells binary"


def give_back() -> None:
    """Return freed memory to the system: idle worker processes keep theirs between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _pack(cells: np.ndarray) -> bytes:
    return zlib.compress(cells.astype(np.float32).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.float32)


def blocks_of(table: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows (block, cells) of a float table; blocks of zeros are left out."""
    flat = table.reshape(-1).astype(np.float32)
    for i in range(0, len(flat), CELLS):
        if flat[i:i + CELLS].any():
            yield pd.DataFrame({"block": [i // CELLS], "cells": [_pack(flat[i:i + CELLS])]})


def _add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, cells in zip(batch["block"].tolist(), batch["cells"]):
            own = _unpack(cells)
            total[block] = total[block] + own if block in total else own.astype(np.float64)
    for block, cells in total.items():
        yield pd.DataFrame({"block": [block], "cells": [_pack(cells)]})


def summed(parts: DataFrame, shape: tuple[int, ...], ways: int = 16) -> np.ndarray:
    """The sum of all tasks' tables. Rows are added as they stream by, first in ``ways`` groups of
    tasks and then over these, so no task holds more than its blocks; the driver gets one table."""
    some = parts.withColumn("way", F.spark_partition_id() % ways).repartition("block", "way")
    rows = some.select("block", "cells").mapInPandas(_add, PARTS).repartition("block").mapInPandas(_add, PARTS)
    out = np.zeros(int(np.prod(shape)), np.float32)
    for r in stored(rows, "summed").toLocalIterator():
        out[r["block"] * CELLS:][:CELLS] = _unpack(r["cells"])
    return out.reshape(shape)
