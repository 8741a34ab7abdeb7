"""Where owners of equal keys meet, with little said about keys that only one owner has.

A map task packs a batch into one row for each part: an entry for every distinct key of the
part, and beside it, spread over all parts alike, the owners of keys that several owners in
the batch have. The task of a part finds the keys that several batches sent and passes the
others' owners through. So a key that a third of all rows have is one entry for each batch,
and its owners are dealt evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "part int, packed binary, met binary"
NAMES = ["part", "packed", "met"]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys start, and their lengths."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return first, np.diff(np.append(first, len(keys)))


def _sorted(columns: np.ndarray) -> np.ndarray:
    """Distinct key and owner, with the least of what else is said."""
    columns = columns[:, np.lexsort(columns[::-1])]
    keys, owners = columns[:2]
    return columns[:, np.append(True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1]))]


def entries(columns: list[np.ndarray], parts: int, first_part: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of one batch of equally long columns: key, owner and what else is told."""
    if not len(columns[0]):
        return
    columns = _sorted(np.stack([c.view(np.int64) for c in columns]))
    first, size = _runs(columns[0])
    met = columns[:, np.repeat(size > 1, size)]
    columns = columns[:, first]
    part = (columns[0].view(np.uint64) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, columns = part[order], columns[:, order]
    starts, size = _runs(part)
    rows = len(starts)
    packed = [columns[:, a : a + n].tobytes() for a, n in zip(starts, size, strict=True)]
    beside = [met[:, k::rows].tobytes() for k in range(rows)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(part[starts] + np.int32(first_part)), pa.array(packed, pa.binary()), pa.array(beside, pa.binary())],
        NAMES,
    )


def members(found: DataFrame, names: list[str]) -> DataFrame:
    """``part`` and ``names`` (key, owner, ...) of all keys with several owners; rows may
    come twice."""

    def unpacked(blocks: pa.Table) -> pa.Table:
        def read(column: str) -> np.ndarray:
            cut = [
                np.frombuffer(x.as_buffer(), dtype=np.int64).reshape(len(names), -1)
                for x in blocks.column(column)
            ]
            return np.concatenate(cut, axis=1)

        columns = _sorted(read("packed"))
        _, size = _runs(columns[0])
        columns = np.concatenate([columns[:, np.repeat(size > 1, size)], read("met")], axis=1)
        part = pa.array(np.full(columns.shape[1], blocks.column("part")[0].as_py(), np.int32))
        return pa.table([part, *map(pa.array, columns)], ["part", *names])

    schema = ", ".join(["part int", *(f"{n} long" for n in names)])
    return found.select(*NAMES).groupBy("part").applyInArrow(unpacked, schema)
