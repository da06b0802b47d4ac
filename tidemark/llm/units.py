"""Units: runs of rows of bounded size, packed to one blob each, that travel to buckets and back.

An operator that must look up corpus-wide facts about many small things (words, n-grams, anchors) sends each unit's
distinct ones, sorted and packed by bucket, and gets one packed answer per (unit, bucket).  So the shuffle carries arrays,
not rows, and each unit has pre-aggregated what it sends: however often one value stands in a unit, it is sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

from . import vectext as vt

ROW = "unit long, bucket int, part int, n long, blob binary"
UNIT = 4 << 20
#: Stands for a null id; larger than any other.
NO_ID = np.iinfo(np.int64).max


def packed(x: np.ndarray | bytes) -> bytes:
    return zstandard.compress(x if isinstance(x, bytes) else x.tobytes(), 3)


def unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def rows(found: list[tuple]) -> pa.RecordBatch:
    """(unit, bucket, part, n, blob) tuples as a batch of ``ROW``."""
    columns = list(zip(*found, strict=True)) if found else [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["unit", "bucket", "part", "n", "blob"])


def grouped(batches, column: str) -> Iterator[tuple[int, list[tuple]]]:
    """Consecutive rows with one value of ``column``; partitions are sorted by it."""
    at, held = None, []
    for batch in batches:
        place = batch.schema.get_field_index(column)
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if row[place] != at and held:
                yield at, held
                held = []
            at = row[place]
            held.append(row)
    if held:
        yield at, held


def pack_units(most: int = UNIT):
    """Batches of (doc_id, text, ...) to units as part 0.  A unit's number is that of its task and its place in it."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def whole() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_table(table)
            return rows([(task + count, -1, 0, len(table), packed(sink.getvalue().to_pybytes()))])

        for batch in batches:
            columns = {"doc_id": batch.column(0).cast(pa.int64()).fill_null(NO_ID), "text": batch.column(1).fill_null("").cast(pa.large_string())}
            columns |= {n: batch.column(i) for i, n in enumerate(batch.schema.names) if i > 1}
            for part in vt.pieces(pa.record_batch(columns), most=UNIT // 4):
                held.append(part)
                size += len(vt.column(part.column(1))[0])
                if size >= most:
                    yield whole()
                    held, size, count = [], 0, count + 1
        if held:
            yield whole()

    return run


def unit_table(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(blob)).read_all().combine_chunks()
