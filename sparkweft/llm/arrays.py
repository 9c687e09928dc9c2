"""Sorted arrays in the shared folder, mapped into memory by the workers that look things up in them.

A table is cut into buckets by the top bits of a 64-bit hash. A bucket is one file: a count, then its
columns one after the other, sorted by hash. Files are written under another name and renamed, so a task
that is repeated does no harm. Where the shared folder is mounted (file:) files are mapped in place and their pages
belong to the system's cache; from another store (by pyarrow's file systems) each worker holds the buckets it used last
in memory, up to HELD_BYTES.

Values on their way to buckets are rows of ROWS. With more buckets than 2**FANOUT a block of values would fall
into as many rows of a value or two; so blocks are dealt to 2**FANOUT coarse buckets first, each value with its
bucket's number, and after a shuffle tasks deal what has come together, some HELD_VALUES at a time (`redealt`).
At 100 TB, some 10^6 splits: 2**20 buckets; 10^13 grams of 8 to 16 bytes are 80 to 150 MB a bucket, which one task
sorts; blocks send 4096 rows each, and dealing again makes rows of at least 10,000 values.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkweft.llm.common import local_path


ROWS = "kind int, bucket long, level int, cols array<binary>"
FANOUT, HELD_VALUES, HELD_BYTES = 12, 4_000_000, 256 << 20


def bits_for(tasks: int, least: int = 10, most: int = 20) -> int:
    """Bits of bucket numbers for an input of so many map tasks: buckets get no larger as the input grows, to some 100 TB."""
    return min(most, max(least, (8 * tasks - 1).bit_length()))


def more_bits(bits: int) -> int:
    """Bits that are left for dealing again. Asked on the driver."""
    return max(0, bits - FANOUT)


def dealt(kind: int, level: int, of: np.ndarray, columns: list[np.ndarray], more: int) -> list[tuple]:
    """Rows of ROWS: the columns' values, dealt by their (coarse) bucket; with more bits to come the last column is the bucket."""
    coarse = of >> more if more else of
    order = np.argsort(coarse, kind="stable")
    coarse, columns = coarse[order], [c[order] for c in (*columns, *([of] if more else []))]
    edges = [0, *(np.flatnonzero(coarse[1:] != coarse[:-1]) + 1).tolist(), len(of)] if len(of) else [0]
    return [(kind, int(coarse[a]), level, [planes(c[a:b].astype(c.dtype if c.itemsize == 8 else np.int64)) for c in columns]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, level, cols = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.record_batch({"kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int64()), "level": pa.array(level, pa.int32()), "cols": pa.array(cols, pa.list_(pa.binary()))})


def redealt(rows: DataFrame, more: int, plain: int | None = None) -> DataFrame:
    """rows by their own buckets instead of coarse ones; those of the kind `plain` go as they are."""
    if not more:
        return rows
    held_values = HELD_VALUES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[list[np.ndarray]]] = {}
        n = 0

        def sent() -> pa.RecordBatch:
            out = []
            for (kind, level), parts in held.items():
                *columns, of = (np.concatenate(c) for c in zip(*parts, strict=True))
                out += dealt(kind, level, of, columns, 0)
            held.clear()
            return batch(out)

        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == plain:
                    yield batch([(r["kind"], r["bucket"], r["level"], r["cols"])])
                    continue
                held.setdefault((r["kind"], r["level"]), []).append([unplanes(c, "<i8") for c in r["cols"]])
                n += len(r["cols"][-1]) // 8
                if n >= held_values:
                    yield sent()
                    n = 0
        if held:
            yield sent()

    return rows.repartition("kind", "bucket", "level").mapInArrow(run, ROWS)


def together(part: pd.DataFrame) -> list[np.ndarray]:
    """The columns of a group's rows, as signed 64-bit numbers."""
    return [np.concatenate([unplanes(x, "<i8") for x in one]) for one in zip(*part["cols"], strict=True)]


def write_bucket(folder: str, name: str, columns: list[np.ndarray]) -> None:
    data = b"".join([np.array([len(columns[0])], "<i8").tobytes(), *(np.ascontiguousarray(c).tobytes() for c in columns)])
    local = local_path(folder)
    if local:
        part = f"{local}/.{name}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, f"{local}/{name}")
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    part = f"{path}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(data)
    system.move(part, f"{path}/{name}")


class Buckets:
    """Columns of a bucket by its number, mapped on first use; a missing file is an empty bucket."""

    def __init__(self, folder: str, prefix: str, kinds: list[str]):
        self.folder, self.prefix, self.kinds = folder, prefix, kinds
        self.open: OrderedDict[int, list[np.ndarray]] = OrderedDict()
        self.local = local_path(folder)
        self.held = 0

    def _raw(self, name: str) -> np.ndarray | None:
        """The file's bytes: mapped, or read where it cannot be; None without one."""
        if self.local:
            path = f"{self.local}/{name}"
            return np.memmap(path, np.uint8, "r").view(np.ndarray) if os.path.exists(path) else None
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
            return None
        with system.open_input_stream(f"{path}/{name}") as f:
            return np.frombuffer(f.read(), np.uint8)

    def __getitem__(self, bucket: int) -> list[np.ndarray]:
        found = self.open.get(bucket)
        if found is None:
            raw = self._raw(f"{self.prefix}{bucket}")
            if raw is None:
                found = [np.empty(0, k) for k in self.kinds]
            else:
                n, at, found = int(raw[:8].view("<i8")[0]), 8, []
                for k in self.kinds:
                    end = at + n * np.dtype(k).itemsize
                    found.append(raw[at:end].view(k))
                    at = end
            self.open[bucket] = found
            if not self.local:
                self.held += sum(c.nbytes for c in found)
                while self.held > HELD_BYTES and len(self.open) > 1:
                    self.held -= sum(c.nbytes for c in self.open.popitem(last=False)[1])
        elif not self.local:
            self.open.move_to_end(bucket)
        return found

    def parts(self, hashes: np.ndarray, bits: int):
        """For hashes that are sorted: (bucket's columns, slice of hashes) for each bucket they fall in."""
        of = (hashes >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield self[int(of[a])], slice(int(a), int(b))


_LAST: dict[str, Buckets] = {}


def buckets(folder: str, prefix: str, kinds: list[str]) -> Buckets:
    """The worker's Buckets; only the last table of each prefix stays open."""
    found = _LAST.get(prefix)
    if found is None or found.folder != folder:
        found = _LAST[prefix] = Buckets(folder, prefix, kinds)
    return found


def split_sorted(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted hashes fall in, and the edges between them."""
    of = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
    return of[edges[:-1]], edges


def planes(x: np.ndarray) -> bytes:
    """Bytes of the same weight together, so that Spark's compression finds the zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
