"""LAS 1.4 output: a data source that writes one file a partition, and one file merged from them by offsets."""

from __future__ import annotations

import json
import os
import shutil
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import GLOBAL, commit

# The public LAS 1.4 layout with point format 6.
_HEADER, _RECORD, _SCALE = 375, 30, 0.001
_POINT = np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("intensity", "<u2"), ("returns", "u1"), ("flags", "u1"), ("class", "u1"), ("user", "u1"), ("angle", "<i2"), ("source", "<u2"), ("t", "<f8")])
#: Lists a finished output's files with their points and bounds; it is there only after all tasks have committed.
INDEX = "_las.json"
#: Bytes that a merging task copies at a time.
COPY = 8 << 20


def las_header(n: int, offsets: tuple[float, float, float], low: tuple, high: tuple, wkt: str = "") -> bytes:
    vlr = b""
    if wkt:
        body = wkt.encode() + b"\0"
        vlr = struct.pack("<H16sHH32s", 0, b"LASF_Projection", 2112, len(body), b"coordinate system") + body
    head = struct.pack("<4sHHIHH8sBB32s32sHHHII", b"LASF", 0, 16 if wkt else 0, 0, 0, 0, b"", 1, 4, b"trackloom", b"trackloom", 1, 2000, _HEADER, _HEADER + len(vlr), bool(wkt))
    head += struct.pack("<BHI5I", 6, _RECORD, 0, 0, 0, 0, 0, 0)
    head += struct.pack("<3d3d6d", *[_SCALE] * 3, *offsets, high[0], low[0], high[1], low[1], high[2], low[2])
    head += struct.pack("<QQIQ15Q", 0, 0, 0, n, n, *[0] * 14)
    return head + vlr


def las_records(x: np.ndarray, y: np.ndarray, z: np.ndarray, t: np.ndarray, offsets: tuple[float, float, float]) -> bytes:
    out = np.zeros(len(x), _POINT)
    for c, v, o in zip("xyz", (x, y, z), offsets, strict=True):
        out[c] = np.round((v - o) / _SCALE).astype(np.int64)
    out["returns"] = 0x11
    out["t"] = t
    return out.tobytes()


@dataclass
class _Part(WriterCommitMessage):
    """What a task wrote: the driver learns counts and bounds, never points."""

    name: str
    n: int
    low: tuple
    high: tuple


class _LasWriter(DataSourceArrowWriter):
    def __init__(self, path: str, offsets: tuple[float, float, float], wkt: str) -> None:
        self.path, self.offsets, self.wkt, self.attempt = path, offsets, wkt, uuid.uuid4().hex

    def _staged(self, name: str) -> str:
        return os.path.join(self.path, f".{name}.{self.attempt}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        """One valid file: a header that is filled in at the end, and records batch by batch; it stays hidden until all tasks are done."""
        os.makedirs(self.path, exist_ok=True)
        part = _Part(f"part-{uuid.uuid4().hex}.las", 0, (np.inf,) * 3, (-np.inf,) * 3)
        with open(self._staged(part.name), "wb") as f:
            f.write(las_header(0, self.offsets, (0.0,) * 3, (0.0,) * 3, self.wkt))
            for b in iterator:
                if len(b):
                    t, x, y, z = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in GLOBAL)
                    f.write(las_records(x, y, z, t / 1e9, self.offsets))
                    part.n += len(b)
                    part.low = tuple(min(u, float(v.min())) for u, v in zip(part.low, (x, y, z), strict=True))
                    part.high = tuple(max(u, float(v.max())) for u, v in zip(part.high, (x, y, z), strict=True))
            if part.n:
                f.seek(0)
                f.write(las_header(part.n, self.offsets, part.low, part.high, self.wkt))
            f.flush()
            os.fsync(f.fileno())
        return part

    def commit(self, messages: list[_Part | None]) -> None:
        """Second phase: files get their names, and the index that makes the output whole comes last."""
        parts = [m for m in messages if m is not None and m.n]
        os.makedirs(self.path, exist_ok=True)
        for m in messages:
            if m is not None:
                os.replace(self._staged(m.name), os.path.join(self.path, m.name)) if m.n else os.remove(self._staged(m.name))
        index = {"offsets": self.offsets, "wkt": self.wkt, "files": [{"name": m.name, "n": m.n, "low": m.low, "high": m.high} for m in parts]}
        commit(os.path.join(self.path, INDEX), lambda part: _dump(part, index))

    def abort(self, messages: list[_Part | None]) -> None:
        """Nothing of a failed write stays, other attempts' files included."""
        if os.path.isdir(self.path):
            for name in os.listdir(self.path):
                if name.endswith(self.attempt):
                    os.remove(os.path.join(self.path, name))
            if not os.listdir(self.path):
                os.rmdir(self.path)


def _dump(path: str, payload: dict) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(payload, f)
        f.flush()
        os.fsync(f.fileno())


class LasSink(DataSource):
    """``df.write.format("las").option("offsets", "x,y,z").option("wkt", ...).mode("append").save(folder)``: one LAS file a partition.

    The folder has to be on a file system that all machines mount.  ``append`` needs a folder without a finished output.
    """

    @classmethod
    def name(cls) -> str:
        return "las"

    def writer(self, schema, overwrite: bool) -> _LasWriter:
        path = self.options["path"].removeprefix("file:")
        missing = [c for c in GLOBAL if c not in schema.names]
        if missing:
            raise ValueError(f"las output lacks required columns: {', '.join(missing)}")
        if overwrite:
            shutil.rmtree(path, ignore_errors=True)
        elif os.path.exists(os.path.join(path, INDEX)):
            raise FileExistsError(f"{path} holds a finished las output")
        x, y, z = (float(v) for v in self.options.get("offsets", "0,0,0").split(","))
        return _LasWriter(path, (x, y, z), self.options.get("wkt", ""))


def merge_las(spark: SparkSession, folder: str, path: str) -> int:
    """One file out of a finished output: its length is known from the index, so each task copies its part to the part's own offset."""
    with open(os.path.join(folder, INDEX), encoding="utf-8") as f:
        index = json.load(f)
    files, offsets = index["files"], tuple(index["offsets"])
    total = sum(x["n"] for x in files)
    bound = lambda k, pick: tuple(pick(x[k][i] for x in files) for i in range(3)) if files else (0.0,) * 3
    head = las_header(total, offsets, bound("low", min), bound("high", max), index["wkt"])

    def join(part: str) -> int:
        with open(part, "wb") as f:
            f.write(head)
            f.truncate(len(head) + total * _RECORD)
        jobs, at = [], len(head)
        for x in files:
            jobs.append((os.path.join(folder, x["name"]), x["n"] * _RECORD, at))
            at += x["n"] * _RECORD

        def copy(batches):
            for b in batches:
                for source, size, to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    with open(source, "rb") as src, open(part, "r+b") as out:
                        src.seek(-size, os.SEEK_END)
                        out.seek(to)
                        shutil.copyfileobj(src, out, COPY)
                        out.flush()
                        os.fsync(out.fileno())
                    yield pa.RecordBatch.from_arrays([pa.array([size])], ["size"])

        if jobs:
            # A part that is copied again after a lost task lands on the same bytes.
            spread = spark.createDataFrame(jobs, "source string, size long, at long").repartition(len(jobs))
            copied = spread.mapInArrow(copy, "size long").groupBy().sum("size").first()[0]
            if copied != total * _RECORD:
                raise OSError(f"merged {copied} bytes of {total * _RECORD}")
        return total

    return commit(path, join)


def write_las(df: DataFrame, path: str, *, offsets: tuple[float, float, float], wkt: str = "") -> int:
    """One LAS file from (timestamp_ns, x_global, y_global, z_global): partitions are written in parallel in a folder that all
    machines share (beside ``path``), then copied side by side behind one header. Returns the number of points."""
    spark, parts = df.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    spark.dataSource.register(LasSink)
    try:
        df.select(*GLOBAL).write.format("las").option("offsets", ",".join(repr(float(v)) for v in offsets)).option("wkt", wkt).mode("append").save(parts)
        return merge_las(spark, parts, path)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
