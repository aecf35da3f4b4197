"""Readers: fix logs, point text, manifests, listings and decoded scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import stem
from ..schema import FIX, MANIFEST, POINTS

POINT_COLUMNS = {"timestamp (ns)": "t_ns", "x1 (m)": "x1", "y1 (m)": "y1", "z1 (m)": "z1"}


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, ord, value): the lines of text files with their place in the file, however files are split."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    return raw.withColumn("ord", F.row_number().over(Window.partitionBy("file").orderBy("_b", "_m")).cast("long") - 1).select("file", "ord", "value")


def _column(header: Column, name: str) -> Column:
    return F.array_position(header, name)


def point_text(lines: DataFrame, *, check: bool = True) -> DataFrame:
    """(file, ord, t_ns, x1, y1, z1) from numbered lines: a preamble, a header that holds TIMESTAMP, then rows.

    The header may hide behind '#'; names are compared without case and blanks.
    With ``check``, a file without a header or without a needed column is an error.
    """
    is_header = F.upper("value").contains("TIMESTAMP")
    names = F.transform(F.split(F.regexp_replace("value", "^[#\\s]+", ""), ","), lambda c: F.lower(F.trim(c)))
    heads = lines.where(is_header).groupBy("file").agg(F.min("ord").alias("_at"), F.min_by(names, "ord").alias("_names"))
    files = lines.select("file").distinct().join(heads, "file", "left")
    places = {v: _column(F.col("_names"), k) for k, v in POINT_COLUMNS.items()}
    if check:
        bad = files.select("file", F.col("_at").isNull().alias("none"), *[(F.coalesce(p, F.lit(0)) == 0).alias(v) for v, p in places.items()])
        row = bad.where(" or ".join(["none", *places])).orderBy("file").first()
        if row is not None:
            lost = [k for k, v in POINT_COLUMNS.items() if row[v]]
            raise ValueError(f"{row['file']}: " + ("no header line with TIMESTAMP" if row["none"] else f"lacks required columns: {', '.join(lost)}"))
    cells = F.split("value", ",")
    rows = lines.join(heads, "file").where((F.col("ord") > F.col("_at")) & (F.trim("value") != ""))
    cell = lambda v: F.trim(F.get(cells, places[v] - 1))
    return rows.select("file", (F.col("ord") - F.col("_at") - 1).alias("ord"), cell("t_ns").try_cast("bigint").alias("t_ns"), *[cell(v).try_cast("double").alias(v) for v in ("x1", "y1", "z1")])


def fix_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A fix log with declared types (epochs are exact integers, blanks are null) and its file order in ``ord``."""
    rows = spark.read.schema(FIX).option("header", True).csv(path)
    rows = rows.select(*FIX.names, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("file").orderBy("_b", "_m")).cast("long") - 1).drop("_b", "_m")


def manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Manifest documents; unknown keys are skipped, wrong shapes become null."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def decoded_points(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Decoded scans in Parquet; the reflectivity column may be missing and is null then."""
    df = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in POINTS])


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, length) of the files that a path, folder or glob means, through the store's own interface, sorted."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for s in fs.globStatus(path) or []:
        for x in fs.listStatus(s.getPath()) if s.isDirectory() else [s]:
            if not x.isDirectory():
                out.append((x.getPath().toUri().getPath(), x.getLen()))
    return sorted(out)


def expand_raw(spark: SparkSession, inputs: Sequence[str]) -> list[str]:
    """Raw capture files of paths, folders and globs, each once, in order; an error if there are none or a file is of another kind."""
    seen: dict[str, None] = {}
    for pattern in inputs:
        found = [p for p, _ in listing(spark, pattern)]
        raw = [p for p in found if p.lower().endswith((".pcap", ".osf"))]
        if found == [pattern] and not raw:
            raise ValueError(f"not a raw capture file: {pattern}")
        seen.update(dict.fromkeys(raw))
    if not seen:
        raise FileNotFoundError(f"no raw capture files in: {', '.join(inputs)}")
    return list(seen)


def sidecars(raw: DataFrame, files: DataFrame) -> DataFrame:
    """(path, sidecar): for each raw file its metadata document: base.json, else base_0.json, else the first base*.json; null without one."""
    base = raw.select("path", F.regexp_replace("path", r"\.[^./]*$", "").alias("_base"))
    docs = files.where(F.lower("path").endswith(".json")).select(F.col("path").alias("sidecar"), F.regexp_extract("path", r"^(.*)/", 1).alias("_dir"))
    near = base.withColumn("_dir", F.regexp_extract("path", r"^(.*)/", 1)).join(docs, "_dir", "left")
    rest = F.substr("sidecar", F.length("_base") + 1)
    rank = F.when(~F.startswith("sidecar", "_base"), None).when(rest == ".json", 0).when(rest == "_0.json", 1).otherwise(2)
    return near.groupBy("path").agg(F.min(F.when(rank.isNotNull(), F.struct(rank.alias("r"), "sidecar")))["sidecar"].alias("sidecar"))


def chunk_files(files: DataFrame, requested: str) -> DataFrame:
    """Files that a requested output led to: same folder, name starting with its stem."""
    folder, name = requested.rpartition("/")[0], requested.rpartition("/")[2].rsplit(".", 1)[0]
    return files.where(F.col("path").startswith(f"{folder}/{name}")).orderBy("path")


def file_state(requests: DataFrame, files: DataFrame) -> DataFrame:
    """(path, state): ready, empty or missing."""
    have = files.select("path", F.col("length").alias("_n"))
    return requests.join(have, "path", "left").select("path", F.when(F.col("_n") > 0, "ready").when(F.col("_n") == 0, "empty").otherwise("missing").alias("state"))


def frame_bytes(buffer: bytearray, limit: int = 4096, tails: tuple[int, int] = (256, 512)) -> str | None:
    """Next sentence out of a byte buffer, which is shortened by what was used; None until a whole one is there.

    Bytes before a '$' are noise; a buffer beyond the limit keeps its tail only.
    """
    start = buffer.find(b"$")
    if start < 0:
        if len(buffer) > limit:
            del buffer[: -tails[0]]
        return None
    end = buffer.find(b"\n", start)
    if end < 0:
        del buffer[:start]
        if len(buffer) > limit:
            del buffer[: -tails[1]]
        return None
    line = bytes(buffer[start:end])
    del buffer[: end + 1]
    return line.decode("ascii", "ignore").strip()


def byte_count(high: int, low: int, most: int = 8192) -> int:
    """A device's 16-bit count; counts beyond ``most`` come with their bytes swapped."""
    n = (high << 8) | low
    return n if n <= most else (low << 8) | high


def raw_scan_source(name: str, decode: Callable[[str], Iterator[tuple]]) -> type[DataSource]:
    """A data source whose reader runs a caller's decoder on each file; register it with ``spark.dataSource.register``.

    ``decode(path)`` yields tuples in the order of the decoded-point schema.
    """

    class File(InputPartition):
        def __init__(self, path: str) -> None:
            self.path = path

    class Reader(DataSourceReader):
        def __init__(self, paths: list[str]) -> None:
            self.paths = paths

        def partitions(self):
            return [File(p) for p in self.paths]

        def read(self, partition):
            return decode(partition.path)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self):
            return POINTS

        def reader(self, schema):
            return Reader(self.options["paths"].split(","))

    return Source


__all__ = ["byte_count", "chunk_files", "decoded_points", "expand_raw", "file_state", "fix_log", "frame_bytes", "listing", "manifest", "numbered_lines", "point_text", "raw_scan_source", "sidecars", "stem"]
