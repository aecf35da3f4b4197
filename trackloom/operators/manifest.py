"""Manifests, path expansion and resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import basename

#: Chunks without an index come last.
NO_INDEX = 1_000_000_000


def is_raw(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(pcap|osf)$")


def is_csv(path: Column) -> Column:
    return F.lower(path).rlike(r"\.csv$")


def distinct_in_order(df: DataFrame, column: str, *, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first occurrence of every value."""
    first = Window.partitionBy(*keys, column).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def manifest_paths(manifests: DataFrame, kind: str, *, keys: Sequence[str]) -> DataFrame:
    """(keys, position, path): distinct paths of a manifest's chunks, by chunk index, then path.

    ``kind``: 'raw' or 'csv'.  A CSV manifest without chunk paths falls back to the path at its top.
    ``keys`` tell manifests apart: each is listed within its own row, without a shuffle or a sort of paths.
    """
    ok = is_raw if kind == "raw" else is_csv
    named = "lidar_pcap_path" if kind == "raw" else "lidar_csv_path"

    def listed(c: Column) -> Column:
        index = F.coalesce(c["chunk_index"], F.lit(NO_INDEX)).alias("i")
        files = F.concat(F.coalesce(c["produced_files"], F.array().cast("array<string>")), F.array(c[named], c["requested_output_path"]))
        return F.transform(F.filter(files, lambda p: p.isNotNull() & ok(p)), lambda p: F.struct(index, p.alias("path")))

    # By index, then path; of a path that comes again the first one stays, which is the one of its least index.
    paths = F.array_distinct(F.transform(F.array_sort(F.flatten(F.transform("chunks", listed))), lambda x: x["path"]))
    if kind == "csv":
        paths = F.coalesce(paths, F.array().cast("array<string>"))
        paths = F.when((F.size(paths) == 0) & F.col("lidar_csv_path").isNotNull(), F.array("lidar_csv_path")).otherwise(paths)
    return manifests.select(*keys, F.posexplode(paths).alias("_at", "path")).select(*keys, (F.col("_at") + 1).alias("position"), "path")


def session_paths(paths: DataFrame, session: str) -> DataFrame:
    """Paths of one session by their name's prefix; only if there are none, by the id anywhere in the name; else an error."""
    name = basename(F.col("path"))
    exact = paths.where(name.startswith(f"raw_lidar_{session}_"))
    if exact.isEmpty():
        exact = paths.where(name.contains(session))
        if exact.isEmpty():
            raise ValueError(f"no raw file belongs to session {session}")
    return exact


def resolve(paths: DataFrame, listing: DataFrame, *, manifest_dir: str, base_dir: str | None) -> DataFrame:
    """Adds ``resolved``: the first candidate that exists (as is, beside the manifest, in the base folder by name, under it), else the path as is; and ``found``."""
    base = F.lit(base_dir).cast("string")
    options = [F.col("path"), F.concat_ws("/", F.lit(manifest_dir), F.col("path"))]
    options += [F.when(base.isNotNull(), F.concat_ws("/", base, basename(F.col("path")))), F.when(base.isNotNull(), F.concat_ws("/", base, F.col("path")))]
    tried = paths.select(*paths.columns, F.posexplode(F.array(*options)).alias("_prio", "_candidate")).where("_candidate is not null")
    have = listing.select(F.col("path").alias("_candidate")).distinct().withColumn("_have", F.lit(True))
    hit = tried.join(have, "_candidate", "left")
    best = hit.groupBy(*paths.columns).agg(F.min_by("_candidate", F.when(F.col("_have"), F.col("_prio"))).alias("_hit"), F.max("_have").alias("_any"))
    return best.select(*paths.columns, F.when(F.col("_any"), F.col("_hit")).otherwise(F.col("path")).alias("resolved"), F.coalesce("_any", F.lit(False)).alias("found"))


def require_found(resolved: DataFrame, label: str = "inputs") -> DataFrame:
    missing = [r["path"] for r in resolved.where("not found").select("path").orderBy("path").limit(5).collect()]
    if missing:
        raise FileNotFoundError(f"missing {label}: {', '.join(missing)}")
    return resolved


def build_manifests(chunks: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """One row per session with its chunk records nested in order."""
    record = F.struct(*[c for c in chunks.columns if c not in keys])
    return chunks.groupBy(*keys).agg(F.count("*").alias("chunks_captured"), F.array_sort(F.collect_list(record)).alias("chunks"))


def produced(after: DataFrame, before: DataFrame) -> DataFrame:
    """Files that are there afterwards and were not before."""
    return after.subtract(before)


def session_rollup(fixes: DataFrame, *, keys: Sequence[str], order: str) -> DataFrame:
    """Rows written, time of the first fix and the latest fix, by arrival."""
    return fixes.groupBy(*keys).agg(F.count("*").alias("rows_written"), F.min_by("t_ns", order).alias("first_fix_time_ns"), F.max_by("t_ns", order).alias("latest_fix_time_ns"))


def taken(attempts: DataFrame, *, keys: Sequence[str], index: str = "chunk_index", returncode: str = "returncode", files: str = "produced_files", raw: bool = True, continuous: bool = True) -> DataFrame:
    """The chunks that a capture loop records: up to the first failure, that one included, or the first alone where it is not continuous.

    A timed stop ends a raw capture with a code that is not 0; with a raw file it is no failure.
    """
    stopped = F.coalesce(F.exists(files, lambda x: F.lower(x).endswith(".pcap")), F.lit(False)) if raw else F.lit(False)
    failed = (F.coalesce(returncode, F.lit(-1)) != 0) & ~stopped
    last = attempts.groupBy(*keys).agg((F.min(F.when(failed, F.col(index))) if continuous else F.min(index)).alias("_last"))
    renamed = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_last")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return attempts.join(renamed, same).where(F.col("_last").isNull() | (F.col(index) <= F.col("_last"))).select(*attempts.columns)
