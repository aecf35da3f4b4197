"""Secret scans (operator 2): an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text; historical
versions are rows like any other, told apart by their keys.  The ledger holds,
for each (blob, rule version) pair that was ever scanned, the spans found.  A run
scans only pairs that the ledger lacks - each blob once, however many paths or
versions carry it - and joins the findings of new and known pairs back to all
paths.  ``extend`` appends the new pairs to a stored ledger, a Parquet folder that
the cluster shares: what a broken run had committed is known to the next one, and
pairs that two runs appended count once.  The query and the pipeline start an
empty ledger of their own in the shared folder.

Only digests and ids are shuffled to find what need not be scanned; those rows
are kept out by broadcast while at most FEW are counted, else by a shuffle.

Rules (kinds): ``assign``, ``access`` and ``hex`` are the base; ``pem`` (private
key blocks, with headers and escaped line ends), ``jwt`` and ``url`` (credentials
in an address, with or without a user) are added; no rule bounds a length.  Spans
are code points, end exclusive, leftmost and non-overlapping within a kind.

Edge cases: a null text is the empty blob; empty texts have no findings;
repeated rows each get their own result row; texts are scanned whole.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kit
from .store import free_name, join_dealt, settle, shared_dir, small_batches

RULE_VERSION = "r1.1"
#: Rows that need no scan, up to which they are broadcast; they are counted before.
FEW = 500_000
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_HINT = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_EOL = r"(?:\\+[rn]|[\r\n])"
_PEM = re.compile(rf"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:\\+[rnt]|\s)*+[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+{_EOL})*[A-Za-z0-9+/=\s\\]*-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_URL = re.compile(r"://[^\s:/@]*+:([^\s/@]++)@", re.ASCII)
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
KINDS = (*BASE, "pem", "jwt", "url")
_FINDINGS = "array<struct<kind:string,start:bigint,end:bigint,secret_start:bigint>>"
_FINDINGS_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("start", "end", "secret_start")]]))


def _urls(text: str):
    """(start, end, start of the password) of addresses with one; schemes are read backwards, so that long runs stay linear."""
    reach = 0
    for m in _URL.finditer(text):
        at = m.start()
        while at > reach and text[at - 1] in _SCHEME:
            at -= 1
        while at < m.start() and not "a" <= text[at] <= "z":
            at += 1
        if m.start() - at >= 2:
            yield at, m.end(), m.start(1)
            reach = m.end()


def find(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself), by start, then by kind as in KINDS."""
    out = []
    low = text.lower()  # only to rule texts out
    if any(h in low for h in _HINT):
        out += [(0, m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text)]
    out += [(2, m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY" in text:
        out += [(3, m.start(), m.end(), m.start()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [(4, m.start(), m.end(), m.start()) for m in _JWT.finditer(text)]
    if "://" in text:
        out += [(5, *found) for found in _urls(text)]
    return [(KINDS[k], s, e, v) for s, k, e, v in sorted((s, k, e, v) for k, s, e, v in out)]


@F.arrow_udf(_FINDINGS_TYPE)
def _scan(text: pa.Array) -> pa.Array:
    kit.give_back()
    rows = [[{"kind": k, "start": s, "end": e, "secret_start": v} for k, s, e, v in find(t)] if t else [] for t in text.to_pylist()]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret_start", pa.int64())])
    return pa.array(rows, pa.list_(kind))


def _blob(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def scan_blobs(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, rule_version, findings): one for each blob of ``docs`` that ``ledger`` lacks."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("owner"), _blob().alias("blob"), F.coalesce("text", F.lit("")).alias("body"))
    # A blob belongs to its smallest path; other paths' rows, and those of known blobs, are not scanned.
    named = rows.select("owner", "blob")
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == rule_version).select("blob").distinct().withColumn("known", F.lit(True))
        named = named.join(known, "blob", "left")
    else:
        named = named.withColumn("known", F.lit(None).cast("boolean"))
    owners = named.groupBy("blob").agg(F.min("owner").alias("first"), F.max("owner").alias("last"), F.max("known").alias("known"), F.count("*").alias("n")).where("known or first < last")
    owners = settle(owners.drop("last"))
    skip = settle(join_dealt(rows.select("owner", "blob"), owners, "blob", "owner").where("known or owner > first").select("owner", "blob").distinct())
    todo = rows.join(F.broadcast(skip) if skip.count() <= FEW else skip, ["owner", "blob"], "left_anti")
    found = todo.select("blob", F.lit(rule_version).alias("rule_version"), _scan("body").alias("findings"))
    return settle(found).dropDuplicates(["blob", "rule_version"])


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty where there is none yet."""
    schema = f"blob string, rule_version string, findings {_FINDINGS}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def extend(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Scans what the ledger at ``path`` lacks of ``docs``, appends it there, and returns the whole ledger."""
    scan_blobs(docs, stored(docs.sparkSession, path), rule_version).write.mode("append").parquet(path)
    return stored(docs.sparkSession, path)


def _new_ledger(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"


def findings_of(docs: DataFrame, ledger: DataFrame, rule_version: str = RULE_VERSION, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, blob, findings) for every row of ``docs`` out of the ledger."""
    # Most blobs have no findings; only those that have some are joined.
    some = ledger.where((F.col("rule_version") == rule_version) & (F.size("findings") > 0)).dropDuplicates(["blob"])
    found = some.select(F.col("blob").alias("_b"), "findings")
    paths = docs.select(*keys, _blob().alias("blob"))
    return paths.join(found, F.col("blob") == F.col("_b"), "left").select(*keys, "blob", F.coalesce("findings", F.expr(f"cast(array() as {_FINDINGS})")).alias("findings"))


def scan_paths(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """(doc_id, blob, findings) for every row of ``docs``, scanning only what ``ledger`` lacks."""
    fresh = scan_blobs(docs, ledger, rule_version)
    return findings_of(docs, fresh if ledger is None else fresh.unionByName(ledger.select(*fresh.columns)), rule_version)


def report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans, and all spans; ``ledger`` is the path of a stored one."""
    found = findings_of(docs, extend(docs, ledger or _new_ledger(docs.sparkSession)))
    spans = lambda xs: F.concat_ws(",", F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(spans(F.filter("findings", lambda x: x["kind"].isin(*BASE))), 256).alias("base_sha256"),
        spans(F.col("findings")).alias("spans"),
    )


@F.arrow_udf(T.StringType())
def _redacted(text: pa.Array, findings: pa.Array) -> pa.Array:
    kit.give_back()
    out = []
    for t, found in zip(text.to_pylist(), findings.to_pylist(), strict=True):
        if t and found:
            at, kept = 0, []
            for a, b in sorted((x["secret_start"], x["end"]) for x in found):
                if b > at:
                    kept += [t[at : max(at, a)], "[REDACTED]"] if a >= at or not kept else []
                    at = b
            t = "".join(kept) + t[at:]
        out.append(t)
    return pa.array(out, pa.string())


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by a marker and ``n_chars`` following; all rows and columns stay.

    The ledger's findings come back by content address, so copies are scanned once.
    """
    found = settle(extend(docs, _new_ledger(docs.sparkSession)).where(F.size("findings") > 0).dropDuplicates(["blob"]))
    name, key, addr = free_name(docs, "findings"), free_name(docs, "b"), free_name(docs, "blob")
    spans = found.select(F.col("blob").alias(key), F.col("findings").alias(name))
    # Blobs with secrets are few, so that texts mostly stay where they are; beyond that they are shuffled once.
    if found.agg(F.coalesce(F.sum(F.size("findings") + 1), F.lit(0))).first()[0] <= FEW:
        spans = F.broadcast(spans)
    joined = docs.withColumn(addr, F.sha2(F.coalesce("text", F.lit("")), 256)).join(spans, F.col(addr) == F.col(key), "left")
    hit = F.col(name).isNotNull()
    # Python gets the texts that have findings.
    out = joined.withColumn("text", F.when(hit, _redacted(F.when(hit, F.col("text")), F.col(name))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
