"""Keyed tables in versions: an upsert writes the rows it brings, not the table.

Rows lie in hash buckets of their key, as plain partitioned Parquet. A version
is a small manifest that names, for every bucket, one base folder and the
increments on top of it; it is written last and under a new name, so a reader
sees a whole version or the one before, and a run that is broken off leaves only
folders that no manifest names. Increments of a bucket are merged into a new base
once they hold a share of its rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.operators.skew import join_unique
from vellumark.session import qualified
from vellumark.sinks.tables import upsert

BUCKETS = 32
MERGE_SHARE = 0.5  # of a bucket's rows in increments, from which it gets a new base


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(root: str, version: str) -> str:
    return f"{root}/manifests/{version}.json"


def _read_manifest(spark: SparkSession, root: str, version: str) -> dict:
    where, system = _file(spark, _manifest(root, version))
    if not system.exists(where):
        raise FileNotFoundError(f"no version {version} of {root}")
    return json.loads("".join(r["value"] for r in spark.read.text(_manifest(root, version), wholetext=True).collect()))


def _write_manifest(spark: SparkSession, root: str, version: str, content: dict) -> None:
    """All of it or nothing: written aside, then renamed to a name that nobody else has taken."""
    part, system = _file(spark, f"{root}/manifests/_{version}.part")
    with_bytes = system.create(part, True)
    with_bytes.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    with_bytes.close()
    target, _ = _file(spark, _manifest(root, version))
    if system.exists(target) or not system.rename(part, target):
        raise FileExistsError(f"version {version} of {root} is there already")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")


def _write_part(rows: DataFrame, root: str, name: str, keys: Sequence[str], buckets: int) -> dict[str, int]:
    """Write rows by bucket; how many each bucket has."""
    path = f"{root}/data/{name}"
    rows.withColumn("_bucket", _bucket(keys, buckets)).repartition(buckets, "_bucket").write.partitionBy("_bucket").parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _bucket int"
    counts = rows.sparkSession.read.schema(schema).parquet(path).groupBy("_bucket").count().collect()  # a row per bucket
    return {str(r["_bucket"]): r["count"] for r in counts}


def _rows(spark: SparkSession, root: str, content: dict, kind: str, only: Sequence[str] | None = None) -> DataFrame | None:
    """Rows of all bases or increments of a version, with `_generation`; of some buckets if `only` names them."""
    found = []
    for part in content["parts"]:
        live = [b for b in part["buckets"] if only is None or b in only]
        if part["kind"] == kind and live:
            path = f"{root}/data/{part['name']}"
            read = spark.read.schema(content["schema"]).parquet(*[f"{path}/_bucket={b}" for b in live])
            found.append(read.withColumn("_generation", F.lit(part["generation"])))
    return reduce(DataFrame.unionByName, found) if found else None


def _merged(spark: SparkSession, root: str, content: dict, only: Sequence[str] | None = None) -> DataFrame:
    """Rows of a version: of each key the newest increment, else the base."""
    keys = content["keys"]
    base, added = _rows(spark, root, content, "base", only), _rows(spark, root, content, "increment", only)
    columns = spark.createDataFrame([], content["schema"]).columns
    if added is not None:
        newest = F.max_by(F.struct(*columns), "_generation").alias("n")
        added = added.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(newest).select("n.*")
        if base is None:
            return added
        base = join_unique(base.select(*columns), added.select(*keys), keys, "left_anti")
        return base.select(*columns).unionByName(added)
    return spark.createDataFrame([], content["schema"]) if base is None else base.select(*columns)


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The table as it was when `version` was written; older versions stay readable."""
    root = qualified(spark, root)
    return _merged(spark, root, _read_manifest(spark, root, version))


def write_version(
    rows: DataFrame,
    root: str,
    version: str,
    keys: Sequence[str],
    previous: str | None = None,
    buckets: int = BUCKETS,
    merge_share: float = MERGE_SHARE,
) -> DataFrame:
    """Version `version`: `rows`, unique by `keys` (no nulls), over those of `previous`; returns the whole table.

    Only `rows` are written, and the buckets that are due for a new base.
    """
    spark = rows.sparkSession
    root = qualified(spark, root)
    keys = list(keys)
    if previous is None:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        content = {"keys": keys, "schema": schema, "buckets": buckets, "parts": []}
    else:
        content = _read_manifest(spark, root, previous)
        keys, buckets = content["keys"], content["buckets"]
        rows = rows.select(*spark.createDataFrame([], content["schema"]).columns)
    generation = 1 + max((p["generation"] for p in content["parts"]), default=0)
    kind = "increment" if previous is not None else "base"
    name = f"{version}-{uuid.uuid4().hex[:12]}"  # a broken run of this version may have left its own
    counts = _write_part(rows, root, name, keys, buckets)
    parts = [*content["parts"], {"name": name, "kind": kind, "generation": generation, "buckets": counts}]
    content = {**content, "parts": parts}

    def held(kind: str) -> dict[str, int]:
        total: dict[str, int] = {}
        for p in parts:
            if p["kind"] == kind:
                for b, n in p["buckets"].items():
                    total[b] = total.get(b, 0) + n
        return total

    base, added = held("base"), held("increment")
    due = [b for b, n in added.items() if n >= merge_share * base.get(b, 0)]
    if due:
        merged = _merged(spark, root, content, due)
        made = {"name": f"{name}-base", "kind": "base", "generation": generation + 1}
        made["buckets"] = _write_part(merged, root, made["name"], keys, buckets)
        kept = [{**p, "buckets": {b: n for b, n in p["buckets"].items() if b not in due}} for p in parts]
        content["parts"] = [p for p in kept if p["buckets"]] + [made]
    _write_manifest(spark, root, version, content)
    return _merged(spark, root, content)


def upsert_version(
    incoming: DataFrame, root: str, version: str, previous: str, mode: str = "update", order_by: str | None = None, **rules
) -> DataFrame:
    """`tables.upsert` of `incoming` into a stored table; writes the changed and new rows alone."""
    spark = incoming.sparkSession
    content = _read_manifest(spark, qualified(spark, root), previous)
    keys = content["keys"]
    sent = incoming.select(*keys).distinct()
    met = join_unique(read_version(spark, root, previous), sent, keys, "left_semi")
    if mode == "ignore":  # known rows stay as they are
        incoming = incoming.join(met.select(*keys), keys, "left_anti")
        met = met.limit(0)
    return write_version(upsert(met, incoming, keys, mode, order_by, **rules), root, version, keys, previous)
