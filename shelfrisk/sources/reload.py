"""K5: reload of several tables as one step.

A reload writes all tables into a new version folder first.  Only when every
write has committed is a manifest published: a small file with a new name,
renamed into place, so readers see all of it or none.  The tables are what the
newest manifest names; a reload that fails or is killed before that leaves the
old content of all tables, one killed after it the new content of all.  Readers
that started on the former version go on: ``keep`` versions stay.

    root/data/<version>/<table>/...       written by Spark
    root/manifests/<number>-<version>.json

Two reloads at once both publish; the greater number wins, between equal numbers
the greater version, for every reader alike.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

KEPT_VERSIONS = 2
STALE_SECONDS = 7 * 24 * 3600     # a version never published is taken for a dead reload's after this


@dataclass(frozen=True, order=True)
class Version:
    number: int
    name: str


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in seconds) of what lies in a folder."""
    where, fs = _path(spark, path)
    return [(f.getPath().getName(), f.getModificationTime() // 1000) for f in fs.listStatus(where)] if fs.exists(where) else []


def versions(spark: SparkSession, root: str) -> list[Version]:
    """Published versions, the newest first."""
    found = [n.removesuffix(".json").split("-", 1) for n, _ in _names(spark, f"{root}/manifests") if n.endswith(".json")]
    return sorted((Version(int(number), name) for number, name in found), reverse=True)


def stage(tables: dict[str, DataFrame], root: str) -> str:
    """Write every table into a new version that nothing reads yet; its name."""
    name = uuid.uuid4().hex
    for table, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/data/{name}/{table}")
    return name


def publish(spark: SparkSession, root: str, name: str, tables: list[str]) -> Version:
    """Make a staged version the current one."""
    before = versions(spark, root)
    new = Version(before[0].number + 1 if before else 1, name)
    target = f"{root}/manifests/{new.number:012d}-{name}.json"
    part, fs = _path(spark, f"{target}.part")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps({"version": name, "tables": sorted(tables)}).encode()))
    out.close()
    if not fs.rename(part, _path(spark, target)[0]):
        raise OSError(f"{target} was not published")
    return new


def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Table -> folder of the current version."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing was loaded into {root}")
    newest = found[0]
    manifest = f"{root}/manifests/{newest.number:012d}-{newest.name}.json"
    tables = spark.read.schema("version string, tables array<string>").json(manifest).first()["tables"]
    return {t: f"{root}/data/{newest.name}/{t}" for t in tables}


def read_current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(path) for t, path in current_paths(spark, root).items()}


def drop_old(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS, stale_seconds: float = STALE_SECONDS) -> list[str]:
    """Remove all but the newest ``keep`` versions, manifests first, and what
    dead reloads have left; names of the removed versions."""
    found = versions(spark, root)
    for v in found[max(1, keep):]:
        where, fs = _path(spark, f"{root}/manifests/{v.number:012d}-{v.name}.json")
        fs.delete(where, False)
    live, published = {v.name for v in found[:max(1, keep)]}, {v.name for v in found}
    gone = [n for n, at in _names(spark, f"{root}/data")
            if n not in live and (n in published or at < time.time() - stale_seconds)]
    for name in gone:
        where, fs = _path(spark, f"{root}/data/{name}")
        fs.delete(where, True)
    return gone


def reload_tables(tables: dict[str, DataFrame], root: str, keep: int = KEPT_VERSIONS) -> dict[str, DataFrame]:
    """K5: replace the content of all tables; the tables as published."""
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    publish(spark, root, stage(tables, root), list(tables))
    drop_old(spark, root, keep)
    return read_current(spark, root)
