"""Tables that appear together: staged writes and one manifest that names them all.

``publish`` writes every table to a fresh place and then renames one small manifest into sight. A reader follows the newest
manifest, so it sees all tables of one version or all of the one before; a failure between two writes leaves the old
ones readable. A version is written once: of two writers that start from the same one, the second fails. Tables may
be lists of parts, so that a new version can name old parts beside new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def versions(spark: SparkSession, folder: str) -> list[int]:
    at, files = _files(spark, f"{folder}/manifests")
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict | None:
    """The newest manifest (or a given one): ``version``, ``tables`` (name: paths of its parts) and ``info``; None before the first."""
    known = versions(spark, folder)
    if not known:
        return None
    lines = spark.read.option("wholetext", True).text(f"{folder}/manifests/{known[-1] if version is None else version:08}.json")
    return json.loads(lines.first()[0])


def stage(df: DataFrame, folder: str, write: Callable[[DataFrame, str], None] = _parquet) -> str:
    """Write a table (or a part of one) to a fresh place under ``folder``; nobody sees it until a manifest names it."""
    path = f"{folder}/data/{uuid.uuid4().hex}"
    write(df, path)
    return path


def commit(spark: SparkSession, folder: str, tables: dict[str, list[str]], info: dict | None = None, after: int = 0) -> int:
    """Make a version that names the staged tables; fails if there is one later than ``after`` already."""
    version = after + 1
    target, files = _files(spark, f"{folder}/manifests/{version:08}.json")
    staged, _ = _files(spark, f"{folder}/staged/{uuid.uuid4().hex}")
    out = files.create(staged, False)
    try:
        out.write(bytearray(json.dumps({"version": version, "tables": tables, "info": info or {}}).encode()))
    finally:
        out.close()
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(staged, target):
        files.delete(staged, False)
        raise RuntimeError(f"version {version} of {folder} exists already")
    return version


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame], info: dict | None = None, write: dict[str, Callable[[DataFrame, str], None]] | None = None) -> int:
    """Write whole tables, each by its own writer (parquet, if none is given), and make them the newest version together."""
    now = manifest(spark, folder)
    staged = {name: [stage(df, folder, (write or {}).get(name, _parquet))] for name, df in tables.items()}
    return commit(spark, folder, staged, info, now["version"] if now else 0)


def read(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    """A parquet table of the newest (or a given) version."""
    found = manifest(spark, folder, version)
    if found is None:
        raise FileNotFoundError(f"nothing published in {folder}")
    return spark.read.parquet(*found["tables"][name])


def drop_old(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions, and staged data that none of these names (of failed or running writes too)."""
    known = versions(spark, folder)
    named = {p.rpartition("/")[2] for v in known[-keep:] for paths in manifest(spark, folder, v)["tables"].values() for p in paths}
    for v in known[:-keep]:
        at, files = _files(spark, f"{folder}/manifests/{v:08}.json")
        files.delete(at, False)
    at, files = _files(spark, f"{folder}/data")
    for f in files.listStatus(at):
        if f.getPath().getName() not in named:
            files.delete(f.getPath(), True)
