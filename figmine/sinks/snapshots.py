"""Versions of an output, each written whole before a reader can see it.

A version's data lies in a folder of its own.  It counts once a small commit file, numbered and
moved into place by one rename, names it; readers follow the commit file with the highest number.  So a
write that fails, at any moment, leaves the version before as it was, and folders that no commit names are never read.
A commit whose number was taken meanwhile by another writer is an error, and its data goes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from figmine.sinks.shared import remove


class Conflict(RuntimeError):
    """Another writer has committed this version first."""


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _store(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none where there is no folder."""
    fs, target = _store(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, target = _store(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, f"{root}/commits") if n.endswith(".json") and not n.startswith(("_", "."))]


def commit_path(root: str, version: int) -> str:
    return f"{root}/commits/{version:012d}.json"


def publish(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Make ``content`` the commit file of a version: written beside its place, then renamed."""
    temporary, place = f"{root}/commits/.{uuid.uuid4().hex}", commit_path(root, version)
    fs, source = _store(spark, temporary)
    fs.mkdirs(source.getParent())
    stream = fs.create(source)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    _, target = _store(spark, place)
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, False)
        raise Conflict(place)


def latest(spark: SparkSession, root: str) -> dict | None:
    """The content of the last commit, or None where nothing is committed."""
    known = versions(spark, root)
    return json.loads(_read(spark, commit_path(root, known[-1]))) if known else None


def write(spark: SparkSession, root: str, writer: Callable[[str], None], keep: int = 2, note: Callable[[], dict] = dict) -> int:
    """Call ``writer`` with the folder of a new version, then commit it; the number of the version.  What
    ``note`` returns once the data is written goes into the commit file.

    If it fails, its folder goes, the error is passed on and the last version stays.  The last ``keep`` versions
    stay (so that who reads the one before can end), older ones are deleted once the new one is committed; 0: all stay."""
    known = versions(spark, root)
    version = (known[-1] if known else 0) + 1
    data = f"data/v{version:012d}-{uuid.uuid4().hex}"
    try:
        writer(f"{root}/{data}")
        publish(spark, root, version, {"data": data, **note()})
    except BaseException:
        remove(spark, f"{root}/{data}")
        raise
    for old in known[: len(known) + 1 - keep] if keep else []:
        gone = json.loads(_read(spark, commit_path(root, old))).get("data")
        remove(spark, commit_path(root, old))
        if gone:
            remove(spark, f"{root}/{gone}")
    return version


def folder(spark: SparkSession, root: str) -> str | None:
    """The folder of the last committed version."""
    last = latest(spark, root)
    return None if last is None else f"{root}/{last['data']}"


def folders(spark: SparkSession, root: str) -> list[str]:
    """The folders of all committed versions, in order (for outputs whose versions add up)."""
    return [f"{root}/{json.loads(_read(spark, commit_path(root, v)))['data']}" for v in versions(spark, root)]


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Delete data folders that no commit names: what stopped writers have left.  Only while no one writes."""
    named = {f.rsplit("/", 1)[1] for f in folders(spark, root)}
    lost = [n for n in names(spark, f"{root}/data") if n not in named]
    for n in lost:
        remove(spark, f"{root}/data/{n}")
    return lost
