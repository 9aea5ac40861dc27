"""Numbered manifests of model versions: each commit is a compare-and-set on the last one."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

TRIES = 100


class Stale(RuntimeError):
    """What a commit was based on is no longer so."""


@dataclass(frozen=True)
class Version:
    """A complete set of models; `parent` was the champion when it was committed.

    `rows`, `since` and `until` tell what feature table it was trained on.
    """

    version: int
    entries: str
    trained_at: str
    rows: int = 0
    since: str | None = None
    until: str | None = None
    parent: int | None = None


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    versions: tuple[Version, ...] = ()
    champion: int | None = None

    def newest(self) -> int | None:
        return max((v.version for v in self.versions), default=None)

    def with_version(self, new: Version) -> Manifest:
        """A version that is listed already is replaced and keeps its parent; the first one is champion."""
        before = next((v for v in self.versions if v.version == new.version), None)
        parent = self.champion if before is None else before.parent
        kept = [v for v in self.versions if v.version != new.version]
        listed = sorted([*kept, replace(new, parent=parent)], key=lambda v: v.version)
        champion = new.version if self.champion is None else self.champion
        return replace(self, versions=tuple(listed), champion=champion)


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _at(spark, path)
    return fs.exists(folder)


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The last manifest; an empty one before the first commit."""
    fs, folder = _at(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return Manifest()
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    last = max((n for n in names if n.endswith(".json")), default=None)
    if last is None:
        return Manifest()
    stored = json.loads(spark.read.text(f"{root}/manifest/{last}", wholetext=True).first()[0])
    return Manifest(stored["number"], tuple(Version(**v) for v in stored["versions"]), stored["champion"])


def put_manifest(spark: SparkSession, root: str, manifest: Manifest) -> bool:
    """Writes a manifest under its number, whole or not at all; False if that number is taken."""
    name = f"{root}/manifest/{manifest.number:012d}.json"
    draft = f"{root}/manifest/_{uuid.uuid4().hex}"
    fs, path = _at(spark, draft)
    out = fs.create(path, False)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    try:
        return _move(spark, draft, name)
    finally:
        fs.delete(path, False)


def commit(spark: SparkSession, root: str, change: Callable[[Manifest], Manifest]) -> Manifest:
    """Applies `change` to the last manifest and publishes the result under the next number.

    Whoever comes second reads what the first has published and applies the change to that.
    """
    for _ in range(TRIES):
        now = read_manifest(spark, root)
        wanted = replace(change(now), number=now.number + 1)
        if put_manifest(spark, root, wanted):
            return wanted
    raise Stale(f"no manifest number was free in {TRIES} tries")


def promote(spark: SparkSession, root: str, version: int, instead_of: int | None) -> Manifest:
    """Makes a listed version champion, unless another than `instead_of` has become it."""

    def change(now: Manifest) -> Manifest:
        if now.champion != instead_of:
            raise Stale(f"champion is {now.champion}, not {instead_of}")
        if version not in [v.version for v in now.versions]:
            raise ValueError(f"version {version} is not listed")
        return replace(now, champion=version)

    return commit(spark, root, change)


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a file its name if that is free, as one step.

    The rename of a distributed file system is such a step; that of a local one looks first and
    moves then, so there the name is linked.
    """
    fs, _ = _at(spark, target)
    return (_linked if fs.getUri().getScheme() == "file" else _renamed)(spark, source, target)


def _linked(spark: SparkSession, source: str, target: str) -> bool:
    try:
        os.link(_local(source), _local(target))
    except FileExistsError:
        return False
    return True


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    fs, to = _at(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(hadoop.Path(source), to, plain)
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in str(problem.java_exception):
            return False
        raise
    return True


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path
