"""Versions of a store: which files of which runs belong to it, published one by one.

A version is one small file, ``_versions/<number>``, with a line of JSON per run: its
name, its files, and how many rows they hold.  It comes into being whole or not at all,
and only if no other writer has published that number.  So a run that failed its check
or was cut in half belongs to no version and no reader sees it, and an older version
reads the same files for ever.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"
_DIGITS = 12


@dataclass(frozen=True)
class RunFiles:
    """One run of a store; ``files`` and ``keys`` are paths below the store's folder."""

    run: str
    files: tuple[str, ...]
    rows: int
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Version:
    number: int
    runs: tuple[RunFiles, ...]

    def with_run(self, added: RunFiles) -> Version:
        """The next version: a run of the same name is replaced."""
        kept = tuple(r for r in self.runs if r.run != added.run)
        return Version(self.number + 1, (*kept, added))

    def since(self, older: Version) -> tuple[RunFiles, ...]:
        """Runs, or tries of runs, that the older version does not have."""
        known = set(older.runs)
        return tuple(r for r in self.runs if r not in known)


class LostRace(RuntimeError):
    """Another writer has published this version's number."""


def _path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _name(store: str, number: int) -> str:
    return f"{store}/{FOLDER}/{number:0{_DIGITS}d}"


def latest_number(spark: SparkSession, store: str) -> int | None:
    """The newest version's number, or None where the store has no versions."""
    folder = _path(spark, f"{store}/{FOLDER}")
    files = _files(spark, folder)
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = [int(name) for name in names if name.isdigit()]
    return max(numbers, default=None)


def read_version(spark: SparkSession, store: str, number: int | None = None) -> Version | None:
    """A version, the newest by default; None where the store has none at all."""
    if number is None:
        number = latest_number(spark, store)
        if number is None:
            return None
    path = _path(spark, _name(store, number))
    files = _files(spark, path)
    if not files.exists(path):
        raise ValueError(f"the store has no version {number}")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    runs = []
    for line in text.splitlines():
        told = json.loads(line)
        runs.append(RunFiles(told["run"], tuple(told["files"]), told["rows"], tuple(told["keys"])))
    return Version(number, tuple(runs))


def publish(spark: SparkSession, store: str, version: Version) -> None:
    """Make a version visible, whole, in one step; :class:`LostRace` if its number is taken.

    The file is written under another name and then gets its own, which fails where that
    exists.  On a local disk a hard link does that; elsewhere a rename without overwriting,
    as HDFS and stores with atomic renames give it.
    """
    text = "".join(json.dumps(asdict(run)) + "\n" for run in version.runs)
    target = _path(spark, _name(store, version.number))
    draft = _path(spark, f"{store}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    files = _files(spark, draft)
    stream = files.create(draft, False)
    stream.write(text.encode())
    stream.close()
    try:
        if files.getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            _rename_new(spark, draft, target)
    except FileExistsError:
        raise LostRace(f"version {version.number} exists") from None
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise LostRace(f"version {version.number} exists") from None
        raise
    finally:
        files.delete(draft, False)


def _rename_new(spark: SparkSession, draft: JavaObject, target: JavaObject) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft), context.makeQualified(target), how)


def written_files(spark: SparkSession, store: str, folder: str) -> tuple[str, ...]:
    """Files below a folder of the store, as paths below the store; hidden ones are no data."""
    top = _path(spark, f"{store}/{folder}")
    files = _files(spark, top)
    base = files.makeQualified(top).toUri().getPath().rstrip("/") + "/"
    found = []
    each = files.listFiles(top, True)
    while each.hasNext():
        inner = each.next().getPath().toUri().getPath().removeprefix(base)
        if not any(part.startswith(("_", ".")) for part in inner.split("/")):
            found.append(f"{folder}/{inner}")
    return tuple(sorted(found))


def run_folders(spark: SparkSession, store: str) -> list[str]:
    """Names of the runs that have a folder, published or not."""
    top = _path(spark, store)
    files = _files(spark, top)
    if not files.exists(top):
        return []
    names = [status.getPath().getName() for status in files.listStatus(top)]
    return sorted(name.removeprefix("run=") for name in names if name.startswith("run="))


def discard(spark: SparkSession, store: str, folder: str) -> None:
    """Delete a try that no version names."""
    path = _path(spark, f"{store}/{folder}")
    _files(spark, path).delete(path, True)


def full_paths(store: str, inner: Sequence[str]) -> list[str]:
    return [f"{store}/{one}" for one in inner]
