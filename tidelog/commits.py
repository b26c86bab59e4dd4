"""Numbered commit files: small JSON states, each made visible at once.

A state is written under another name and renamed to ``<version>.json``; the
rename fails if that version is there, so of two writers one succeeds. Readers
take the file of the highest version. Only the driver reads and writes them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class VersionTaken(RuntimeError):
    """Another writer has committed this version."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, folder: str) -> dict | None:
    """The state of the highest version (None: there is no commit yet)."""
    at, fs = _fs(spark, folder)
    if not fs.exists(at):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    last = max((n for n in names if n.endswith(".json") and n[0].isdigit()), default=None)
    if last is None:
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{folder}/{last}").collect()))


def commit(spark: SparkSession, folder: str, version: int, state: dict) -> None:
    """Make ``state`` the state of ``version``."""
    final, fs = _fs(spark, f"{folder}/{version:020d}.json")
    draft, _ = _fs(spark, f"{folder}/_{uuid.uuid4().hex}")
    if fs.exists(final):
        raise VersionTaken(final.toString())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:       # without the overwrite option a rename fails if the file is there
        files.rename(draft, final, spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))
    except Exception as e:
        if fs.exists(final):
            raise VersionTaken(final.toString()) from e
        raise


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    at, fs = _fs(spark, path)
    fs.delete(at, True)
