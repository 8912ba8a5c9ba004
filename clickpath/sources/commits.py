"""Numbered JSON commits: a small log whose next entry only one writer can create.

An entry is written in full under a private name and then given its number by
a rename that fails if the number is taken, so readers never see half an entry
and two writers never share one.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession

from .lake import _fs_path


class CommitConflict(RuntimeError):
    """Another writer created this entry first."""


def _name(number: int) -> str:
    return f"{number:020d}.json"


def commits(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all entries."""
    fs, path = _fs_path(spark, folder)
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def latest_commit(spark: SparkSession, folder: str) -> int:
    """The newest entry's number, 0 if there is none."""
    return max(commits(spark, folder), default=0)


def read_commit(spark: SparkSession, folder: str, number: int) -> dict:
    fs, path = _fs_path(spark, f"{folder.rstrip('/')}/{_name(number)}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_commit(spark: SparkSession, folder: str, number: int, entry: dict) -> None:
    """Create entry ``number``; :class:`CommitConflict` if it exists."""
    folder = folder.rstrip("/")
    fs, final = _fs_path(spark, f"{folder}/{_name(number)}")
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{uuid.uuid4().hex}.draft")
    fs.mkdirs(final.getParent())
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entry, sort_keys=True, default=str).encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":  # the local rename overwrites; a hard link does not
            local = [jvm.org.apache.hadoop.fs.Path.getPathWithoutSchemeAndAuthority(p).toString() for p in (draft, final)]
            try:
                os.link(*local)
            except FileExistsError as e:
                raise CommitConflict(f"{folder}: entry {number} exists") from e
        elif not fs.rename(draft, final):  # on a shared store a rename onto an existing file fails
            raise CommitConflict(f"{folder}: entry {number} exists")
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
