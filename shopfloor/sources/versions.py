"""Tables that change state at once: folders per version and one committed pointer.

A version is written to a folder of its own, which no reader looks at. The commit is one rename of
a small file to ``_commits/<version>``, which either happens or does not and fails if somebody
else has committed that number. Readers open the highest committed version. So a job that is killed
while it writes, or between writing and committing, leaves readers the last state, and a reader
that has opened a version keeps it while newer ones appear, until :func:`prune` removes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Somebody else has committed the version meanwhile."""


@dataclass(frozen=True)
class Staged:
    """A written version that is not visible yet."""

    root: str
    version: int
    folder: str
    schema: str


def _files(spark: SparkSession, root: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(context._jsc.hadoopConfiguration())
    return system, path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions in ascending order: one small file each."""
    system, path = _files(spark, root)
    folder = path(f"{root}/{COMMITS}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def stage(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> Staged:
    """Write ``df`` as the next version without showing it."""
    root = root.rstrip("/")
    version = max(versions(df.sparkSession, root), default=0) + 1
    folder = f"{version}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    return Staged(root, version, folder, df.schema.json())


def commit(spark: SparkSession, staged: Staged) -> DataFrame:
    """Show a staged version; returns a scan of it."""
    system, path = _files(spark, staged.root)
    folder = path(f"{staged.root}/{COMMITS}")
    system.mkdirs(folder)
    target = path(f"{staged.root}/{COMMITS}/{staged.version}")
    draft = path(f"{staged.root}/{COMMITS}/.{staged.folder}")
    out = system.create(draft, True)
    out.write(bytearray(json.dumps(staged.__dict__).encode()))
    out.close()
    # A rename does not replace an existing file: the first to commit a number has it.
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise CommitConflict(f"version {staged.version} of {staged.root} is taken")
    return read_version(spark, staged.root, staged.version)


def publish_version(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write and commit the next version of a table."""
    return commit(df.sparkSession, stage(df, root, partition_by))


def _commit_of(spark: SparkSession, root: str, version: int) -> Staged:
    file = f"{root}/{COMMITS}/{version}"
    return Staged(**json.loads(spark.read.text(file, wholetext=True).first()[0]))


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a committed version, the newest one unless told otherwise."""
    root = root.rstrip("/")
    known = versions(spark, root)
    version = version or max(known, default=0)
    if version not in known:
        raise FileNotFoundError(f"{root} has no committed version {version}")
    held = _commit_of(spark, root, version)
    schema = T.StructType.fromJson(json.loads(held.schema))
    return spark.read.schema(schema).parquet(f"{root}/{held.folder}")


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the ``keep`` newest versions and what was never committed.

    Run it while nobody stages. Returns the removed folders.
    """
    root = root.rstrip("/")
    system, path = _files(spark, root)
    known = versions(spark, root)
    for version in known[: max(len(known) - keep, 0)]:
        system.delete(path(f"{root}/{COMMITS}/{version}"), False)
    alive = {_commit_of(spark, root, v).folder for v in known[-keep:]}
    found = [s.getPath().getName() for s in system.listStatus(path(root))]
    gone = sorted(set(found) - alive - {COMMITS})
    for name in gone:
        system.delete(path(f"{root}/{name}"), True)
    return gone
