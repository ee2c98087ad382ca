"""Shared scratch folders: where lineage is cut and where staged tables are written.

A cluster names its shared folder in `spark.checkpoint.dir`. Executors may be lost at any time, so
nothing here relies on executor-local storage: data is frozen by writing it to that folder.
"""

from __future__ import annotations

import hashlib
import tempfile
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"

_local_root: dict[str, str] = {}
_staged: dict[tuple[str, str, str, str], str] = {}
_made: dict[str, list[str]] = {}


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) for any URI that Spark can read."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return bool(files.exists(at))


def listing_key(spark: SparkSession, folder: str) -> str:
    """A hash of names, sizes and times of all files and folders below a folder.

    One short text per file of the input tables is seen, never data.
    """
    files, at = _file_system(spark, folder)
    if not files.exists(at):
        return "absent"
    digest, level = hashlib.sha256(), [at]
    while level:
        below = []
        for entry in (status for path in level for status in files.listStatus(path)):
            digest.update(f"{entry.getPath()}|{entry.getLen()}|{entry.getModificationTime()};".encode())
            if entry.isDirectory():
                below.append(entry.getPath())
        level = below
    return digest.hexdigest()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host of the file system on which Spark finds it."""
    files, at = _file_system(spark, path)
    return str(files.makeQualified(at))


@dataclass(frozen=True)
class StoredFile:
    path: str
    bytes: int
    modified_ms: int


def list_files(spark: SparkSession, folder: str) -> list[StoredFile]:
    """Data files directly in a folder, by name; hidden ones and marker files are left out."""
    files, at = _file_system(spark, folder)
    found = [StoredFile(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in files.listStatus(at)
             if not s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]
    return sorted(found, key=lambda f: f.path)


def publish_file(spark: SparkSession, source: str, target: str, keep: bool = False) -> int:
    """Move a file (or copy it, if it is to be kept) to a path on the same file system, modified now; gives that
    time. Renaming keeps a file's time on some file systems and others cannot set it, so both are done."""
    files, at = _file_system(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(to.getParent())
    if keep:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(files, at, files, to, False, conf)
    elif not files.rename(at, to):
        raise OSError(f"{source} could not be moved to {target}")
    files.setTimes(to, int(time.time() * 1000), -1)
    return int(files.getFileStatus(to).getModificationTime())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of its own; it must not exist."""
    files, at = _file_system(spark, path)
    out = files.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary folder only for local masters."""
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
        app = context.applicationId
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="sparkloom-")
        root = _local_root[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other job uses (not created yet)."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of `new_dir` that no frame reads any more, such as a table of an earlier round."""
    files, at = _file_system(spark, path)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path not in made:
        raise ValueError(f"{path} was not made by this application")
    made.remove(path)
    return bool(files.delete(at, True))


def clean_scratch(spark: SparkSession) -> int:
    """Delete what this application wrote below its shared folder; gives the number of folders deleted.

    Call it when no frame made by the library is read any more, for instance before the session stops.
    """
    gone = 0
    for path in _made.pop(spark.sparkContext.applicationId, []):
        files, at = _file_system(spark, path)
        gone += bool(files.delete(at, True))
    return gone


def stage_once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Write a derived table once per application and state of the input folder; return its path.

    Changed input files and a removed copy are noticed, and the table is written again.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label, listing_key(spark, sf_dir))
    if key not in _staged or not path_exists(spark, _staged[key]):
        path = new_dir(spark, label)
        write(path)
        _staged[key] = path
    return _staged[key]


def freeze(spark: SparkSession, df, label: str):
    """Cut lineage by writing a table to the shared folder and reading it back."""
    path = new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
