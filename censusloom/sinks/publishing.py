"""Replacing a partitioned table without a moment in which neither the old nor the new one is whole.

New files are written under ``_staged-<id>`` inside the table's folder, where readers of Spark do not look. A write
that fails leaves the table as it was. When all files are there, a journal ``_commit-<id>`` names the partitions to
replace and to drop; then each old partition is renamed out of the way and the new one into its place. A run that dies
between two renames is finished by the next one (or by ``recover``): every step can be repeated. Where a rename is one
step of the file system (HDFS, a shared file system) each partition is whole at any time, old or new; on an object store
a rename copies, and a reader may see a part of it. One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from censusloom.files import file_system

STAGED, JOURNAL, REPLACED = "_staged-", "_commit-", "_replaced-"


def _names(fs, folder) -> list[str]:
    return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []


def _child(spark: SparkSession, folder, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder, name)


def _write_text(spark: SparkSession, fs, path, text: str) -> None:
    """A file that is there as a whole or not at all."""
    first = _child(spark, path.getParent(), "_" + path.getName())
    stream = fs.create(first, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(first, path):
        raise OSError(f"cannot write {path}")


def _read_text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _commit(spark: SparkSession, fs, root, journal: str) -> None:
    """Does what a journal says; done steps are passed over."""
    work = json.loads(_read_text(spark, fs, _child(spark, root, journal)))
    key = journal.removeprefix(JOURNAL)
    staged, replaced = _child(spark, root, STAGED + key), _child(spark, root, REPLACED + key)
    fs.mkdirs(replaced)
    for name in work["drop"] + work["put"]:
        target, new = _child(spark, root, name), _child(spark, staged, name)
        if name in work["put"] and not fs.exists(new):
            continue  # in its place since an earlier try
        if fs.exists(target) and not fs.rename(target, _child(spark, replaced, name)):
            raise OSError(f"cannot move {target}")
        if name in work["put"] and not fs.rename(new, target):
            raise OSError(f"cannot move {new}")
    fs.create(_child(spark, root, "_SUCCESS"), True).close()
    fs.delete(_child(spark, root, journal), False)
    for folder in (staged, replaced):
        fs.delete(folder, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement whose writer died, and remove what a failed write has left."""
    fs, root = file_system(spark, path)
    for name in _names(fs, root):
        if name.startswith(JOURNAL):
            _commit(spark, fs, root, name)
    for name in _names(fs, root):
        if name.startswith((STAGED, REPLACED, "_" + JOURNAL)):
            fs.delete(_child(spark, root, name), True)


def publish(df: DataFrame, path: str, partition: str, replace: bool = True, rows_per_file: int = 0) -> str:
    """Write a frame as parquet partitioned by a column, in place of what is there.

    ``replace`` drops partitions that the frame does not have; without it they stay, so a run over one year rewrites
    one partition.
    """
    spark = df.sparkSession
    recover(spark, path)
    fs, root = file_system(spark, path)
    key = uuid.uuid4().hex
    staged = _child(spark, root, STAGED + key)
    try:
        df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(partition).parquet(str(staged.toString()))
    except Exception:
        fs.delete(staged, True)
        raise
    mine = lambda folder: [n for n in _names(fs, folder) if n.startswith(f"{partition}=")]
    put = mine(staged)
    drop = [n for n in mine(root) if n not in put] if replace else []
    _write_text(spark, fs, _child(spark, root, JOURNAL + key), json.dumps({"put": put, "drop": drop}))
    _commit(spark, fs, root, JOURNAL + key)
    return path
