"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from hashlib import sha256
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.files import delete, file_system

_LOCK = threading.Lock()
_PROBED: set[tuple[str, str]] = set()  # (application, folder) of local paths found to be shared


def _scheme(spark: SparkSession, folder: str) -> str:
    """Scheme of the file system a folder lies in, also where only the cluster's settings name it."""
    found = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", folder)
    return found[1].lower() if found else file_system(spark, folder)[1].toUri().getScheme()


def _open_folder(spark: SparkSession, folder: str) -> str:
    """The library's folder in a shared one, open to all whom that is open to, so that each user's queries have tables there."""
    path = f"{folder.rstrip('/')}/censusloom"
    fs, at = file_system(spark, path)
    if not fs.exists(at) and fs.mkdirs(at):
        with suppress(Py4JJavaError):  # of two users who make it at once only its owner may open it
            fs.setPermission(at, fs.getFileStatus(at.getParent()).getPermission())
    return path


def _local(folder: str) -> str:
    return re.sub("^file:(//)?", "", folder, flags=re.I)


def _was_there(spark: SparkSession, folder: str) -> bool:
    """Whether a folder was found shared before, or Spark made it for its own checkpoints when the application began."""
    own = spark.sparkContext.getCheckpointDir()
    return folder in {f for _, f in _PROBED} or own is not None and Path(_local(own)).is_relative_to(_local(folder))


def _all_machines_share(spark: SparkSession, folder: str) -> bool:
    """Whether what executors write to a local path of the driver is one table there.

    A mounted folder is a local path like any other, so its name does not tell. A
    row is written by each core that the cluster has by now, and all are read back:
    files that went to another machine's own disk are missing from the driver's list.
    A folder that was there and has been cleared away since is tried (again), as
    the next write makes it anew.
    """
    there = os.path.isdir(_local(folder))
    with _LOCK:
        if not there and not _was_there(spark, folder):
            return False
        key = (spark.sparkContext.applicationId, folder)
        if not there or key not in _PROBED:
            _PROBED.discard(key)
            path, n = f"{_open_folder(spark, folder)}/probe-{uuid.uuid4().hex}", spark.sparkContext.defaultParallelism
            try:
                spark.range(0, n, 1, n).write.parquet(path)
                if spark.read.schema("id bigint").parquet(path).count() == n:
                    _PROBED.add(key)
            finally:
                delete(spark, path)
        return key in _PROBED


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all machines must share.

    Without that setting a session on one machine gets a temporary folder of its
    own; on a cluster that is an error, before any work. So is a local path that is
    not the same folder on all machines: tables written there would be lost with
    their machine, and other machines would read a part of them.
    """
    local = spark.sparkContext.master.startswith("local")
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not local and _scheme(spark, folder) == "file" and not _all_machines_share(spark, folder):
            raise ValueError(f"spark.checkpoint.dir is {folder}, a folder of one machine; name one that all machines share")
        return folder
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    with _LOCK:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's tables."""
    return f"{_open_folder(spark, shared_folder(spark))}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has settled. Frames that read them can no longer be read."""
    delete(spark, run_folder(spark))


def settle(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """Write a frame that several steps read, and return it as read back.

    The large input behind it is then scanned once, a lost executor costs no
    recomputation, and Spark knows the table's real size: it broadcasts the table
    below its threshold and shuffles it above. ``under`` names another folder than
    the application's own.
    """
    spark = df.sparkSession
    path = f"{under or run_folder(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_all(frames: Mapping[str, DataFrame], manifest: Manifest | None = None) -> dict[str, DataFrame]:
    """Settle independent frames side by side, so that none waits for the others' last tasks."""
    keep = settle if manifest is None else manifest.settle
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        running = {name: pool.submit(keep, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in running.items()}


# -- runs that resume --------------------------------------------------------------------


class Manifest:
    """Settled tables of a run, found again by what the run was made of.

    The folder is named by a fingerprint, not by the application, so a run that is
    started again after its driver was lost reads the tables that were whole by
    then. A table counts as whole once its folder has its final name: it is written
    under another one and renamed, in one step of the file system. Each user has
    tables of their own.
    """

    def __init__(self, spark: SparkSession, fingerprint: str):
        self.spark, self.fingerprint = spark, fingerprint
        self.folder = f"{_open_folder(spark, shared_folder(spark))}/manifest-{spark.sparkContext.sparkUser()}/{fingerprint}"

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        fs, at = file_system(self.spark, path)
        if not fs.exists(at):
            staged = f"{self.folder}/_staged-{uuid.uuid4().hex}"
            df.write.parquet(staged)
            # Of two runs that wrote the same table at once one keeps its folder; they hold the same rows.
            if fs.exists(at) or not fs.rename(file_system(self.spark, staged)[1], at):
                delete(self.spark, staged)
        return self.spark.read.schema(df.schema).parquet(path)

    def tables(self) -> list[str]:
        """Names of the tables that are whole."""
        fs, at = file_system(self.spark, self.folder)
        names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n for n in names if not n.startswith("_"))

    def clear(self) -> None:
        delete(self.spark, self.folder)


def fingerprint(frames: Mapping[str, DataFrame | None], *more: object) -> str:
    """A digest of frames, of other values (by their repr) and of this library's code.

    A frame that reads nothing but files counts by its plan and by path, length and
    time of each file, without a scan. Any other one (rows of the driver, Python
    functions in the plan) counts by its content, in one pass over it.
    """
    code = sha256()
    root = Path(__file__).resolve().parent.parent
    for source in sorted(root.rglob("*.py")):
        if "llm" not in source.relative_to(root).parts:
            code.update(source.read_bytes())
    parts = [code.hexdigest(), *map(repr, more)]
    for name, df in sorted(frames.items()):
        parts.append(f"{name}={'none' if df is None else _by_files(df) or _by_content(df)}")
    return sha256("\n".join(parts).encode()).hexdigest()[:32]


def _by_files(df: DataFrame) -> str | None:
    spark, key = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(1 << 30))  # plans print long lists in full
    try:
        plan = df._jdf.queryExecution().analyzed()
        leaves = plan.collectLeaves()
        kinds = {leaves.apply(k).nodeName() for k in range(leaves.size())}
        text = plan.toString()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    if not all(k.startswith("Relation") or k == "LogicalRelation" for k in kinds) or re.search("Python|Pandas|Arrow|scalaudf", text, re.I):
        return None
    ids: dict[str, int] = {}
    text = re.sub(r"#(\d+)", lambda m: f"#{ids.setdefault(m[1], len(ids))}", text)
    files = []
    for path in sorted(df.inputFiles()):
        fs, at = file_system(spark, path)
        status = fs.getFileStatus(at)
        files.append(f"{path} {status.getLen()} {status.getModificationTime()}")
    return sha256("\n".join([text, df.schema.json(), *files]).encode()).hexdigest()


def _by_content(df: DataFrame) -> str:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    sums = [F.sum(f(row).cast("decimal(38,0)")) for f in (F.xxhash64, F.hash)]
    return f"{df.schema.json()} {tuple(df.agg(F.count(F.lit(1)), *sums).first())}"
