"""Where tidemark keeps its own files: staging, table versions, state, run history.

Durable files belong under ``spark.tidemark.root``. Where that is unset they go below the
shared folder the cluster names in ``spark.checkpoint.dir``, which every executor reads; such a
folder may be cleaned by its owner, so set the root for tables meant to stay. Nothing is
kept in a machine-local folder of a cluster: without either setting a run fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder configured for the session, or ``None`` when unset."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    sc_dir = spark.sparkContext.getCheckpointDir()
    return sc_dir.rstrip("/") if sc_dir else None


def shared_root(spark: SparkSession) -> str:
    """Root for tidemark's files; fails when the session names no shared folder."""
    own = spark.conf.get("spark.tidemark.root", None)
    if own:
        return own.rstrip("/")
    root = checkpoint_dir(spark)
    if root is None:
        raise RuntimeError(
            "neither spark.tidemark.root nor spark.checkpoint.dir is set: tidemark needs a shared "
            "folder (HDFS/object store) for staging, table versions and state"
        )
    return f"{root}/tidemark"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root (nothing is created until written)."""
    return f"{shared_root(spark)}/{name}/{uuid.uuid4().hex}"


class Files:
    """The few file-system calls of publishing, through the Hadoop API (any store Spark reaches)."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def make_folder(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def move(self, source: str, target: str) -> None:
        """One file to a place that may exist already (then an earlier attempt moved it)."""
        fs, p = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to) and not fs.exists(to):
            raise OSError(f"could not move {source} to {target}")

    def move_folder(self, source: str, target: str) -> bool:
        """A whole folder, in place of what an earlier attempt may have left there; ``False`` if the file system can't."""
        fs, p = self._at(source)
        to_fs, to = self._at(target)
        if not fs.exists(p) or fs.getUri().toString() != to_fs.getUri().toString():
            return False
        fs.delete(to, True)
        fs.mkdirs(to.getParent())
        return fs.rename(p, to)

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        """A small text file; without ``overwrite`` it fails if the file exists (an atomic claim on
        file systems whose create is atomic)."""
        fs, p = self._at(path)
        out = fs.create(p, overwrite)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def modified_ms(self, path: str) -> int:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getModificationTime()

    def names(self, path: str) -> list[str]:
        """Names of the files directly in ``path``."""
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []

    def folders(self, path: str) -> list[str]:
        """Names of the folders directly in ``path``."""
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def data_files(self, path: str) -> list[tuple[str, int]]:
        """``(path relative to the folder, bytes)`` of every data file below it, sorted."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        base = fs.resolvePath(p).toUri().getPath().rstrip("/") + "/"
        found, walk = [], fs.listFiles(p, True)
        while walk.hasNext():
            status = walk.next()
            name = status.getPath().toUri().getPath()
            name = name[len(base):] if name.startswith(base) else name
            if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
                found.append((name, status.getLen()))
        return sorted(found)
