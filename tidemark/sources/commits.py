"""Appends that reach a folder of files exactly once, and publishes that do not cross.

An append with a batch id is first written whole into ``<root>/_pending/<batch id>``, closed by a note
(its row count and mark). Then its files are moved into the table's folder under names that begin with the batch
id, and the note is moved to ``<root>/_commits/<batch id>``. A replay finds the note in one of the
two places, or in neither: published, to be finished (a move that already happened is skipped), or never
published. No decision is taken by looking at the rows of a target that others write too.

Publishing into one table is serialised by a lock file, held for the catalog and rename calls only.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from ..workspace import Files

# A lock older than this belongs to a publisher that died; how long to wait for one.
STALE_LOCK_SECONDS, LOCK_WAIT_SECONDS = 6 * 3600, 1800


def pending_path(root: str, batch_id: str) -> str:
    return f"{root}/_pending/{batch_id}"


def note_path(root: str, batch_id: str) -> str:
    return f"{root}/_commits/{batch_id}"


def seal(spark: SparkSession, root: str, batch_id: str, note: str) -> None:
    """The pending folder is complete: from here on the append happens."""
    Files(spark).write(f"{pending_path(root, batch_id)}/_note", note)


def move_in(spark: SparkSession, root: str, batch_id: str, folder: str) -> None:
    """Move a sealed batch's files into ``folder`` and record it as published."""
    files, pending = Files(spark), pending_path(root, batch_id)
    for name, _ in files.data_files(pending):
        head, _, leaf = name.rpartition("/")
        files.move(f"{pending}/{name}", f"{folder}/{head + '/' if head else ''}{batch_id}-{leaf}")
    files.move(f"{pending}/_note", note_path(root, batch_id))
    files.delete(pending)


def published(spark: SparkSession, root: str, batch_id: str) -> str | None:
    return Files(spark).read(note_path(root, batch_id))


def refuse_repeat(spark: SparkSession, root: str, batch_id: str) -> None:
    """Fail if another run has appended the batch since this one asked."""
    if published(spark, root, batch_id) is not None:
        Files(spark).delete(pending_path(root, batch_id))
        raise RuntimeError(f"batch {batch_id} was appended by another run meanwhile")


def sealed(spark: SparkSession, root: str, batch_id: str) -> bool:
    return Files(spark).exists(f"{pending_path(root, batch_id)}/_note")


def forget(spark: SparkSession, root: str, batch_id: str) -> None:
    """The state has moved past the batch: its note is not needed any more."""
    Files(spark).delete(note_path(root, batch_id))


@contextmanager
def lock(spark: SparkSession, root: str):
    """One publisher at a time. The lock is a file made only if absent."""
    files, path, own = Files(spark), f"{root}/_lock", uuid.uuid4().hex
    until = time.monotonic() + LOCK_WAIT_SECONDS
    while True:
        try:
            files.write(path, own, overwrite=False)
            break
        except Exception:
            if not files.exists(path):
                if time.monotonic() > until:
                    raise
            else:
                age = time.time() - files.modified_ms(path) / 1000
                if age > STALE_LOCK_SECONDS:
                    files.delete(path)
                    continue
                if time.monotonic() > until:
                    raise TimeoutError(f"{path} is held by another publisher")
            time.sleep(0.2)
    try:
        yield
    finally:
        if files.read(path) == own:
            files.delete(path)
