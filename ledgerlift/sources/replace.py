"""Replacing a folder by a new one that was written beside it."""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import SparkSession

from ledgerlift.sources.scratch import _at


def write_beside(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` to a new folder next to ``path``, which takes its place once all is written.

    If the write fails, what was at ``path`` stays as it was and the new folder goes. The new folder's
    name begins with an underscore, so that Spark does not read it with its neighbours.
    """
    new = f"{_beside(path)}-new"
    try:
        write(new)
    except BaseException:
        delete_folder(spark, new)
        raise
    replace_folder(spark, new, path)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Moves the folder ``new`` to ``path``; what was there goes once the move is done.

    Two renames, cheap where a store can rename folders. If the second one fails, the first is undone.
    """
    source, files = _at(spark, new)
    target, _ = _at(spark, path)
    old, _ = _at(spark, f"{_beside(path)}-old")
    files.mkdirs(target.getParent())
    there = files.exists(target)
    if there and not files.rename(target, old):
        raise OSError(f"cannot move {path} away")
    try:
        moved = files.rename(source, target)
    except BaseException:
        _undo(files, old, target, there)
        raise
    if not moved:
        _undo(files, old, target, there)
        raise OSError(f"cannot move {new} to {path}")
    if there:
        files.delete(old, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all that is in it, if it is there."""
    folder, files = _at(spark, path)
    files.delete(folder, True)


def _undo(files, old, target, there: bool) -> None:
    if there and not files.exists(target):
        files.rename(old, target)


def _beside(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{uuid4().hex[:8]}" if parent else f"_{name}-{uuid4().hex[:8]}"
