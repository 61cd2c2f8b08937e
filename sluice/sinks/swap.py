"""Replacing the files of a slice so that a failure at any moment loses nothing.

The new files are written to a folder of their own beside the slice, under ``_incoming``, which
readers and partition discovery pass over.  Only when they are complete, a note under ``_swaps`` says
that they are what the slice shall hold: from then on the new files count, before that the old ones.
The old files are removed, the new ones take their place, and the note goes.

* Failure before the note: the slice is as it was; what was written is removed with the next publish.
* Failure after the note: readers of the library take the new files where they are, and the next publish
  of the slice, or :func:`finish`, ends the move first.

A slice has one publisher at a time.  With a ``prefix`` only the files of that name are replaced, so an append that is
repeated takes the place of its first try.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from sluice.paths import join_path
from sluice.sinks.store import Store

#: Folders beside the slices of a table; names with ``_`` are no partitions.
INCOMING, SWAPS = "_incoming", "_swaps"


class UnfinishedSwap(RuntimeError):
    """A publish stopped while it moved its files; publishing again, or ``finish``, ends it."""


def _note(table: str, slice_name: str, step: str) -> str:
    return join_path(table, SWAPS, f"{slice_name}.{step}")


def incoming_folder(table: str, slice_name: str) -> str:
    """A new folder to write a slice to."""
    return join_path(table, INCOMING, f"{slice_name}.{uuid.uuid4().hex}")


def _clear(store: Store, target: str, prefix: str) -> None:
    if not prefix:
        store.delete(target)
        return
    for name in store.files(target):
        if name.rsplit("/", 1)[-1].startswith(prefix):
            store.delete(join_path(target, name))


def _fill(store: Store, incoming: str, target: str, prefix: str) -> None:
    if not store.exists(incoming):
        return
    if not prefix and not store.exists(target):
        store.rename(incoming, target)
        return
    for name in store.files(incoming):
        folder, _, leaf = name.rpartition("/")
        if leaf.startswith(("_", ".")):
            continue
        to = join_path(target, folder, prefix + leaf)
        store.delete(to)
        store.rename(join_path(incoming, name), to)
    store.delete(incoming)


def finish(spark: SparkSession, table: str, slice_name: str) -> bool:
    """End a move that was begun; says whether there was one."""
    store = Store(spark)
    begun, filling = (_note(table, slice_name, step) for step in ("begun", "filling"))
    note = store.text(begun)
    if note is None:
        store.delete(filling)
        return False
    move = json.loads(note)
    target = join_path(table, slice_name)
    if not store.exists(filling):
        _clear(store, target, move["prefix"])
        store.put(filling, "")
    _fill(store, move["incoming"], target, move["prefix"])
    # In this order: a note of filling alone means nothing.
    store.delete(begun)
    store.delete(filling)
    return True


def swap_in(spark: SparkSession, table: str, slice_name: str, incoming: str, prefix: str = "") -> None:
    """Make the complete files in ``incoming`` the slice, or those of its files that start with ``prefix``."""
    Store(spark).put(_note(table, slice_name, "begun"), json.dumps({"incoming": incoming, "prefix": prefix}))
    finish(spark, table, slice_name)


def drop_leftovers(spark: SparkSession, table: str, slice_name: str) -> None:
    """Remove what earlier publishes of the slice wrote and did not finish."""
    store = Store(spark)
    folder = join_path(table, INCOMING)
    names = {name.split("/", 1)[0] for name in store.files(folder)}
    for name in names:
        if name.rpartition(".")[0] == slice_name:
            store.delete(join_path(folder, name))


def readable_folder(spark: SparkSession, table: str, slice_name: str) -> str:
    """Where the whole slice can be read now: its own folder, or the new files if their move has not begun to fill it."""
    store, target = Store(spark), join_path(table, slice_name)
    note = store.text(_note(table, slice_name, "begun"))
    if note is None:
        return target
    move = json.loads(note)
    if not store.exists(move["incoming"]):
        return target
    if move["prefix"] or store.exists(_note(table, slice_name, "filling")) and store.exists(target):
        raise UnfinishedSwap(f"the move of {slice_name} in {table} has not ended")
    return move["incoming"]
