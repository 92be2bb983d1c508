"""Moves that belong together: carried out as a whole, also when the driver is lost between two of them.

A job writes and verifies what it wants to publish beside the tables. The moves that publish it are then
written down as an intent, one small file beside every table they touch, and carried out in order. An
error puts them back. If the driver dies half way, the intent is still there: the next job on any of these
tables carries out what is left before it does anything else. Sources of later moves may stand where
earlier ones were taken away, so the last move that is done tells that all before it are.

One job at a time changes a table; readers may see a half of the moves until they are completed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from candlewright.sources import files as FS

MARK = "_intent_"


class Unsettled(OSError):
    """Moves could neither be completed nor put back; the intent stays for the next job."""


def folder_moves(origin: str, goal: str, names: list[str]) -> list[tuple[str, str]]:
    """Whole period folders from one table to another."""
    return [(f"{origin.rstrip('/')}/period={n}", f"{goal.rstrip('/')}/period={n}") for n in names]


def file_moves(spark: SparkSession, origin: str, goal: str, ending: str = ".parquet") -> list[tuple[str, str]]:
    """The data files of a folder into another folder."""
    found = [e for e in FS.listing(spark, origin) if not e.is_folder and e.name.endswith(ending) and not e.name.startswith(("_", "."))]
    return [(e.path, f"{goal.rstrip('/')}/{e.name}") for e in found]


def publish(spark: SparkSession, moves: list[tuple[str, str]], tables: list[str], spent: list[str] = ()) -> None:
    """Carry out all moves or none; in both cases the scratch folders in ``spent`` go then. ``tables`` are those the moves touch."""
    name = uuid.uuid4().hex
    files = [f"{t.rstrip('/')}{MARK}{name}.json" for t in dict.fromkeys(tables)]
    intent = {"moves": [list(m) for m in moves], "files": files, "spent": list(spent)}
    for file in files:
        FS.write_line(spark, file, json.dumps(intent))
    done: list[tuple[str, str]] = []
    try:
        for origin, goal in moves:
            FS.move(spark, origin, goal)
            done.append((origin, goal))
    except Exception as error:
        try:
            for origin, goal in reversed(done):
                FS.move(spark, goal, origin)
        except Exception as second:
            raise Unsettled(f"{type(error).__name__}, then {type(second).__name__} while putting back") from error
        _forget(spark, intent)
        raise
    _forget(spark, intent)


def _forget(spark: SparkSession, intent: dict) -> None:
    """Remove what all moves, or all of them put back, leave behind."""
    for path in [*intent["spent"], *intent["files"]]:
        FS.remove(spark, path)


def pending(spark: SparkSession, table: str) -> list[dict]:
    """Intents beside a table that a lost job has left."""
    folder, _, name = table.rstrip("/").rpartition("/")
    found = [e for e in FS.listing(spark, folder) if e.name.startswith(f"{name}{MARK}") and e.name.endswith(".json")]
    told = [FS.first_line(spark, e.path) for e in found]
    # A file that was cut short belongs to a job that had not moved anything yet.
    return [json.loads(t) for t in told if t.endswith("}")]


def recover(spark: SparkSession, *tables: str) -> int:
    """Complete what lost jobs have begun on these tables; the number of intents that were carried out."""
    carried = 0
    for table in tables:
        for intent in pending(spark, table):
            moves = [tuple(m) for m in intent["moves"]]
            there = [(FS.exists(spark, origin), FS.exists(spark, goal)) for origin, goal in moves]
            last = max((i for i, (origin, goal) in enumerate(there) if goal and not origin), default=-1)
            for origin, goal in moves[last + 1 :]:
                FS.move(spark, origin, goal)
            _forget(spark, intent)
            carried += 1
            for goal in {g.rsplit("/period=", 1)[0] for _, g in moves}:
                spark.catalog.refreshByPath(goal)
    return carried
