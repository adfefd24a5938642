"""A redo log for changes of several tables: written and removed partitions take effect together.

A change is staged first: new partitions are written to a hidden folder of their table, where no reader looks. Then the whole change
(which staged folder takes the place of which partition, and which partitions go) is written to a log file in one step; from
then on the change is decided. Applying it moves and deletes folders, each step of which may be repeated. A run that dies before
the log is there leaves the tables as they were; one that dies later is completed by the next one, which calls ``recover`` first.

One writer at a time, as the job has it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from barwright.sinks.files import write_partitions
from barwright.sources.folders import Tree, read_text, stored_keys, write_text

LOG = "_commits"
STAGED = "_staged-"


@dataclass
class Commit:
    """A change in the making. ``home`` is the table folder that keeps the log."""

    spark: SparkSession
    home: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    moves: list[tuple[str, str]] = field(default_factory=list)
    removals: list[str] = field(default_factory=list)
    staged: list[str] = field(default_factory=list)

    def stage(self, df: DataFrame, path: str, partition: str, **how) -> tuple[str, set[str]]:
        """Write the partitions of df beside the table; returns where, and their keys."""
        root = path.rstrip("/")
        place = f"{root}/{STAGED}{self.name}"
        write_partitions(df, place, partition, **how)
        keys = stored_keys(self.spark, place, partition)
        self.moves += [(f"{place}/{partition}={k}", f"{root}/{partition}={k}") for k in sorted(keys)]
        self.staged.append(place)
        return place, keys

    def remove(self, path: str, partition: str, keys: Collection[str]) -> None:
        self.removals += [f"{path.rstrip('/')}/{partition}={k}" for k in sorted(keys)]

    def finish(self) -> None:
        log = f"{self.home.rstrip('/')}/{LOG}/{self.name}.json"
        text = json.dumps({"moves": self.moves, "removals": self.removals, "staged": self.staged})
        write_text(self.spark, f"{log}.new", text)
        tree = Tree(self.spark, self.home)
        tree.move(f"{log}.new", log)  # decided
        _apply(self.spark, self.home, log, json.loads(text))


def _apply(spark: SparkSession, home: str, log: str, change: dict) -> None:
    tree = Tree(spark, home)
    for source, target in change["moves"]:
        tree.move(source, target)  # nothing to do where an earlier try moved it
    for path in [*change["removals"], *change["staged"]]:
        tree.remove(path)
    tree.remove(log)


def recover(spark: SparkSession, home: str, tables: Collection[str]) -> int:
    """Complete the decided changes of the log, then clear what undecided ones had staged; how many were completed."""
    tree = Tree(spark, home)
    done = 0
    for name in sorted(tree.names(f"{home.rstrip('/')}/{LOG}")):
        path = f"{home.rstrip('/')}/{LOG}/{name}"
        if name.endswith(".json"):
            _apply(spark, home, path, json.loads(read_text(spark, path)))
            done += 1
        else:
            tree.remove(path)
    for table in tables:
        for name in tree.names(table):
            if name.startswith(STAGED):
                tree.remove(f"{table.rstrip('/')}/{name}")
    return done
