"""Changes of a table's files that a lost driver cannot leave half done.

A change writes its new files below `_changes` in the table, where no reader looks, and then an intent that
names them and the files they replace. From then on the change counts: it is carried out by renames, new
files first, and the next change on the table finishes what an earlier one left. Files without an intent are
not part of the table; they are removed. A finished intent stays as an entry of the ledger.

While files are moved a reader may see old and new rows of a day together, but never too few. One writer per
table at a time, as for all writes here.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tickloom import hadoop

_ROOT = "_changes"
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.=-]*")


def _place(table: str, *parts: str) -> str:
    return "/".join((table.rstrip("/"), _ROOT, *parts))


def finish(spark: SparkSession, table: str) -> list[str]:
    """Carries out the changes that were decided but not finished; gives their ids."""
    ids = [name.removesuffix(".json") for name in hadoop.files(spark, _place(table, "intents")) if name.endswith(".json")]
    for change in ids:
        _carry_out(spark, table, change)
    for left in hadoop.folders(spark, _place(table, "new", "*")):
        hadoop.remove(spark, left)
    return ids


def is_done(spark: SparkSession, table: str, change: str) -> bool:
    return hadoop.exists(spark, _place(table, "done", f"{change}.json"))


def entry(spark: SparkSession, table: str, change: str) -> dict:
    """What the ledger says of a finished change."""
    return json.loads(hadoop.read_text(spark, _place(table, "done", f"{change}.json")))


def change_days(
    rows: DataFrame,
    table: str,
    replaced: Iterable[str] = (),
    change: str | None = None,
    note: dict | None = None,
) -> bool:
    """Adds `rows` to a day-partitioned table and takes the files of the `replaced` days away.

    `rows` may read the table. With an id for the `change` it happens once: false, and nothing done, if the
    ledger holds it. `note` goes to the ledger with the names of the files.
    """
    spark, table = rows.sparkSession, table.rstrip("/")
    once = change is not None
    change = change or uuid.uuid4().hex
    if not _ID.fullmatch(change):
        raise ValueError(f"no name for a file: {change!r}")
    finish(spark, table)
    if once and is_done(spark, table, change):
        return False
    draft = _place(table, "new", change)
    rows.write.partitionBy("dt").parquet(draft)
    # Names hold the change, so a file is never taken for another's.
    added = [
        [f"{day}/{name}", f"{day}/{change}-{name}"]
        for day in (path.rsplit("/", 1)[-1] for path in hadoop.folders(spark, f"{draft}/dt=*"))
        for name in hadoop.files(spark, f"{draft}/{day}")
    ]
    removed = [f"{day}/{name}" for day in replaced for name in hadoop.files(spark, f"{table}/{day}")]
    intent = {"added": added, "removed": removed, "note": note or {}}
    hadoop.write_text(spark, _place(table, "intents", f"{change}.json"), json.dumps(intent))
    _carry_out(spark, table, change)
    return True


def _carry_out(spark: SparkSession, table: str, change: str) -> None:
    """Every step may have been taken before."""
    table = table.rstrip("/")
    path = _place(table, "intents", f"{change}.json")
    intent = json.loads(hadoop.read_text(spark, path))
    for draft, name in intent["added"]:
        if not hadoop.move(spark, _place(table, "new", change, draft), f"{table}/{name}"):
            if not hadoop.exists(spark, f"{table}/{name}"):
                raise RuntimeError(f"{table}/{name} is neither written nor in place")
    for name in intent["removed"]:
        hadoop.remove(spark, f"{table}/{name}")
    hadoop.move(spark, path, _place(table, "done", f"{change}.json"))
    hadoop.remove(spark, _place(table, "new", change))
