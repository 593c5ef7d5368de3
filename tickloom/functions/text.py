"""Text clean-up and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_blanks(text: Column) -> Column:
    """Joins the lines of a document and drops every ASCII blank, also inside strings.

    Tabs stay.
    """
    return F.translate(text, "\r\n ", "")


def to_double(text: Column) -> Column:
    """Text to double; null instead of an error, whatever the ANSI setting."""
    return text.try_cast("double")


def whole_number(text: Column) -> Column:
    """Text to a whole number, a decimal fraction cut off; null for anything else."""
    whole = F.regexp_replace(text, r"^(\s*[+-]?)(\d*)\.\d*(\s*)$", "$10$2")
    return whole.try_cast("bigint")


def last_wins(entries: Column) -> Column:
    """A parsed JSON map in which the last of several equal keys is the one kept.

    A map without repeated keys, the usual case, is passed on as it is.
    """
    keys = F.map_keys(entries)
    # Later entries sort first within a key; the first of each key is kept.
    ranked = F.array_sort(
        F.transform(
            F.map_entries(entries),
            lambda entry, at: F.struct(
                entry["key"].alias("key"), (-at).alias("back"), entry["value"].alias("value")
            ),
        )
    )
    kept = F.transform(
        F.array(ranked),
        lambda rows: F.filter(
            rows, lambda row, at: (at == 0) | (rows[at - 1]["key"] != row["key"])
        ),
    )[0]
    unique = F.map_from_entries(
        F.transform(kept, lambda row: F.struct(row["key"], row["value"]))
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(unique)
