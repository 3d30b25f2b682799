"""Entities and predicates of the recording layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITIES = ("sub", "ses", "task", "run")


def stem(path: Column) -> Column:
    """The file name of a path without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def parent_dir(path: Column) -> Column:
    """The path up to its last slash."""
    return F.regexp_replace(path, r"/[^/]*$", "")


def entities(name: Column) -> dict[str, Column]:
    """The entities of a file stem; the last match of each wins, a missing one is null."""
    parts = F.split(F.replace(name, F.lit("_eeg"), F.lit("")), "_")

    def last(entity: str) -> Column:
        hits = F.filter(parts, lambda part: F.startswith(part, F.lit(f"{entity}-")))
        return F.when(F.size(hits) > 0, F.substring(F.element_at(hits, -1), len(entity) + 2, 1 << 20))

    return {entity: last(entity) for entity in ENTITIES}


def component_after(path: Column, root: str) -> Column:
    """The path component right behind the first one equal to ``root``; ``unknown`` if there is none."""
    parts = F.split(path, "/")
    at = F.array_position(parts, root)
    return F.coalesce(F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int"))), F.lit("unknown"))


def is_preprocessed(path: Column) -> Column:
    """Whether a path lies in a layout of preprocessed derivatives."""
    return F.contains(path, F.lit("derivatives")) & F.contains(path, F.lit("preprocessing"))


def record_key(path: Column) -> Column:
    """The key of a recording: its full path without the extension, so equal stems of two releases stay apart."""
    return F.concat(parent_dir(path), F.lit("/"), stem(path))
