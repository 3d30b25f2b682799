"""Record paths: one spelling for every mount, prefix or relative form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT = "/data/curated"


def record_path(path: Column) -> Column:
    """The canonical ``/data/curated/...`` spelling of a record's path.

    Everything up to the first ``curated`` component (scheme, mount, relative
    prefix) is replaced by the root; empty and ``.`` components are dropped and
    ``x/..`` is resolved. Null, or a path without such a component, gives null.
    """
    tail = F.regexp_extract(F.translate(F.trim(path), "\\", "/"), r"(?:^|/)curated/+(.*)$", 1)
    resolved = F.array_join(
        F.aggregate(
            F.split(tail, "/"),
            F.expr("cast(array() as array<string>)"),
            lambda kept, part: F.when(part.isin("", "."), kept)
            .when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
            .otherwise(F.concat(kept, F.array(part))),
        ),
        "/",
    )
    dirty = tail.rlike(r"(^|/)\.{0,2}(/|$)")
    return F.when(tail != "", F.concat(F.lit(ROOT + "/"), F.when(dirty, resolved).otherwise(tail)))


def dataset_of(path: Column) -> Column:
    """The folder right below the root of a canonical record path."""
    return F.nullif(F.try_element_at(F.split(path, "/"), F.lit(4)), F.lit(""))


def subject_no(path: Column) -> Column:
    """The number after ``sub-`` in a canonical record path, as BIGINT (null if there is none)."""
    return F.nullif(F.regexp_extract(path, r"/sub-(\d+)(?:/|$)", 1), F.lit("")).try_cast("bigint")
