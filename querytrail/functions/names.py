"""Referring to columns whose names come from the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column named exactly ``name``.

    Pivot columns are named after search terms, which may contain dots,
    spaces or backticks; quoting keeps Spark from reading ``a.b`` as a
    struct field or failing on an unpaired backtick.
    """
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores before it until no column of ``taken``
    has the name, in any case of letters."""
    used = {t.lower() for t in taken}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted
