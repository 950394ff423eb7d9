"""Small helpers for naming columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def any_null(names: Iterable[str]) -> Column:
    condition = F.lit(False)
    for name in names:
        condition = condition | quoted(name).isNull()
    return condition
