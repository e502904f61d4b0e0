"""Columns of the two sides of a pair, named ``x0`` and ``x1``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Side:
    """One side of a pair: ``side("x")`` is its own ``x`` column, and
    ``side.across("x")`` the other side's."""

    own: str
    other: str

    def __call__(self, name: str) -> Column:
        return F.col(f"{name}{self.own}")

    def across(self, name: str) -> Column:
        return F.col(f"{name}{self.other}")


SIDES = (Side("0", "1"), Side("1", "0"))


def per_side(**build: Callable[[Side], Column]) -> dict[str, Column]:
    """``{name0: ..., name1: ...}`` for each name, in order, for
    ``withColumns``."""
    return {name + s.own: fn(s) for name, fn in build.items() for s in SIDES}
