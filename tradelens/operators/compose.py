"""Composition (U1): left-to-right application of DataFrame transforms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import TypeVar

T = TypeVar("T")


def pipe(data: T, *funcs: Callable[[T], T]) -> T:
    """``pipe(x, f, g) == g(f(x))``; with no functions returns ``x``.

    For DataFrames this is ``df.transform(f).transform(g)``: it only builds
    the logical plan, Catalyst optimises the whole chain at the action.
    """
    return reduce(lambda acc, f: f(acc), funcs, data)
