"""Vectorised Python functions that need no session when a module is imported."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Results that a task keeps for values that come again.
KNOWN = 16_384


def mapped(function: Callable, returns: str, *columns: Column | str) -> Column:
    """function of the values of each row, once per distinct text within a batch.

    A null in the first column gives null without a call.
    """
    if returns.startswith("struct"):
        # a list of one or none, since a struct from Python is never null itself
        boxed = mapped(lambda *row: [x] if (x := function(*row)) is not None else [], f"array<{returns}>", *columns)
        return F.try_element_at(boxed, F.lit(1))

    def run(*args: pd.Series) -> pd.Series:
        if len(args) == 1:
            known: dict = {}
            out = []
            for x in args[0]:
                if x is None or not isinstance(x, (str, bytes)):
                    out.append(None if x is None else function(x))
                    continue
                if x not in known:
                    known[x] = function(x)
                out.append(known[x])
        else:
            out = [None if row[0] is None else function(*row) for row in zip(*args, strict=True)]
        return pd.Series(out, index=args[0].index, dtype=object)

    return F.pandas_udf(run, returns)(*[F.col(c) if isinstance(c, str) else c for c in columns])


def looked_up(function: Callable[[str], str]) -> Callable[[str | None], str | None]:
    """The function, but a value among the last ones is looked up; null for what is no text."""
    known: dict[str, str] = {}

    def one(x: str | None) -> str | None:
        if not isinstance(x, str):
            return None
        if (done := known.get(x)) is None:
            if len(known) >= KNOWN:
                known.clear()
            done = known[x] = function(x)
        return done

    return one


def prepared(make: Callable[[], Callable[[str], str]], returns: str, column: Column | str) -> Column:
    """The function that make gives once per task, of each text; a value among the last ones is looked up.

    A null gives null without a call.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = looked_up(make())
        for batch in batches:
            yield pd.Series([one(x) for x in batch], index=batch.index, dtype=object)

    return F.pandas_udf(run, returns)(F.col(column) if isinstance(column, str) else column)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]
