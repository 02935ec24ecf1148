"""Ordered folds in the JVM: a state machine over a sorted array, for rules that no window frame can express.

Callers cut a key's history first where its state is known whatever came before, so an array holds what depends on each
other and no more. What a fold gives is gathered CHUNK items at a time, so long arrays aren't copied item by item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def ordered_fold(items: Column, start: Column, step: Callable[[Column, Column], Column], give: Callable[[Column, Column], Column], kind: str) -> Column:
    """What give(state, item) returns that isn't null (of type kind), in order; each item turns the state to step(state, item)."""
    none = F.array().cast(f"array<{kind}>")
    both = lambda state, out: F.struct(state.alias("state"), out.alias("out"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda i: F.slice(items, i * CHUNK + 1, F.lit(CHUNK)))

    def one(acc: Column, item: Column) -> Column:
        given = F.filter(F.array(give(acc.state, item)), lambda x: x.isNotNull())
        return both(step(acc.state, item), F.concat(acc.out, given))

    def some(acc: Column, chunk: Column) -> Column:
        folded = F.aggregate(chunk, both(acc.state, none), one)
        return F.transform(F.array(folded), lambda x: both(x.state, F.concat(acc.out, x.out)))[0]  # folded once

    return F.aggregate(chunks, both(start, none), some).out
