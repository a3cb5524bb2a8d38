"""Frame selection on a timeline of integer frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NONE = "array<int>"


def _upto(first: Column, end: Column) -> Column:
    """first, ..., end - 1; empty if there are none (a plain sequence would count down)."""
    return F.when(end > first, F.sequence(first.cast("int"), (end - 1).cast("int"))).otherwise(F.array().cast(NONE))


def training(start: Column, end: Column, n: Column | int = 4, skip_tail: Column | int = 4) -> Column:
    """At most ``n`` evenly spaced frames of a window without its tail, rounded half to even."""
    n, skip_tail = (v if isinstance(v, Column) else F.lit(v) for v in (n, skip_tail))
    usable = F.greatest(start, end - skip_tail) - start + 1
    some = F.least(n, usable)
    step = F.when(some > 1, (usable - 1) / (some - 1)).otherwise(F.lit(0.0))
    picked = F.transform(F.sequence(F.lit(0), F.greatest(some - 1, F.lit(0))), lambda i: (start + F.bround(i * step, 0)).cast("int"))
    return F.when(some > 0, picked).otherwise(F.array().cast(NONE))


def before(anchor: Column, n: Column | int = 8) -> Column:
    """The ``n`` frames before an anchor, none below zero."""
    n = n if isinstance(n, Column) else F.lit(n)
    return _upto(F.greatest(F.lit(0), anchor - n), anchor)


def early(start: Column, end: Column, n: Column | int = 8) -> Column:
    """The first ``n`` frames of a half-open window."""
    n = n if isinstance(n, Column) else F.lit(n)
    return _upto(start, F.least(start + n, end))


def backtrack(start: Column, end: Column, n: Column | int = 4, skip: Column | int = 8) -> Column:
    """``n`` frames that end ``skip`` frames before the window does."""
    n, skip = (v if isinstance(v, Column) else F.lit(v) for v in (n, skip))
    stop = F.greatest(end - skip, start)
    return _upto(F.greatest(stop - n, start), stop)


def trailing(start: Column, end: Column, n: Column | int) -> Column:
    """The last ``n`` frames of a closed window, the event's own included."""
    n = n if isinstance(n, Column) else F.lit(n)
    return _upto(F.greatest(start, end - n + 1), end + 1)


def anchor(start: Column, fr_start: Column, max_gap: int = 50) -> Column:
    """Where an event's action began: its trace if that lies at most ``max_gap`` before the window, else the window's start."""
    return F.when(start.isNull(), None).when((start <= fr_start) & (fr_start - start <= max_gap), start).otherwise(fr_start)


def rebase(frame: Column, fr_start: Column, ori_start: Column) -> Column:
    """Frame number in the original recording."""
    return frame + (ori_start - fr_start)
