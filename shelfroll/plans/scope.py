"""What each stage of a job has to load, as a closure over the calendar.

A job names a range of days. What depends on them, and what they depend on,
reaches further:

* a week is built from all its days, so a stage that feeds weekly needs every
  day of every week it touches (days → whole weeks);
* a day that takes a changed day as its last year changes too (days → LY users);
* a day's LY values are read from staging on its LY day (days → LY days).

Full types replace daily and weekly, so nothing else completes their edge
weeks: staging, daily and weekly take whole weeks, and staging also the LY days
of these weeks. Upserts leave all other days in place: staging takes the range,
daily also the LY users, and weekly is built from whole weeks read back.

LY days and the edge days of weeks are loaded where the facts hold them and
otherwise left alone; only inside the job's own range does a day without facts
lose what is stored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame

from ..operators.calendar import forward_bounds, ly_bounds, period_between, widen_to_weeks

Range = tuple[int, int]


@dataclass(frozen=True)
class JobScope:
    """Inclusive ranges of day keys: ``own`` is the job's, the others what the stages load."""

    own: Range
    staging: list[Range]
    daily: list[Range]
    weeks: list[Range]


def merge_ranges(ranges: list[Range]) -> list[Range]:
    """Union of inclusive key ranges, as disjoint sorted ranges (overlaps merged)."""
    out: list[Range] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def within(ranges: list[Range]) -> Column:
    """Days in one of the ranges."""
    return reduce(lambda a, b: a | b, [period_between(lo, hi) for lo, hi in ranges])


def whole_weeks(calendar: DataFrame, ranges: list[Range]) -> list[Range]:
    """The ranges widened to whole weeks; an error where a range has no calendar day."""
    weeks = []
    for lo, hi in ranges:
        first, last = widen_to_weeks(calendar, lo, hi)
        if first is None or last is None:
            raise ValueError(f"the calendar has no day between {lo} and {hi}; nothing was written")
        weeks.append((first, last))
    return merge_ranges(weeks)


def with_ly_users(calendar: DataFrame, start: int, end: int) -> list[Range]:
    """The range and the days whose LY day lies in it."""
    lo, hi = forward_bounds(calendar, start, end)
    return merge_ranges([(start, end)] + ([(lo, hi)] if lo is not None else []))


def with_ly_days(calendar: DataFrame, ranges: list[Range]) -> list[Range]:
    """The ranges and the LY days of their days."""
    found = [ly_bounds(calendar, lo, hi) for lo, hi in ranges]
    return merge_ranges(ranges + [(lo, hi) for lo, hi in found if lo is not None])


def job_scope(calendar: DataFrame, start: int, end: int, upsert: bool) -> JobScope:
    """The closure of [start, end] for a job that upserts or replaces daily and weekly."""
    own = (start, end)
    if upsert:
        daily = with_ly_users(calendar, start, end)
        return JobScope(own, [own], daily, whole_weeks(calendar, daily))
    weeks = whole_weeks(calendar, [own])
    return JobScope(own, merge_ranges([own, *with_ly_days(calendar, weeks)]), weeks, weeks)
