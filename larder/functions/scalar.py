"""Column helpers used by the cleaning rules.

All of them compile to built-in expressions; bad input gives NULL even when the
session runs in ANSI mode, where a plain cast or ``to_date`` would stop the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Date layouts found in the feeds.
US_DATE = "M/d/yyyy"
ISO_DATE = "yyyy-MM-dd"


def parse_date(name: str, *layouts: str) -> Column:
    """The date in ``name`` under the first layout that fits, else NULL."""
    return F.coalesce(*(F.try_to_date(F.col(name), layout) for layout in layouts or (US_DATE,)))


def whole_number(name: str) -> Column:
    return F.col(name).try_cast("int")


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def title_case(name: str) -> Column:
    return F.initcap(F.col(name))


def upper_case(name: str) -> Column:
    return F.upper(F.col(name))


def full_name(*names: str) -> Column:
    """The given parts joined by a blank; missing parts leave no gap."""
    return F.trim(F.concat_ws(" ", *(F.col(n) for n in names)))


def last_path_segment(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+$)", 1)


def minute_of(name: str) -> Column:
    return F.date_trunc("minute", F.col(name))


def all_of(conditions) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def any_of(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
