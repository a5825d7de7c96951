"""Slowly changing dimensions, type 2, from a feed of changes.

A change row has the key columns, one sequence column and attributes.  ``history``
gives one row per version with ``__START_AT`` and ``__END_AT`` (NULL while open):

* a version opens when a *tracked* attribute changes; other attributes are overwritten
  in the open version;
* with ``ignore_nulls`` a NULL in a change means "not mentioned" and keeps the old value;
* changes of one key at one instant are merged first, so versions never have zero length:
  in the order of ``tie_break`` (the position in the source), or without one a single whole
  row of them is kept, the largest.

Skew.  Merging is an aggregation with a map-side half.  The steps that need order run in
windows per (key, slice): a key with more than ``hot_rows`` changes has its time line cut
into slices of equal depth, so no task sorts more than about one slice.  What a slice must know about
its neighbours (the state carried in, the start of the open version, the next change) is
computed from one summary row per slice and joined back.  All keys below the limit have a
single slice and no summary row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.functions.scalar import any_of

START = "__START_AT"
END = "__END_AT"
HOT_ROWS = 5_000_000
_SAMPLED = 256  # instants looked at for each slice of a hot key

_KEY = "__key"  # the key columns as one never-NULL struct, so NULL keys join too
_SLICE = "__slice"
_HOT = "__hot"


@dataclass(frozen=True)
class Spec:
    """What the history of one entity depends on."""

    keys: Sequence[str]
    sequence_by: str
    tracked: Sequence[str]
    ignore_nulls: bool = True
    tie_break: Sequence[str] = ()

    def attributes(self, changes: DataFrame) -> list[str]:
        known = {*self.keys, self.sequence_by, *self.tie_break}
        return [c for c in changes.columns if c not in known]


def history(changes: DataFrame, spec: Spec, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All versions of all keys."""
    attrs = spec.attributes(changes)
    keyed = changes.withColumn(_KEY, F.struct(*spec.keys))
    steps = _one_per_instant(_slices(keyed, spec, hot_rows), spec, attrs)
    versions = _close_versions(_mark_changes(steps, spec, attrs), spec, attrs)
    return versions.select(f"{_KEY}.*", *attrs, START, END)


def current(versions: DataFrame) -> DataFrame:
    """The open version of every key."""
    return versions.where(F.col(END).isNull())


def latest_state(changes: DataFrame, spec: Spec) -> DataFrame:
    """The attributes ``current(history(...))`` has, without building the history.

    One aggregation per key with a map-side half, no window; without ``tie_break`` one more
    before it that settles the changes of one instant.
    """
    attrs = spec.attributes(changes)
    if spec.tie_break:
        order = F.struct(spec.sequence_by, *spec.tie_break)
        return changes.groupBy(*spec.keys).agg(*_last_values(attrs, order, spec.ignore_nulls))
    order = F.struct(spec.sequence_by, *attrs)
    if spec.ignore_nulls:
        changes = changes.groupBy(*spec.keys, spec.sequence_by).agg(
            *_last_values(attrs, F.struct(*attrs), False))
        order = F.col(spec.sequence_by)
    return changes.groupBy(*spec.keys).agg(*_last_values(attrs, order, spec.ignore_nulls))


# -- steps -------------------------------------------------------------------------

def _last_values(attrs: Sequence[str], order: Column, ignore_nulls: bool) -> list[Column]:
    """The last (known) value of each attribute, as aggregates."""
    if ignore_nulls:
        return [F.max_by(F.col(a), F.when(F.col(a).isNotNull(), order)).alias(a)
                for a in attrs]
    row = F.max_by(F.struct(*attrs), order)
    return [row[a].alias(a) for a in attrs]


def _slices(changes: DataFrame, spec: Spec, hot_rows: int) -> DataFrame:
    """Adds the slice number and whether the key is hot.

    A hot key's slices hold about ``hot_rows / 4`` instants each, whatever type the sequence has
    and however its instants lie: they are cut at quantiles of a sample of its distinct instants.
    The sample is chosen by hash, so every evaluation cuts at the same points.  There are at
    most (all rows / hot_rows) hot keys; adaptive execution sees how many.
    """
    cuts = _cuts(changes, spec, hot_rows)
    # which block of cuts, then which cut in it: far fewer comparisons a row than cuts
    below = f"size(filter({{}}, x -> x <= `{spec.sequence_by}`))"
    block = F.expr(below.format("transform(__cuts, c -> c[0])"))
    placed = F.when(F.col("__block") > 0, F.expr(
        f"(__block - 1) * size(__cuts[0]) + {below.format('__cuts[__block - 1]')}"))
    return changes.join(cuts, _KEY, "left").withColumn(
        "__block", F.when(F.col("__cuts").isNotNull(), block)).withColumns({
            _SLICE: F.coalesce(placed, F.lit(0)).cast("bigint"),
            _HOT: F.col("__cuts").isNotNull(),
        }).drop("__cuts", "__block")


def _cuts(changes: DataFrame, spec: Spec, hot_rows: int) -> DataFrame:
    """The instants at which hot keys' slices begin, ascending, in blocks of equal length.

    Keys with one slice only are left out.
    """
    depth = max(1, hot_rows // 4)
    one_in = max(1, depth // _SAMPLED)
    hot = changes.groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n")).where(
        F.col("__n") > hot_rows).select(_KEY)
    instants = changes.select(_KEY, F.col(spec.sequence_by).alias("__at")).where(
        "__at is not null").where(F.pmod(F.xxhash64("__at"), F.lit(one_in)) == 0).join(
        hot, _KEY, "left_semi").distinct()
    whole = Window.partitionBy(_KEY)
    slices = F.expr(f"greatest(1, __n div {max(1, depth // one_in)})")
    begins = instants.withColumns({
        "__n": F.count(F.lit(1)).over(whole),
        "__rank": F.row_number().over(whole.orderBy("__at")) - 1,
    }).withColumn("__of", F.floor(F.col("__rank") * slices / F.col("__n"))).where(
        "__of > 0").groupBy(_KEY, "__of").agg(F.min("__at").alias("__at"))
    listed = begins.groupBy(_KEY).agg(F.sort_array(F.collect_list("__at")).alias("__all")).withColumn(
        "__wide", F.ceil(F.sqrt(F.size("__all"))).cast("int"))
    return listed.select(_KEY, F.expr("""
        transform(sequence(0, (size(__all) - 1) div __wide),
                  i -> slice(__all, CAST(i * __wide + 1 AS INT), __wide))""").alias("__cuts"))


def _one_per_instant(sliced: DataFrame, spec: Spec, attrs: Sequence[str]) -> DataFrame:
    instants = sliced.groupBy(_KEY, _HOT, _SLICE, spec.sequence_by)
    if not spec.tie_break:
        return instants.agg(*_last_values(attrs, F.struct(*attrs), False))
    return instants.agg(*_last_values(attrs, F.struct(*spec.tie_break), spec.ignore_nulls))


def _within(spec: Spec) -> Window:
    # The hot flag depends on the key alone.  Naming it here lets a filter on it pass
    # below the window, so that summaries read hot keys only.
    return Window.partitionBy(_KEY, _HOT, _SLICE).orderBy(spec.sequence_by)


def _so_far(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _across() -> Window:
    return Window.partitionBy(_KEY).orderBy(_SLICE)


def _earlier() -> Window:
    return _across().rowsBetween(Window.unboundedPreceding, -1)


def _mark_changes(steps: DataFrame, spec: Spec, attrs: Sequence[str]) -> DataFrame:
    """Fills in values that were not mentioned and flags rows that open a version."""
    seq = spec.sequence_by

    def carried(name: str) -> Column:
        if spec.ignore_nulls:
            return F.last(name, ignorenulls=True).over(_earlier()).alias(f"__in_{name}")
        return F.lag(name).over(_across()).alias(f"__in_{name}")

    summary = steps.where(_HOT).groupBy(_KEY, _SLICE).agg(
        *_last_values(attrs, F.col(seq), spec.ignore_nulls))
    before = summary.select(
        _KEY, _SLICE, *(carried(a) for a in attrs),
        (F.row_number().over(_across()) > 1).alias("__continues"))
    rows = steps.join(before, [_KEY, _SLICE], "left")
    window = _within(spec)
    if spec.ignore_nulls:
        rows = rows.withColumns({
            a: F.coalesce(F.last(a, ignorenulls=True).over(_so_far(window)),
                          F.col(f"__in_{a}"))
            for a in attrs})
    inner = F.row_number().over(window) > 1
    moved = any_of(
        ~F.col(a).eqNullSafe(
            F.when(inner, F.lag(a).over(window)).otherwise(F.col(f"__in_{a}")))
        for a in spec.tracked)
    known = inner | F.coalesce(F.col("__continues"), F.lit(False))
    return rows.withColumn("__opens", ~known | moved).select(
        _KEY, seq, _SLICE, _HOT, *attrs, "__opens")


def _close_versions(flagged: DataFrame, spec: Spec, attrs: Sequence[str]) -> DataFrame:
    """Keeps the last row of every version and gives it the version's bounds."""
    seq = spec.sequence_by
    opened = F.when(F.col("__opens"), F.col(seq))
    summary = flagged.where(_HOT).groupBy(_KEY, _SLICE).agg(
        F.max(opened).alias("__opened"), F.min(seq).alias("__first"),
        F.min_by("__opens", seq).alias("__first_opens"))
    around = summary.select(
        _KEY, _SLICE,
        F.last("__opened", ignorenulls=True).over(_earlier()).alias("__open_since"),
        F.lead("__first").over(_across()).alias("__next"),
        F.lead("__first_opens").over(_across()).alias("__next_opens"))
    window = _within(spec)
    rows = flagged.join(around, [_KEY, _SLICE], "left").select(
        _KEY, *attrs,
        F.coalesce(F.max(opened).over(_so_far(window)), F.col("__open_since")).alias(START),
        F.coalesce(F.lead(seq).over(window), F.col("__next")).alias(END),
        F.coalesce(F.lead("__opens").over(window), F.col("__next_opens"),
                   F.lit(True)).alias("__ends"))
    return rows.where("__ends").drop("__ends")
