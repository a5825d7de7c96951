"""History kept up to date from a stream of changes.

Every micro-batch writes one *run*, a folder in each of three tables:

* ``changes``  -- the changes as they came, partitioned by a hash bucket of the key;
* ``touched``  -- the keys of the batch, and from which version start on it replaces what
  earlier runs wrote for them (NULL: all of it);
* ``versions`` -- the versions the batch wrote for these keys.

and a run of the *state*: the open version of each of its keys, by bucket, which carries all
that the key's next change needs.  Full tiers of runs are merged as in a log-structured store:
``FANOUT`` runs of history become one of the next tier, which drops what was replaced among
them, and ``FANOUT`` runs of state become one, and so many of those the one base.  A manifest
names the runs that count and is switched at the end of a batch.

A batch finds the open versions of its keys in a bounded number of runs, in its own buckets
only.  What it reads and writes follows the batch and the keys of its buckets, not how many
batches came before.  Only keys with a change at or before one already applied are recomputed,
from the change log of their buckets, so the history does not depend on arrival order.

A batch reads what the manifest before it names and overwrites its own folders only, which
makes a repeated batch harmless.  Runs that neither of the last two manifests names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from larder.functions.scalar import all_of
from larder.operators.scd2 import END, HOT_ROWS, START, Spec, history
from larder.session import remove
from larder.streaming.jobs import run_batches

BUCKETS = 64
FANOUT = 5       # runs of one tier that are merged
STATE_TIERS = 1  # tiers of state below its base

HISTORY = ("changes", "touched", "versions")

_RUN, _BUCKET = "__run", "bucket"
_LAST = "__last_at"        # a key's latest applied change
_FROM, _LATE = "__from", "__late"

Run = tuple[int, int, int]  # first and last batch, tier


@dataclass(frozen=True)
class Manifest:
    """The runs that count after ``batch``, oldest first."""

    batch: int = -1
    history: tuple[Run, ...] = ()
    state: tuple[Run, ...] = ()

    def folders(self, path: str) -> set[str]:
        return {_folder(path, t, r) for t in HISTORY for r in self.history} | {
            _folder(path, "state", r) for r in self.state}


def run_history(stream: DataFrame, spec: Spec, path: str, checkpoint: str,
                hot_rows: int = HOT_ROWS) -> StreamingQuery:
    """Apply all changes that have arrived, then stop."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch, batch_id, spec, path, hot_rows)

    return run_batches(stream, apply, checkpoint, path)


def apply_changes(batch: DataFrame, batch_id: int, spec: Spec, path: str,
                  hot_rows: int = HOT_ROWS) -> None:
    """Write one batch's runs, merge full tiers, switch the manifest."""
    spark, names = batch.sparkSession, batch.columns
    known = manifest(spark, path, batch_id)
    one = (batch_id, batch_id, 0)
    # Rebalanced by bucket, a bucket is one file unless it is big enough for several.
    bucketed = batch.withColumn(_BUCKET, _bucket(spec)).hint("rebalance", _BUCKET)
    new = _store(bucketed, _folder(path, "changes", one), _BUCKET)

    opened = open_versions(spark, path, spec, known, new)
    touched = _store(_touch(new, opened, spec), _folder(path, "touched", one))
    in_order, late = touched.where(~F.col(_LATE)), touched.where(_LATE)

    seeds = _matching(opened, in_order, spec, "left_semi")
    seed_rows = seeds.select(
        *(F.col(_LAST).alias(c) if c == spec.sequence_by
          else F.col(c) if c in seeds.columns else F.lit(None).alias(c) for c in names))
    changes = _matching(new.select(*names), in_order, spec, "left_semi").unionByName(seed_rows)
    if not late.isEmpty():
        logged = _runs(spark, path, "changes", [*known.history, one], new.schema).where(
            F.col(_BUCKET).isin(_buckets(late, spec)))
        replay = _matching(logged, late.withColumn(_BUCKET, _bucket(spec)), spec,
                           "left_semi", _BUCKET)
        changes = changes.unionByName(replay.select(*names))

    last = changes.groupBy(*spec.keys).agg(F.max(spec.sequence_by).alias(_LAST))
    kept = seeds.select(*spec.keys, F.col(START).alias("__since"), F.col(_LAST).alias("__at"))
    versions = _matching(history(changes, spec, hot_rows), kept, spec, "left",
                         add=("__since", "__at"))
    versions = versions.withColumn(
        START, F.when(F.col(START) == F.col("__at"), F.col("__since")).otherwise(F.col(START)))
    versions = _matching(versions.drop("__since", "__at"), last, spec, "left", add=(_LAST,))
    written = _store(versions, _folder(path, "versions", one))
    _store(_by_bucket(written.where(F.col(END).isNull()), spec), _folder(path, "state", one), _BUCKET)
    _switch(spark, path, spec, known, batch_id, {
        "changes": new.schema, "touched": touched.schema, "versions": written.schema})


def read_history(spark: SparkSession, path: str, spec: Spec) -> DataFrame:
    """All versions that no later batch has replaced."""
    runs = manifest(spark, path).history
    touched, versions = (
        _runs(spark, path, t, runs, spark.read.parquet(_folder(path, t, runs[-1])).schema)
        for t in ("touched", "versions"))
    return _live(touched, versions, spec).drop(_RUN, _LAST)


def manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest:
    """The latest manifest, or the latest of the batches ``before`` one."""
    try:
        rows = spark.read.text(f"{path}/manifest").collect()  # two rows at most
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Manifest()
    made = [Manifest(m["batch"], *(tuple(map(tuple, m[k])) for k in ("history", "state")))
            for m in (json.loads(r["value"]) for r in rows)]
    return max((m for m in made if before is None or m.batch < before),
               key=lambda m: m.batch, default=Manifest())


def open_versions(spark: SparkSession, path: str, spec: Spec, known: Manifest,
                  new: DataFrame) -> DataFrame:
    """The open versions of the keys in the buckets that ``new`` changes lie in, each from the
    last run that has the key."""
    attrs, at = spec.attributes(new.drop(_BUCKET)), F.col(spec.sequence_by)
    shape = new.where(F.lit(False)).select(
        *spec.keys, *attrs, at.alias(START), at.alias(END), at.alias(_LAST), _BUCKET)
    if not known.state:
        return shape.drop(_BUCKET)
    rows = _runs(spark, path, "state", known.state, shape.schema)
    return _latest(rows.where(F.col(_BUCKET).isin(_buckets(new, spec))), spec)


# -- runs --------------------------------------------------------------------------

def _folder(path: str, table: str, run: Run) -> str:
    return f"{path}/{table}/run=r{run[0]}_{run[1]}"


def _runs(spark: SparkSession, path: str, table: str, runs: Sequence[Run], schema) -> DataFrame:
    """One table's rows of several runs and the last batch of each row's run."""
    shape = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    rows = spark.read.schema(shape).option("basePath", f"{path}/{table}").parquet(
        *(_folder(path, table, r) for r in runs))
    return rows.withColumn(_RUN, F.element_at(F.split("run", "_"), -1).cast("int")).drop("run")


def _latest(rows: DataFrame, spec: Spec) -> DataFrame:
    row = F.struct(*(c for c in rows.columns if c not in (*spec.keys, _RUN, _BUCKET)))
    return rows.groupBy(*spec.keys).agg(F.max_by(row, _RUN).alias("row")).select(
        *spec.keys, "row.*")


def _live(touched: DataFrame, versions: DataFrame, spec: Spec) -> DataFrame:
    """The versions of some runs that none of these replaces."""
    later = (
        Window.partitionBy(*spec.keys).orderBy(F.desc(_RUN))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    replaced = touched.select(
        *spec.keys, _RUN,
        F.max(F.col(_FROM).isNull()).over(later).alias("__all"),
        F.min(_FROM).over(later).alias("__cut"))
    live = _matching(versions, replaced, spec, "inner", _RUN, add=("__all", "__cut"))
    keep = ~F.coalesce("__all", F.lit(False)) & (
        F.col("__cut").isNull() | (F.col(START) < F.col("__cut")))
    return live.where(keep).drop("__all", "__cut")


def _switch(spark: SparkSession, path: str, spec: Spec, known: Manifest, batch_id: int,
            schemas: dict) -> None:
    """Adds the batch's runs, merges tiers that are full, and makes that the manifest.

    Two places take turns, so that the manifest before is whole while one is written.
    """
    one = (batch_id, batch_id, 0)
    past, state = [*known.history, one], [*known.state, one]
    made_now = Manifest(batch_id, (one,), (one,)).folders(path)
    while (run := _full(past)) is not None:
        _merge_history(spark, path, spec, past[-FANOUT:], run, schemas)
        past[-FANOUT:] = [run]
        made_now |= Manifest(batch_id, (run,)).folders(path)
    while (run := _full(state)) is not None:
        size = FANOUT if run[2] <= STATE_TIERS else len(state)  # the last tier joins the base
        run = (state[-size][0], *run[1:])
        shape = T.StructType([*schemas["versions"].fields, T.StructField(_BUCKET, T.IntegerType())])
        rows = _runs(spark, path, "state", state[-size:], shape)
        _store(_by_bucket(_latest(rows, spec), spec), _folder(path, "state", run), _BUCKET)
        state[-size:] = [run]
        made_now |= Manifest(batch_id, (), (run,)).folders(path)
    given_up = manifest(spark, path, known.batch).folders(path)
    made = Manifest(batch_id, tuple(past), tuple(state))
    text = json.dumps({"batch": batch_id, "history": past, "state": state})
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(
        f"{path}/manifest/turn={batch_id % 2}")
    for folder in sorted((given_up - known.folders(path) | made_now) - made.folders(path)):
        remove(spark, folder)


def _full(runs: list[Run]) -> Run | None:
    """The run that the newest ``FANOUT`` runs become, if they are of one tier."""
    last = runs[-FANOUT:]
    if len(last) < FANOUT or len({r[2] for r in last}) > 1:
        return None
    return last[0][0], last[-1][1], last[0][2] + 1


def _merge_history(spark: SparkSession, path: str, spec: Spec, runs: list[Run], to: Run,
                   schemas: dict) -> None:
    changes, touched, versions = (_runs(spark, path, t, runs, schemas[t]) for t in HISTORY)
    _store(_by_bucket(changes.drop(_RUN), spec), _folder(path, "changes", to), _BUCKET)
    _store(_live(touched, versions, spec).drop(_RUN), _folder(path, "versions", to))
    cut = F.when(~F.max(F.col(_FROM).isNull()), F.min(_FROM))
    _store(touched.groupBy(*spec.keys).agg(cut.alias(_FROM), F.max(_LATE).alias(_LATE)),
           _folder(path, "touched", to))


# -- parts -------------------------------------------------------------------------

def _bucket(spec: Spec) -> Column:
    return F.pmod(F.xxhash64(*spec.keys), F.lit(BUCKETS)).cast("int")


def _by_bucket(df: DataFrame, spec: Spec) -> DataFrame:
    return df.withColumn(_BUCKET, _bucket(spec)).hint("rebalance", _BUCKET)


def _buckets(df: DataFrame, spec: Spec) -> list[int]:
    return [r[0] for r in df.select(_bucket(spec)).distinct().collect()]  # <= BUCKETS


def _store(df: DataFrame, folder: str, partition_by: str | None = None) -> DataFrame:
    """Write a folder and read it back, so that nothing is computed twice."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _touch(new: DataFrame, opened: DataFrame, spec: Spec) -> DataFrame:
    """The batch's keys; late ones have a change no later than one already applied."""
    firsts = new.groupBy(*spec.keys).agg(F.min(spec.sequence_by).alias("__first"))
    known = _matching(firsts, opened, spec, "left", add=(START, _LAST))
    late = F.coalesce(F.col("__first") <= F.col(_LAST), F.lit(False))
    return known.select(*spec.keys, F.when(~late, F.col(START)).alias(_FROM), late.alias(_LATE))


def _matching(left: DataFrame, right: DataFrame, spec: Spec, how: str, *also: str,
              add: tuple[str, ...] = ()) -> DataFrame:
    """A join on the key columns in which NULL keys match each other."""
    same = all_of(F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*spec.keys, *also))
    return left.alias("l").join(right.alias("r"), same, how).select(
        "l.*", *(f"r.{c}" for c in add))
