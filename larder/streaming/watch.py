"""Log rows of running streams: row counts and expectations of every micro-batch.

Counts are observed on the rows that pass, without a job of their own.  A listener writes them
when a batch is done: one ROW_COUNT row, and a DQ_CHECK row for each rule, in one folder per
query and batch that is overwritten, so a batch that is repeated is logged once.
"""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from larder.operators import quality
from larder.operators.audit import (BREAKING, DQ_CHECK, INFO, LOG_COLUMNS, LOG_SCHEMA, ROW_COUNT,
                                    WARNING, Run)


class Watch(StreamingQueryListener):
    """Logs the observed streams of one session below ``path``.

    ``with Watch(spark, path) as watch:`` listens while streams run; leaving the block waits for
    the last rows and raises what went wrong while they were written.
    """

    def __init__(self, spark: SparkSession, path: str, run: Run = Run()) -> None:
        self.spark, self.path, self.run = spark, path, run
        self.tables: dict[str, tuple[str, str, quality.Rules]] = {}
        self.open: dict[str, threading.Event] = {}
        self.error: BaseException | None = None

    def observed(self, stream: DataFrame, layer: str, table: str,
                 rules: quality.Rules | None = None) -> DataFrame:
        """The stream with its rows counted and its expectations checked on the way."""
        rules = quality.WARNINGS.get(table, {}) if rules is None else rules
        self.tables[f"{layer}.{table}"] = (layer, table, rules)
        return quality.observe_rules(stream, rules, f"{layer}.{table}")

    def __enter__(self) -> Watch:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind, error, trace) -> None:
        for ended in list(self.open.values()):
            ended.wait(60)
        self.spark.streams.removeListener(self)
        if self.error is not None and kind is None:
            raise self.error

    # -- events, on the listener's thread ------------------------------------------

    def onQueryStarted(self, event) -> None:
        self.open[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        try:
            self._log(event.progress)
        except Exception as error:  # noqa: BLE001  the listener's bus would swallow it
            self.error = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if (ended := self.open.get(str(event.runId))) is not None:
            ended.set()

    def _log(self, progress) -> None:
        for name, counts in progress.observedMetrics.items():
            if name in self.tables:
                layer, table, rules = self.tables[name]
                self.record(layer, table, rules, counts.asDict(), str(progress.id),
                            progress.batchId, progress.numInputRows)

    def record(self, layer: str, table: str, rules: quality.Rules, counts: dict[str, int],
               query: str, batch_id: int, rows_in: int | None = None) -> None:
        """Write the rows of one batch; ``counts`` has ``rows`` and the breaches of each rule."""
        name = f"{layer}.{table}"
        rows = [self._row(layer, table, ROW_COUNT, INFO,
                          f"{name} batch {batch_id}: {counts['rows']} output",
                          row_count_input=rows_in, row_count_output=counts["rows"])]
        for rule in rules:
            failed = counts[rule]
            rows.append(self._row(
                layer, table, DQ_CHECK, INFO if failed == 0 else WARNING,
                f"{name} rule {rule}: {failed}{BREAKING}",
                extra_metrics=json.dumps({"check": rule, "passed": failed == 0, "failed": failed,
                                          "rows": counts["rows"]})))
        made = self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
        made.write.mode("overwrite").parquet(f"{self.path}/query={query}/batch={batch_id}")

    def _row(self, layer: str, table: str, event_type: str, level: str, message: str,
             **columns: object) -> tuple:
        event = {
            "log_id": str(uuid.uuid4()), "timestamp": datetime.now(timezone.utc),
            "pipeline_name": self.run.pipeline_name, "pipeline_run_id": self.run.run_id,
            "env": self.run.env, "catalog": self.run.catalog, "layer": layer, "table_name": table,
            "event_type": event_type, "log_level": level, "message": message, **columns}
        return tuple(event.get(c) for c in LOG_COLUMNS)

