"""Analyzer plug-ins: a function from one micro-batch of messages to another.

An analyzer receives the batch (columns ``value`` plus passthrough columns) and
its ``batch_id`` and returns a DataFrame whose ``value`` column holds the
outgoing JSON text.  ``None`` means "no analyzer": messages pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from flowdex.operators import histogram, sqlreport

Analyzer = Callable[[DataFrame, int], DataFrame | None]  # None: nothing to emit


def apply_analyzer(batch: DataFrame, analyzer: Analyzer | None, batch_id: int = 0) -> DataFrame | None:
    """The analyzer's output for this batch; without an analyzer the batch itself."""
    return batch if analyzer is None else analyzer(batch, batch_id)


class SqlAnalyzer:
    """One SQL statement per micro-batch; report rows rendered as JSON ``value``.

    The default report has its own key names (``mean_decimals`` and
    ``legacy_keys`` apply to it alone); rows of any other statement are rendered
    with the statement's column names.

    ``schema_dir`` keeps an inferred schema across batches: a member keeps its
    column in batches that lack it, and a type only widens.  ``schema`` then
    names members that exist from the start (None: none).
    """

    rereads_batch = False  # with a declared schema the batch is read once

    def __init__(self, statement: str = sqlreport.DEFAULT_STATEMENT, view: str = sqlreport.DEFAULT_VIEW,
                 schema: str | None = sqlreport.LOG_SCHEMA, render: bool = True,
                 mean_decimals: int | None = None, legacy_keys: bool = False, schema_dir: str | None = None):
        from flowdex.streaming.schema_state import SchemaState
        self.statement = statement
        self.view = view
        self.schema = schema
        self.render = render
        self.mean_decimals = mean_decimals
        self.legacy_keys = legacy_keys
        self.state = SchemaState(schema_dir, schema) if schema_dir else None
        self.rereads_batch = schema is None or bool(schema_dir)  # inference is a pass of its own

    def __call__(self, batch: DataFrame, batch_id: int = 0) -> DataFrame | None:
        schema = self.schema
        if self.state is not None:
            schema = self.state.advance(batch)
            if schema is None:  # no member is known yet
                return None
        report = sqlreport.sql_analyzer(batch, self.statement, self.view, schema)
        if report is None:  # no JSON object to infer a schema from: no output for this batch
            return None
        if not self.render:
            return report
        if self.statement == sqlreport.DEFAULT_STATEMENT:
            return sqlreport.render_report(report, self.mean_decimals, self.legacy_keys)
        return sqlreport.render_rows(report)


class HistogramAnalyzer:
    """Running histogram of ``field`` (state kept in a versioned table)."""

    rereads_batch = False  # it keeps the parsed documents itself

    def __init__(self, field: str, state_dir: str, keep: Sequence[str] = (),
                 compact_every: int | None = None, on_missing: str = "skip"):
        from flowdex.streaming.histogram_state import DEFAULT_COMPACT_EVERY, HistogramState
        self.field = field
        self.state = HistogramState(state_dir, field, compact_every or DEFAULT_COMPACT_EVERY,
                                    on_missing)
        self.keep = tuple(keep)

    def __call__(self, batch: DataFrame, batch_id: int = 0) -> DataFrame:
        return self.state.enrich_batch(batch, batch_id, keep=self.keep)

    def release(self) -> None:
        self.state.release()


class TopKAnalyzer:
    """The ``k`` most frequent values of ``field`` after every micro-batch, over all batches so far.

    Values that a batch lacks keep their place.  The last batch's ``k`` rows are kept beside the histogram's state, in two
    slots that alternate, so the latest batch can be run again.
    """

    rereads_batch = False

    def __init__(self, field: str, state_dir: str, k: int, compact_every: int | None = None, on_missing: str = "skip"):
        from flowdex.streaming.histogram_state import DEFAULT_COMPACT_EVERY, HistogramState
        self.field, self.k = field, k
        self.state = HistogramState(state_dir, field, compact_every or DEFAULT_COMPACT_EVERY, on_missing)

    def _slot(self, batch_id: int) -> str:
        return f"{self.state.state_dir}/top/slot={batch_id % 2}"

    def __call__(self, batch: DataFrame, batch_id: int = 0) -> DataFrame:
        spark = batch.sparkSession
        schema = "rank int, histo_valu string, n bigint"
        previous = spark.read.schema(schema).parquet(self._slot(batch_id - 1)) if batch_id else None
        support = self.state.advance(histogram.with_documents(batch, self.field, on_missing=self.state.on_missing), batch_id)
        histogram.top_k_step(previous, support, self.k).write.mode("overwrite").parquet(self._slot(batch_id))
        return sqlreport.render_rows(spark.read.schema(schema).parquet(self._slot(batch_id)))
