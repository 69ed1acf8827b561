"""One micro-batch to several sinks under one batch id: good rows go on, rejected rows are kept with the reason.

A source or parser that would stop on a bad message marks it instead (an error column); the stream then never fails on the
same batch for ever.  Every sink replaces what an earlier attempt wrote under the batch id, so a batch that is run again
after a failure between two sinks leaves each row once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowdex.streaming.runner import Sink


def fan_out(*routes: tuple[Column, Sink]) -> Sink:
    """A sink that gives each ``(predicate, sink)`` the rows for which the predicate is true, all under the same id.

    The batch is read once and kept until the last sink is done; a row may go to several sinks, or to none.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for predicate, target in routes:
                target(batch.where(predicate), batch_id)
        finally:
            batch.unpersist()
    return sink


def quarantine(good: Sink, rejects: Sink, error_col: str = "error", evidence: tuple[str, ...] = ("raw",)) -> Sink:
    """Rows without an error go to ``good`` without the columns that only explain one; the others go whole to ``rejects``.

    The batch that is kept for both holds the evidence of rejected rows alone.
    """
    def pass_on(batch: DataFrame, batch_id: int) -> None:
        good(batch.drop(error_col, *evidence), batch_id)

    routes = fan_out((F.col(error_col).isNull(), pass_on), (F.col(error_col).isNotNull(), rejects))

    def sink(batch: DataFrame, batch_id: int) -> None:
        shown = {c: F.when(F.col(error_col).isNotNull(), F.col(c)) for c in evidence if c in batch.columns}
        routes(batch.withColumns(shown) if shown else batch, batch_id)
    return sink
