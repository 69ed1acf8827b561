"""File sink keyed by micro-batch: one folder per batch id, replaced on re-run."""

from __future__ import annotations

from pyspark.sql import DataFrame


def batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batch_id={int(batch_id)}"


def write_batch(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one micro-batch to ``<root>/batch_id=<id>``, replacing an earlier attempt.

    Reading ``root`` back discovers ``batch_id`` as a partition column.  A batch
    re-run after a failure overwrites only its own folder, so nothing is duplicated.
    """
    df.write.mode("overwrite").format(fmt).save(batch_path(root, batch_id))


def batch_sink(root: str, fmt: str = "parquet"):
    """A ``(DataFrame, batch_id) -> None`` sink over :func:`write_batch`."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, root, batch_id, fmt)
    return sink
