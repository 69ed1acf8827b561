"""A sharded feed whose shards split and merge while one stream reads it (format ``shardlog``).

``<root>/<shard>/<n>/`` is segment ``n`` (from 0) of a shard, a folder of Parquet files; ``<root>/_lineage/<shard>.json``
names the shard's parents, and ``<root>/_closed/<shard>.json`` how many segments it has once it gets no more.  Each of
them appears by one rename and never changes.

A shard is read from its first segment on, as soon as all its parents, and theirs, are closed and all their segments are
there; so no record comes in an earlier batch than one of a parent, and within a batch ``generation`` and the order of
partitions put parents first.  The offset is the number of segments read of each shard, all that a restart needs: shards
that were added meanwhile are found in the folder.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from flowdex.sources.mailbox import _filesystem

try:  # workers may not have this package
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):
    pass

LINEAGE, CLOSED = "_lineage", "_closed"
PLACE = "shard string, generation int, segment long"


# ------------------------------------------------------------------------ writing

def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return hadoop, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _check_name(shard: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", shard):
        raise ValueError(f"not a shard name: {shard!r}")


def _publish(spark: SparkSession, root: str, kind: str, shard: str, entry: dict) -> None:
    hadoop, folder, files = _folder(spark, f"{root}/{kind}")
    temporary, target = hadoop.Path(folder, f".{uuid.uuid4().hex}"), hadoop.Path(folder, f"{shard}.json")
    out = files.create(temporary, True)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(temporary, target):
        raise RuntimeError(f"{kind} of shard {shard} is there already")


def add_shard(spark: SparkSession, root: str, shard: str, parents: Sequence[str] = ()) -> None:
    """A new shard; its ``parents`` may still be open, it then waits for them."""
    _check_name(shard)
    _publish(spark, root, LINEAGE, shard, {"parents": sorted(set(parents))})


def _segments(spark: SparkSession, root: str, shard: str) -> int:
    hadoop, folder, files = _folder(spark, f"{root}/{shard}")
    found = files.globStatus(hadoop.Path(folder, "[0-9]*")) or []
    return 1 + max((int(f.getPath().getName()) for f in found), default=-1)


def append_segment(records: DataFrame, root: str, shard: str) -> int:
    """Write the next segment of a shard from all tasks of ``records``, publish it by one rename; its number."""
    _check_name(shard)
    spark = records.sparkSession
    hadoop, folder, files = _folder(spark, f"{root}/{shard}")
    if files.exists(hadoop.Path(f"{root}/{CLOSED}/{shard}.json")):
        raise RuntimeError(f"shard {shard} is closed")
    number, temporary = _segments(spark, root, shard), f"{root}/{shard}/_{uuid.uuid4().hex}"
    records.write.parquet(temporary)
    target = hadoop.Path(folder, str(number))
    if files.exists(target) or not files.rename(hadoop.Path(temporary), target):
        raise RuntimeError(f"segment {number} of shard {shard} was written by another writer")
    return number


def close_shard(spark: SparkSession, root: str, shard: str) -> None:
    """The shard gets no more segments: its children may be read when the ones it has are."""
    _publish(spark, root, CLOSED, shard, {"segments": _segments(spark, root, shard)})


# ------------------------------------------------------------------------ reading

class _Files(InputPartition):
    def __init__(self, file: str, shard: str, generation: int, segment: int):
        super().__init__((file, shard, generation, segment))


def released(lineage: dict[str, list[str]], closed: dict[str, int], there: dict[str, int]) -> dict[str, int]:
    """``{shard: generation}`` of the shards that may be read.

    ``there`` counts the segments of each shard that are there without a gap.  A shard whose parent is unknown, open or not
    yet wholly there waits.
    """
    out: dict[str, int] = {}
    whole: set[str] = set()
    waiting = dict(lineage)
    while True:
        ready = [s for s, parents in waiting.items() if whole.issuperset(parents)]
        if not ready:
            return out
        for s in ready:
            out[s] = 1 + max((out[p] for p in waiting.pop(s)), default=-1)
        whole.update(s for s in ready if s in closed and there.get(s, 0) >= closed[s])


class _ShardReader(DataSourceStreamReader):
    def __init__(self, options, schema):
        self.root, self.row = options["path"].rstrip("/"), schema
        self.columns = schema.names[:-3]
        self.lineage: dict[str, list[str]] = {}
        self.closed: dict[str, int] = {}
        self.there: dict[str, int] = {}

    def _list(self, path: str):
        from pyarrow.fs import FileSelector

        fs, path = _filesystem(f"{self.root}/{path}")
        return fs, [i for i in fs.get_file_info(FileSelector(path, allow_not_found=True)) if i.base_name[0] not in "._"]

    def _entries(self, kind: str, known: dict, field: str) -> None:
        """New entries of a kind; known ones never change and aren't read again."""
        fs, found = self._list(kind)
        for i in found:
            name = i.base_name.removesuffix(".json")
            if name not in known:
                with fs.open_input_stream(i.path) as f:
                    known[name] = json.loads(f.read())[field]

    def _refresh(self) -> dict[str, int]:
        self._entries(CLOSED, self.closed, "segments")
        self._entries(LINEAGE, self.lineage, "parents")
        for shard in self.lineage:
            if shard in self.closed and self.there.get(shard, -1) >= self.closed[shard]:
                continue  # nothing more comes
            numbers = {int(i.base_name) for i in self._list(shard)[1] if i.base_name.isdigit()}
            n = self.there.get(shard, 0)
            while n in numbers:
                n += 1
            self.there[shard] = n
        return released(self.lineage, self.closed, self.there)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {s: self.there[s] for s in sorted(self._refresh()) if self.there[s]}

    def partitions(self, start: dict, end: dict):
        generation = self._refresh()
        out = []
        for shard in sorted(end, key=lambda s: (generation[s], s)):
            for segment in range(start.get(shard, 0), end[shard]):
                files = sorted(i.path for i in self._list(f"{shard}/{segment}")[1] if i.base_name.endswith(".parquet"))
                out += [_Files(f, shard, generation[shard], segment) for f in files]
        return out

    def read(self, partition):
        """The records of one file, row group by row group."""
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        file, shard, generation, segment = partition.value
        fs, _ = _filesystem(self.root)
        target = to_arrow_schema(self.row)
        with fs.open_input_file(file) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=self.columns):
                n = batch.num_rows
                place = [pa.array([v] * n, t.type) for v, t in zip((shard, generation, segment), list(target)[-3:])]
                kept = [batch.column(c).cast(target.field(c).type) for c in self.columns]
                yield pa.RecordBatch.from_arrays(kept + place, schema=target)


class ShardLog(DataSource):
    """``format("shardlog")``: option ``path``; the schema of the records, then ``shard, generation, segment``."""

    @classmethod
    def name(cls):
        return "shardlog"

    def schema(self):
        return f"{self.options['columns']}, {PLACE}"

    def streamReader(self, schema):
        return _ShardReader(self.options, schema)


def read_shards(spark: SparkSession, root: str, schema: str = "value binary") -> DataFrame:
    """Stream all shards of ``root`` as one feed: the columns of ``schema`` (DDL), then ``shard, generation, segment``."""
    spark.dataSource.register(ShardLog)
    return spark.readStream.format("shardlog").option("path", root).option("columns", schema).load()
