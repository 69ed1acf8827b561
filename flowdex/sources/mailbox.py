"""Mail as files: mbox files in any ranges, single message files, and a drop that is polled by messages.

* :func:`read_mbox` is the text source with the mbox boundary as its record separator: Spark moves each byte range to the
  next boundary and reads a message that crosses ranges once, in the range where it begins.
* :func:`read_mail_files` takes one message a file.
* :class:`MailDrop` (format ``maildrop``) streams a folder of raw messages with at most so many a poll, however they
  are dealt over files; its offset is the number of messages read, and a poll is planned into partitions of row groups.
"""

from __future__ import annotations

import json
import re
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from flowdex.operators import paging
from flowdex.sources.mail import DEFAULT_FOLDER, POLL_BATCH, RAW_MAIL_SCHEMA, mail_batches

try:  # workers may not have this package
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):
    pass

# How a message begins in an mbox file, and the line that stands for it here.
FROM = "From "
FROM_LINE = "From feed@feed.example Thu Jan  1 00:00:00 1970"


# ------------------------------------------------------------------------- mbox

def to_mbox(raw: Column) -> Column:
    """A message as an mbox record; lines of it that would look like a beginning are quoted."""
    quoted = F.regexp_replace(raw.cast("string"), "(?md)^(>*From )", ">$1")
    return F.concat(F.lit(FROM_LINE + "\n"), quoted, F.lit("\n"))


def write_mbox(mails: DataFrame, path: str, raw_col: str = "raw") -> None:
    """Messages as mbox files, one for each partition."""
    mails.select(to_mbox(F.col(raw_col)).alias("value")).write.text(path, lineSep="\n")


def _messages(batches):
    """Records as the separator cut them -> messages: the rest of the ``From`` line goes, quoted lines are as before."""
    for batch in batches:
        raw = []
        for record in batch.column("value").to_pylist():
            _, _, message = (record or b"").partition(b"\n")
            raw.append(re.sub(rb"(?m)^>(>*From )", rb"\1", message.rstrip(b"\r\n")))
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), batch.column("seq"),
                                          pa.array(raw, pa.binary())], names=["file", "block", "seq", "raw"])


def read_mbox(spark: SparkSession, path: str, streaming: bool = False,
              files_per_trigger: int | None = None) -> DataFrame:
    """``(file, block, seq, raw)`` of every message of the mbox files at ``path``, in ranges of any size.

    ``(file, block, seq)`` sorts the messages of a file as they stand in it, whatever the ranges were.  A message begins
    at the start of a file or at a line that begins with ``From ``; line ends (of either kind) at its end aren't part of
    it.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    # No beginning of the separator is its end, too: Spark's line reader loses its place at range ends with those that are.
    records = reader.text(path, lineSep=f"\n{FROM}")
    records = records.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("value"))
    records = mail_batches(records.where(F.octet_length("value") > 0))
    return records.mapInArrow(_messages, "file string, block long, seq long, raw binary")


def number_mails(messages: DataFrame, folder: str = DEFAULT_FOLDER) -> DataFrame:
    """``RAW_MAIL_SCHEMA`` rows of :func:`read_mbox`: numbered from 1 by file and place, whatever the ranges were."""
    keys = paging.rank_by(messages.select("file", "block", "seq"), ["file", "block", "seq"], "msg_no")
    return messages.join(keys, ["file", "block", "seq"]).select("msg_no", F.lit(folder).alias("folder"), "raw")


def read_mail_files(spark: SparkSession, path: str, pattern: str = "*.eml") -> DataFrame:
    """``(file, raw)`` of files that hold one message each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("file"), F.col("content").alias("raw"))


# -------------------------------------------------------------------- polled drop

def _filesystem(path: str):
    """The filesystem of a path and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Range(InputPartition):
    def __init__(self, file: str, first: int, last: int):
        super().__init__((file, first, last))


class _DropReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.per_poll = int(options.get("perPoll", POLL_BATCH))
        self.per_partition = int(options.get("perPartition", 1000))
        self.progress = options.get("progress")
        if self.per_poll < 1 or self.per_partition < 1:
            raise ValueError("perPoll and perPartition must be at least 1")
        if not self.progress:
            raise ValueError("option progress: name a file on the shared filesystem that keeps the last planned offset")
        self.groups: dict[str, list[int]] = {}
        self.planned: int | None = None

    # Spark's offset log is the truth of what is read; ``progress`` repeats its last entry, since a bounded poll must
    # know where the last one ended.  It is written when a poll is planned, and a poll that was interrupted between the
    # log and the plan is planned first on a restart: the file is never behind when the next poll is chosen.
    def _read_progress(self) -> int:
        fs, path = _filesystem(self.progress)
        from pyarrow.fs import FileType
        if fs.get_file_info(path).type != FileType.File:
            return 0
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())["messages"]

    def _write_progress(self, count: int) -> None:
        fs, path = _filesystem(self.progress)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path + ".new") as f:
            f.write(json.dumps({"messages": count}).encode())
        fs.move(path + ".new", path)

    def _files(self) -> list[tuple[str, int]]:
        """Files and their messages in the order of arrival; a file's messages are counted once, from its footer."""
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSelector

        fs, path = _filesystem(self.path)
        found = [i for i in fs.get_file_info(FileSelector(path, allow_not_found=True)) if i.is_file
                 and i.base_name.endswith(".parquet") and not i.base_name.startswith((".", "_"))]
        found.sort(key=lambda i: (i.mtime_ns or 0, i.base_name))
        for i in found:
            if i.path not in self.groups:
                with fs.open_input_file(i.path) as f:
                    meta = pq.ParquetFile(f).metadata
                    self.groups[i.path] = [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
        return [(i.path, sum(self.groups[i.path])) for i in found]

    def initialOffset(self) -> dict:
        return {"messages": 0}

    def latestOffset(self) -> dict:
        if self.planned is None:
            self.planned = self._read_progress()
        return {"messages": min(sum(n for _, n in self._files()), self.planned + self.per_poll)}

    def partitions(self, start: dict, end: dict):
        """Ranges of whole row groups, together at most ``per_partition`` messages, or of what the poll takes of a longer one:
        cut further, each task would read that row group again."""
        first, last = start["messages"], end["messages"]
        self.planned = last
        self._write_progress(last)
        out, at = [], 0
        for file, n in self._files():
            low, high = max(first - at, 0), min(last - at, n)
            if low < high:
                out += [_Range(file, a, b) for a, b in self._ranges(file, low, high)]
            at += n
        return out

    def _ranges(self, file: str, low: int, high: int) -> list[tuple[int, int]]:
        """``low`` to ``high`` of a file, cut where row groups end; short row groups side by side are one range."""
        out, at = [], 0
        for n in self.groups[file]:
            a, b = max(low, at), min(high, at + n)
            if a < b:
                if out and b - out[-1][0] <= self.per_partition:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
            at += n
        return out

    def read(self, partition):
        """The messages of one range: only the row groups that hold some are read, a few messages at a time."""
        import pyarrow.parquet as pq

        file, first, last = partition.value
        fs, _ = _filesystem(self.path)
        with fs.open_input_file(file) as f:
            parquet, at = pq.ParquetFile(f), 0
            for g in range(parquet.num_row_groups):
                n = parquet.metadata.row_group(g).num_rows
                if at < last and at + n > first:
                    place = at
                    for batch in parquet.iter_batches(self.per_partition, [g], ["msg_no", "folder", "raw"]):
                        low, high = max(first - place, 0), min(last - place, len(batch))
                        if low < high:
                            yield batch.slice(low, high - low)
                        place += len(batch)
                        if place >= last:
                            break
                at += n


class MailDrop(DataSource):
    """``format("maildrop")``: options ``path``, ``progress``, ``perPoll`` (10) and ``perPartition`` (1000)."""

    @classmethod
    def name(cls):
        return "maildrop"

    def schema(self):
        return RAW_MAIL_SCHEMA

    def streamReader(self, schema):
        return _DropReader(self.options)


def read_mail_polls(spark: SparkSession, path: str, progress: str, per_poll: int = POLL_BATCH,
                    per_partition: int = 1000) -> DataFrame:
    """Stream a folder of parquet files with raw messages, at most ``per_poll`` messages a micro-batch.

    Files are taken in the order of their arrival (time, then name) and must not change once they are there, as files
    that are published by a rename.  ``progress`` is a file beside the query's checkpoint, for this query alone.  A poll reads
    each row group that it takes messages of once: drops with row groups of about ``per_partition`` messages suit it best.
    """
    spark.dataSource.register(MailDrop)
    return (spark.readStream.format("maildrop").option("path", path).option("progress", progress)
            .option("perPoll", str(per_poll)).option("perPartition", str(per_partition)).load())
