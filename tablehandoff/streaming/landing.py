"""Landing directories as streams: wait for a file, load files, skip known content."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablehandoff import storage
from tablehandoff.functions.text import content_hash
from tablehandoff.session import work_folder
from tablehandoff.sinks import tables, versions
from tablehandoff.sources import files

# Patience and poll interval in seconds.
WAIT_SECONDS, POLL_SECONDS = 300, 10

# Batches whose hashes lie in folders of their own before they are merged.
STATE_BATCHES = 16

_BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def _glob(prefix: str) -> str:
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", prefix) + "*"


def landing_files(spark: SparkSession, directory: str, prefix: str) -> DataFrame:
    """Stream of the files themselves (path, modificationTime, length, content)."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("pathGlobFilter", _glob(prefix))
        .load(directory)
    )


def landing_rows(
    spark: SparkSession,
    directory: str,
    prefix: str,
    schema: str | T.StructType,
    fmt: str = "csv",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of the rows in files whose name starts with ``prefix``, with ``file_name``."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", _glob(prefix))
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"')
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(directory).select(
        "*", F.col("_metadata.file_name").alias("file_name")
    )


def watch_landing(
    spark: SparkSession,
    directory: str,
    prefix: str,
    timeout_s: float = WAIT_SECONDS,
    poll_s: float = POLL_SECONDS,
) -> str:
    """Waits until a file with the prefix is there and returns its full path.

    Polls the directory itself: a stream would never report a file without content. The
    error of a timeout names prefix and directory.
    """
    deadline = time.monotonic() + timeout_s
    while True:
        path = files.landing_lookup(spark, directory, prefix)
        if path is not None:
            return path
        left = deadline - time.monotonic()
        if left <= 0:
            raise TimeoutError(
                f"no file starting with '{prefix}' appeared in {directory} within {timeout_s:g}s"
            )
        time.sleep(min(poll_s, left))


def batch_name(checkpoint: str, batch_id: int) -> str:
    """A name for a micro-batch that no stream with another checkpoint has."""
    return f"{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}-{batch_id}"


def stream_upload(
    rows: DataFrame, target: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Every micro-batch becomes a partition ``batch`` of the target table.

    A replayed batch overwrites its own partition, so rows are neither lost nor doubled. The
    partition names the checkpoint as well: a stream with another checkpoint starts at batch 0
    again and must not replace what is loaded.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        tables.append_history(batch, target, batch_name(checkpoint, batch_id))

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _base(state: str) -> str:
    return f"{state.rstrip('/')}/_base"


def seen_hashes(spark: SparkSession, state: str, own: str) -> DataFrame | None:
    """The hashes recorded by all batches but ``own``: merged ones, and those of single batches."""
    parts = []
    if versions.current(spark, _base(state)) is not None:
        parts.append(versions.read_current(spark, _base(state)))
    if any(n.startswith("batch=") for n in storage.folder_names(spark, state)):
        recent = spark.read.schema("hash STRING, batch STRING").parquet(state)
        parts.append(recent.where(F.col("batch") != own).select("hash"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def compact_hashes(spark: SparkSession, state: str, own: str, most: int = STATE_BATCHES) -> None:
    """Merges the folders of earlier batches into one table once there are more than ``most``.

    The folder of ``own`` stays, since its batch may be replayed. The merged table becomes
    current by one rename and folders go after that: a stop in between leaves a hash twice,
    which changes nothing.
    """
    folders = [n for n in storage.folder_names(spark, state) if n.startswith("batch=")]
    if len(folders) <= most:
        return
    merged = seen_hashes(spark, state, own)
    if merged is None:
        return
    versions.replace(merged.distinct(), _base(state))
    for name in folders:
        if f"{state.rstrip('/')}/{name}" != storage.partition_folder(state, "batch", own):
            storage.delete(spark, f"{state.rstrip('/')}/{name}")


def skip_identical(
    stream: DataFrame, target: str, state: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Appends (path, hash, content) of files whose content was not seen before.

    The hashes seen live in a table, so the stream itself keeps no growing state. Hashes
    recorded by the same batch are ignored: they come from an attempt that is being
    replayed and will be overwritten. The bytes of a file are read and hashed once, into a
    folder of the batch; what is new is taken from there.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, batch_name(checkpoint, batch_id)
        staged = work_folder(spark, "arrived")
        batch.select("path", "content", content_hash(F.col("content")).alias("hash")).write.parquet(staged)
        arrived = spark.read.parquet(staged)
        # Of equal files in one batch the first path counts; contents stay out of the shuffle.
        first = arrived.groupBy("hash").agg(F.min("path").alias("path"))
        known = seen_hashes(spark, state, own)
        if known is not None:
            first = first.join(known, "hash", "left_anti")
        first = first.checkpoint()
        new = arrived.join(first, ["hash", "path"], "left_semi")
        tables.append_history(new, target, own)
        tables.append_history(first.select("hash"), state, own)
        compact_hashes(spark, state, own)
        storage.delete(spark, staged)

    work_folder(stream.sparkSession, "skip")  # names the checkpoint folder of the session
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_per_branch(
    pushes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Streaming twin of ``latest_per_key``; write it in update mode.

    The state is one row per branch.
    """
    rest = [c for c in pushes.columns if c not in keys]
    last = pushes.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_last")
    )
    return last.select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in pushes.columns]
    )
