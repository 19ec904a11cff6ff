"""The latest value of every key, kept by a stream as a small log-structured
table.

Layout under its folder::

    epoch=N/           keys that micro-batch N changed, with their values
    snapshot=V/        one row per key: everything up to some epoch
    pointer/V.json     {"version": V, "epoch": N}: snapshot V covers epochs up to N

A reader takes the newest pointer, its snapshot and the epochs behind it. A
compaction writes the next snapshot, then publishes its pointer in one step (a
rename), then removes what no reader needs any more: epochs that the pointer
*before* covered, and snapshots older than that one. So a reader that has just
taken the previous pointer still finds its files, and a compaction that dies
anywhere leaves the last published state readable; the next one starts over.

A stream calls ``latest_writer`` from ``foreachBatch``. Every ``compact_every``
batches it compacts, hence a read opens at most one snapshot and
``compact_every`` epochs, however old the stream is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.sources.files import Files


def _pointer(files: Files) -> dict | None:
    """The newest published pointer."""
    names = [n for n in files.names("pointer") if n.endswith(".json")]
    return json.loads(files.read_text(f"pointer/{names[-1]}")) if names else None


def _epochs(files: Files) -> list[int]:
    """Finished epochs (a batch being written has no _SUCCESS yet)."""
    found = [int(n[6:]) for n in files.names() if n.startswith("epoch=") and n[6:].isdigit()]
    return sorted(e for e in found if files.exists(f"epoch={e}/_SUCCESS"))


def _read(spark: SparkSession, files: Files, pointer: dict | None, epochs: Sequence[int], keys: Sequence[str],
          fmt: str) -> DataFrame | None:
    """One row per key over the pointer's snapshot and ``epochs``, with the
    epoch that wrote it."""
    parts = [spark.read.format(fmt).load(files.path(f"snapshot={pointer['version']}"))] if pointer else []
    if epochs:
        deltas = spark.read.format(fmt).option("basePath", files.root).load([files.path(f"epoch={e}") for e in epochs])
        parts.append(deltas.withColumn("epoch", F.col("epoch").cast("long")))
    if not parts:
        return None
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct("epoch", *values), "epoch").alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in values], F.col("r.epoch").alias("epoch"))


def read_latest(spark: SparkSession, path: str, keys: Sequence[str] = ("node", "metric"), ts: str = "ts",
                value: str = "value", fmt: str = "parquet") -> DataFrame:
    """The latest-value table at ``path``: one row per key, of the last batch
    that changed it. Opens one snapshot and the epochs behind it."""
    files = Files(spark, path)
    pointer = _pointer(files)
    rows = _read(spark, files, pointer, [e for e in _epochs(files) if pointer is None or e > pointer["epoch"]], keys, fmt)
    if rows is None:
        raise FileNotFoundError(f"{path} holds no finished batch")
    return rows.select(*keys, ts, value)


def compact_latest(spark: SparkSession, path: str, keys: Sequence[str] = ("node", "metric"), fmt: str = "parquet") -> int | None:
    """Merge the finished epochs into a new snapshot; its version, or None if
    there is nothing to merge. One writer at a time (the stream's own driver)."""
    files = Files(spark, path)
    pointer = _pointer(files)
    epochs = [e for e in _epochs(files) if pointer is None or e > pointer["epoch"]]
    if epochs:
        version = pointer["version"] + 1 if pointer else 1
        _read(spark, files, pointer, epochs, keys, fmt).write.mode("overwrite").format(fmt).save(files.path(f"snapshot={version}"))
        files.publish_text(f"pointer/{version:020d}.json", json.dumps({"version": version, "epoch": epochs[-1]}))
    _clean(files)
    return version if epochs else None


def _clean(files: Files) -> None:
    """Remove what the last two pointers don't need, also what an interrupted
    compaction left: the pointers go last, so that a second try sees the rest."""
    names = [n for n in files.names("pointer") if n.endswith(".json")]
    if len(names) < 2:
        return
    kept = [json.loads(files.read_text(f"pointer/{n}")) for n in names[-2:]]
    for e in _epochs(files):
        if e <= kept[0]["epoch"]:
            files.remove(f"epoch={e}")
    for n in files.names():
        if n.startswith("snapshot=") and int(n[9:]) < kept[0]["version"]:
            files.remove(n)
    for n in names[:-2]:
        files.remove(f"pointer/{n}")


def latest_writer(path: str, keys: Sequence[str] = ("node", "metric"), fmt: str = "parquet",
                  compact_every: int = 20) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. A batch that is run again replaces its own epoch
    only; one that a snapshot covers already is not written again. The folder
    belongs to one run of the stream: its batch numbers must go on (same checkpoint)."""
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        files = Files(spark, path)
        pointer = _pointer(files)
        if pointer is not None and epoch <= pointer["epoch"]:
            return
        batch.write.mode("overwrite").format(fmt).save(files.path(f"epoch={epoch}"))
        if epoch - (pointer["epoch"] if pointer else -1) >= compact_every:
            compact_latest(spark, path, keys, fmt)
    return write
