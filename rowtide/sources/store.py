"""Tables that a stream writes batch by batch, and the log that commits them.

A batch writes its own folders, whole and with overwrite, and is committed by
one small file at the end. A batch that is run again, by a restart or a second
attempt, replaces what it wrote; one that is committed already is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.session import remove

KEPT_ENTRIES = 10


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    fs, target = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its name and then renamed, so that readers see all of it or none."""
    fs, target = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class BatchLog:
    """Which batches are done, with a few facts about the last one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        found = (n.removesuffix(".json") for n in names(self.spark, self.path) if n.endswith(".json"))
        return sorted(int(n) for n in found if n.isdigit())

    def last(self) -> tuple[int, dict]:
        """Number and facts of the last committed batch; -1 and nothing before the first."""
        numbers = self._numbers()
        if not numbers:
            return -1, {}
        return numbers[-1], json.loads(read_text(self.spark, f"{self.path}/{numbers[-1]}.json"))

    def commit(self, number: int, facts: dict) -> None:
        write_text(self.spark, f"{self.path}/{number}.json", json.dumps(facts))
        # Batches are committed in order, so the last entry stands for all before it.
        for old in self._numbers()[:-KEPT_ENTRIES]:
            remove(self.spark, f"{self.path}/{old}.json")


def write_batch(df: DataFrame, path: str, number: int, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """The rows of one batch as a folder of their own, replaced when the batch runs again."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*by) if by else writer).save(f"{path}/batch={number}")


def committed(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table of a flow without what an unfinished batch has written of it."""
    last, _ = BatchLog(spark, f"{out_dir}/commits").last()
    return spark.read.parquet(f"{out_dir}/{name}").filter(F.col("batch") <= last)


class WindowStore:
    """Deduplication windows, a folder per batch, named by its number and the times it covers.

    A delivery can only meet windows opened less than a ttl before or after it,
    so a batch reads the folders whose times come near its own arrivals and of
    their files, ordered by time, the row groups that do, however many keys there
    are. Folders older than the time kept are deleted whole.
    """

    def __init__(self, spark: SparkSession, path: str, key_type: str = "string"):
        self.spark, self.path = spark, path
        self.schema = f"event_id {key_type}, received_at timestamp"

    def _folders(self) -> list[tuple[int, int, int, str]]:
        """Number, first and last microsecond and name of every folder."""
        found = (n for n in names(self.spark, self.path) if n.startswith("batch_"))
        return [(*map(int, n.split("_")[1:]), n) for n in found]

    def near(self, low: int | None, high: int | None, before: int, ttl_seconds: int) -> DataFrame | None:
        """``(event_id, received_at)`` that matter for arrivals from ``low`` to ``high`` microseconds, opened
        by batches before ``before``; None if there are none."""
        if low is None:
            return None
        first, last = low - ttl_seconds * 1_000_000, high + ttl_seconds * 1_000_000
        chosen = [n for number, a, b, n in self._folders() if number < before and a <= last and b >= first]
        if not chosen:
            return None
        there = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in chosen])
        return there.filter(F.col("received_at").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))))

    def add(self, opened: DataFrame, number: int, low: int | None, high: int | None) -> None:
        """The windows of a batch whose arrivals are from ``low`` to ``high``; those of an earlier attempt go."""
        for old, _, _, name in self._folders():
            if old == number:
                remove(self.spark, f"{self.path}/{name}")
        if low is not None:
            rows = opened.select("event_id", "received_at").repartitionByRange("received_at").sortWithinPartitions("received_at")
            rows.write.mode("overwrite").parquet(f"{self.path}/batch_{number}_{low}_{high}")

    def expire(self, before_micros: int) -> None:
        """Delete folders that end before a time."""
        for _, _, high, name in self._folders():
            if high < before_micros:
                remove(self.spark, f"{self.path}/{name}")
