"""Session settings and the shared folder for materialised tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Settings that answers depend on.
SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true", "spark.sql.session.timeZone": "UTC"}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on.

    Repeated keys in a JSON object resolve to the last one instead of making
    the document unreadable; times are formatted and parsed in UTC.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def check_settings(spark: SparkSession) -> None:
    """Raise when the session would give other answers than the operators promise."""
    wrong = {n: v for n, v in SETTINGS.items() if str(spark.conf.get(n)).lower() != v.lower()}
    if wrong:
        raise ValueError(f"call rowtide.session.configure first; the session needs {wrong}")


def tune(spark: SparkSession) -> SparkSession:
    """A setting that makes classification faster, for sessions that do little else.

    Wide stages generate code per projection: fused into one method, the checks
    of a message exceed what the JVM compiles to machine code (measured: 9 s
    against 16 s for 1.3 million messages). Narrow stages stay fused.
    """
    spark.conf.set("spark.sql.codegen.maxFields", "20")
    return spark


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Inside the block no stage is fused into a method that the JVM would not compile.

    For long batch jobs with wide projections: such methods are interpreted for
    every row. Micro-batches have code of their own each and gain nothing.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder for materialised tables: the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh temporary folder; a
    cluster session must name one, since executors cannot see the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context = spark.sparkContext
    if not getattr(context, "_rowtide_dir", None):
        # The setting itself cannot be changed in a running session.
        context._rowtide_dir = tempfile.mkdtemp(prefix="rowtide-")
    return context._rowtide_dir


_SCRATCH: ContextVar[list[str] | None] = ContextVar("rowtide_scratch", default=None)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage and survives lost executors; later readers prune columns
    and push filters into the files instead of decoding JSON again. Inside
    :func:`scratch` the table lives until the end of the block.
    """
    path = f"{shared_dir(df.sparkSession)}/rowtide/{label}-{uuid.uuid4().hex}"
    made = _SCRATCH.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that :func:`materialize` writes inside the block when it ends.

    Results must be written or counted inside it, since DataFrames read those
    tables lazily. Every micro-batch of a stream runs in such a block.
    """
    outer = _SCRATCH.set(made := [])
    try:
        yield
    finally:
        _SCRATCH.reset(outer)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote and nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove(df.sparkSession, folder)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers are looked up there by module name, and
    an executor need not have the package installed.
    """
    context = spark.sparkContext
    if getattr(context, "_rowtide_shipped", False):
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="rowtide-package-")) / "rowtide.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._rowtide_shipped = True
