"""Session checks, the shared work folder, and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

#: How rows of long texts are written, such as whole messages. Parquet looks at the size of a row group
#: only after 100 rows, and a row group of up to 4096 rows is read at once: gigabytes of such texts.
#: Its default codec takes a page as a whole, in memory beside the heap. So each of these rows is a page
#: and a row group of its own, the codec is one that streams, and no copies are made of ``data`` to tell its
#: least and highest value.
LONG_TEXTS = {"parquet.block.row.count.limit": "1", "parquet.page.size.row.check.min": "1",
              "parquet.enable.dictionary#data": "false",
              "parquet.column.statistics.enabled#data": "false", "compression": "zstd"}

_own_folders: dict[str, str] = {}
_shipped: set[str] = set()


def utc_session(spark: SparkSession) -> SparkSession:
    """Dates are taken from timestamps in many places, so the session must run on UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it; it then gets a folder below its warehouse folder, which
    is removed when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        own = f"{warehouse}/tidemark-{context.applicationId}"
        if own.startswith(("file:", "/")):
            atexit.register(shutil.rmtree, own.removeprefix("file:"), ignore_errors=True)
        _own_folders[context.applicationId] = own
    return _own_folders[context.applicationId]


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, unless they can import it anyway.

    For sessions whose executors neither start in the folder of the package nor have it on their
    path nor installed. Once for each application.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    home = os.path.dirname(package)
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    installed = os.path.basename(home) in ("site-packages", "dist-packages")
    context = spark.sparkContext
    if installed or home in map(os.path.abspath, known) or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    archive = os.path.join(context._temp_dir, "tidemark.zip")  # Spark's own; it serves the file
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, home))
    context.addPyFile(archive)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Later passes then neither recompute it nor depend on executors that may be lost, read only
    the columns they need, and know its size when they choose a join.
    """
    folder = folder or new_folder(df.sparkSession, "kept")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialized_texts(df: DataFrame, folder: str) -> DataFrame:
    """As :func:`materialized`, for rows that hold long texts."""
    df.write.options(**LONG_TEXTS).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session for as long as the block lasts."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def utc_now() -> datetime:
    return datetime.now(UTC)
