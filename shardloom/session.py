"""Session helpers: shipping the package to workers and the shared scratch folder."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from shardloom.sources.paths import resolve

# Python gets rows in batches of so many bytes. Spark's own 64 MB become several times as much in a
# worker, where bytes turn into 64-bit numbers, and executors have a worker for each core and function.
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_OWN = "67108864b"

_shipped: set[str] = set()
_registered: set[str] = set()
_scratch_dirs: list[str] = []


def attach(spark: SparkSession) -> SparkSession:
    """Make the package importable in every Python worker and register its data source.

    The first is what ``--py-files`` does; here it also serves a driver that found the
    package through its own ``sys.path``. Batches for Python are held to ``BATCH_BYTES`` where
    the session leaves Spark's default.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = scratch(spark, "package")
        fs, path = resolve(folder)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/shardloom.zip") as out:
            out.write(_archive())
        context.addPyFile(f"{folder}/shardloom.zip")
        _shipped.add(context.applicationId)
    session = spark._jsparkSession.sessionUUID()
    if session not in _registered:
        from shardloom.sources.npy import TokenShardSource

        spark.dataSource.register(TokenShardSource)
        if spark.conf.get(_BATCH, _SPARKS_OWN) == _SPARKS_OWN:
            spark.conf.set(_BATCH, str(BATCH_BYTES))
        _registered.add(session)
    return spark


def _archive() -> bytes:
    root = os.path.dirname(os.path.abspath(__file__))
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(root)))
    return content.getvalue()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the storage every executor can reach.

    Only a local session may fall back to a temporary folder; a cluster must name one.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    folder = f"{base.rstrip('/')}/shardloom-{uuid.uuid4().hex}/{name}"
    if not _scratch_dirs:
        atexit.register(_drop_scratch)
    _scratch_dirs.append(folder.rsplit("/", 1)[0])
    return folder


def written(df: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to ``path``, or to the scratch folder, and read it back."""
    path = path or scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop_scratch() -> None:
    for folder in _scratch_dirs:
        try:
            fs, path = resolve(folder)
            fs.delete_dir(path)
        except (OSError, ImportError):
            pass
