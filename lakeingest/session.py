"""Session helpers: shared scratch area and conservative session settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Executors can be lost at any time, so intermediate tables and example
    landing zones go to that shared folder, never to a machine-local one. Only in
    local mode, without the setting, a temporary folder is set up.
    """
    try:
        sc = spark.sparkContext
        root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # no SparkContext reachable from this client
        sc, root = None, spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakeingest-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def new_area(spark: SparkSession, label: str) -> str:
    """A fresh, uniquely named folder under the shared root."""
    return f"{shared_root(spark)}/lakeingest/{label}-{uuid.uuid4().hex[:10]}"


LISTING_TASKS_PER_CORE = 4


def prepare(spark: SparkSession) -> None:
    """Settings the engine relies on (only applied when the user left them unset),
    and the package shipped to Python workers."""
    ship_package(spark)
    if spark.conf.get("spark.sql.adaptive.enabled", None) is None:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Spark lists the files of a micro-batch in up to 10,000 tasks: a job of one or two files a task, whose task results
    # outweigh the listing. A few tasks a core list as fast as the cluster can.
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(listing, None) is None:
        spark.conf.set(listing, str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))


# Small metadata files (schema versions, checkpoint tokens) go through the Hadoop
# FileSystem API of the session, so they work on any shared store and cost no job.

def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, or None when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small text file; with ``overwrite=False`` an existing file is an error."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through the session's Hadoop file system."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder through the session's Hadoop file system; anything but success is an error."""
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def set_file_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time (milliseconds since 1970)."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def task_filesystem(uri: str):
    """A pyarrow filesystem and path for ``uri``, for use inside tasks."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (``addPyFile`` of a zip).

    Arrow-batched functions are pickled by reference to their module, so the
    executors must import ``lakeingest``. The zip goes to the shared folder and
    Spark distributes it; once per application and package content.
    """
    import hashlib
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in sorted(os.walk(pkg)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    digest = hashlib.sha256(data).hexdigest()[:16]
    key = f"{sc.applicationId}/{digest}"
    if key in _SHIPPED:
        return
    target = f"{shared_root(spark)}/lakeingest/pkg/lakeingest-{digest}.zip"
    if not path_exists(spark, target):
        fs, p = _fs(spark, target)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
    sc.addPyFile(target)
    _SHIPPED.add(key)
