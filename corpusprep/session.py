"""Session construction and shared-folder helpers.

Scratch tables and checkpoints live under the folder the cluster names in ``spark.checkpoint.dir``. Where
that setting is absent, a session on one machine gets a temporary folder, removed at its end; on a
cluster it is an error.
"""
from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "corpusprep",
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the session's setting, else one we create (tests only)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="corpusprep-ckpt-")  # one machine: driver and executor are one process
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never reused between runs)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/corpusprep/{name}-{uuid.uuid4().hex[:12]}"


def fs_for(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (works for local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_for(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete; False when nothing was there."""
    fs, p = fs_for(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file whole; of several writers of one path exactly one succeeds, the others get FileExistsError.

    The content is written beside the path first. The path itself is then claimed: by a link that fails if the
    name is taken where the file system is local, else by a rename that does not overwrite.
    """
    jvm = spark.sparkContext._jvm
    fs, target = fs_for(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8", "surrogatepass")))
    finally:
        out.close()
    try:
        if target.toUri().getScheme() in (None, "file") and fs.getUri().getScheme() == "file":
            link = jvm.java.nio.file.Files.createLink
            nio = lambda p: jvm.java.nio.file.Path.of(jvm.java.net.URI.create("file://" + p.toUri().getPath().replace(" ", "%20")))
            try:
                link(nio(target), nio(part))
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in str(e.java_exception):
                    raise FileExistsError(path) from None
                raise
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            try:
                context.rename(part, target, options)
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in str(e.java_exception):
                    raise FileExistsError(path) from None
                raise
    finally:
        fs.delete(part, False)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = fs_for(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, without hidden ones and unfinished parts."""
    fs, p = fs_for(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if not st.isDirectory()]
    return [n for n in names if not n.startswith((".", "_")) and not n.endswith(".part")]


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusprep`` importable in Python workers (Arrow UDFs reference its functions).

    The package is zipped on the driver, written through the Hadoop FileSystem into the shared
    folder, and registered with ``addPyFile`` - the runtime form of ``--py-files``. Once per
    SparkContext.
    """
    import io
    import zipfile

    import corpusprep

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(corpusprep.__file__))
    base = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    target = shared_path(spark, "pyfiles") + "/corpusprep.zip"
    fs, p = fs_for(spark, target)
    out = fs.create(p, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(key)
