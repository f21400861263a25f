"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # as JSON readers commonly do, the last of repeated keys counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str | None = None, app: str = "paylake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the job settings.

    ``shuffle_partitions`` is meant for tests on one machine; on a cluster
    leave it unset and let AQE coalesce the default partition count.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (UTC, dynamic overwrite)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode", "spark.sql.variant.allowDuplicateKeys"):
        if spark.conf.get(k, None) != JOB_CONF[k]:
            spark.conf.set(k, JOB_CONF[k])
    checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach and it is
    used as is.  Only when it is unset (tests on one machine) a local folder is
    created and registered as the checkpoint folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_CONF, None)
    if not path and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    key = id(sc)
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="paylake-ckpt-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(_LOCAL_DIRS[key])
    return _LOCAL_DIRS[key]


def work_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A folder for written tables below the shared checkpoint folder."""
    base = f"{checkpoint_dir(spark)}/paylake/{name}"
    return f"{base}/{uuid.uuid4().hex}" if unique else base


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists; storage errors are raised, not read as absence."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none where the folder does not exist."""
    if not path_exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p))


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the work folder (tables that nothing reads any more)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (a commit record) through Hadoop's file system."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing one that is there; readers see the old or the new one whole."""
    fs, target = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    _put(fs, aside, text)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, target, _rename(spark, "OVERWRITE"))


def _put(fs, path, text: str) -> None:
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _rename(spark: SparkSession, option: str):
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    out = spark.sparkContext._gateway.new_array(options, 1)
    out[0] = getattr(options, option)
    return out


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole, only if none is there yet; whether this call did it.

    The text is written aside and moved: by a hard link on a local file system, elsewhere by a
    rename that does not overwrite (atomic on HDFS).  A store without an atomic rename is not
    fit for several writers.
    """
    fs, target = _fs(spark, path)
    aside = f"{path}.{uuid.uuid4().hex}"
    _, source = _fs(spark, aside)
    fs.mkdirs(target.getParent())
    _put(fs, source, text)
    jvm = spark._jvm
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, source)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(source, target, _rename(spark, "NONE"))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(source, False)
