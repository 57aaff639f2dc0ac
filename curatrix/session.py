"""Session helpers: test sessions, the shared checkpoint folder, and size-checked broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(name: str = "curatrix", cores: int = 4, partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Where the setting is absent, a temporary folder is made on a local master only; on a cluster
    its absence is an error, since a machine-local folder would not survive the loss of a machine.
    """
    jsc = spark.sparkContext._jsc
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rsplit("/", 1)[0]
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="curatrix-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later stages survive the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), made: list[str] | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back (columnar and compressed, pruned on read).

    The path is added to ``made``, for a caller that removes it when it is no longer needed.
    """
    path = scratch_path(df.sparkSession, label)
    if made is not None:
        made.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64_000_000) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if it has at most max_rows rows of max_bytes, else df as it is: then the join shuffles.

    Rows and the bytes of texts, arrays and maps are counted (of at most max_rows + 1 rows), so the bound holds whatever the
    statistics say.
    """
    sizes = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            sizes = sizes + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            sizes = sizes + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            sizes = sizes + 8
    n, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(sizes)).first()
    if n <= max_rows and (size or 0) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of the shared file system; nothing if it is not there."""
    where, files = _file_system(spark, path)
    files.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in the shared file system, which is there whole or not at all."""
    where, files = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part-{uuid.uuid4().hex}")
    out = files.create(part, True)
    out.write(text.encode())
    out.close()
    files.delete(where, False)
    if not files.rename(part, where):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _file_system(spark, path)
    source = files.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of the shared file system, sorted; none if it is not there."""
    where, files = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def give_back_memory(spark: SparkSession) -> str:
    """Gives back broadcasts and shuffle files of plans that are gone, and the native memory that the driver's allocator holds unused.

    Spark removes the former only after a collection, and the C library keeps what planning and compiling freed, so both grow over
    a job of many small queries. Returns the JVM's report on the latter; "" if it has no such command (HotSpot on glibc has, from 17.0.9).
    """
    gc.collect()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    jvm.System.gc()

    def array(kind, values: list):
        out = gateway.new_array(kind, len(values))
        for k, value in enumerate(values):
            out[k] = value
        return out

    try:
        named, command = jvm.java.lang.Class.forName, jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        kinds = array(jvm.java.lang.Class, [named(c) for c in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")])
        # by the interface, as the server's own class is closed to reflection
        invoke = named("javax.management.MBeanServer").getMethod("invoke", kinds)
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return invoke.invoke(server, array(jvm.java.lang.Object, [command, "systemTrimNativeHeap", None, None])).strip()
    except Py4JError:
        return ""


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a context, so that they need no path of the driver's machine."""
    context = spark.sparkContext
    if getattr(context, "_curatrix_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="curatrix-"), "curatrix.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("curatrix", os.path.relpath(path, package)))
    context.addPyFile(archive)
    context._curatrix_shipped = True


def arrow_safe(frame):
    """frame, or an empty one with plain object columns: of no values pandas makes numbers, which Arrow won't take for text."""
    return frame if len(frame) else frame.astype(object)
