"""Session settings and the shared work folder for intermediate tables."""

import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app_name: str = "tickloom", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC times and adaptive execution on; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Looking up the Python call site of every column costs more than planning does.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` where the cluster
    sets it. Only a local session may fall back on a temporary folder."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tickloom-")
    return _local_dirs[sc.applicationId]


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, so that functions that
    run in Python find them wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tickloom-code-")) / "tickloom-modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def send_by_value(*modules: str) -> None:
    """Let classes and functions of ``modules`` travel whole: the process that asks a stateful
    operator for its state runs beside the driver and gets no files."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Spark's own setting to remove the shuffle files of a query when it ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet and remove the shuffle files of the write when it has ended. The setting holds for
    the write alone, as tables that are computed again need their shuffles."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_passing: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and read it back.

    Used where a result is scanned several times. Unlike a cache it survives lost
    executors, and later scans read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    write_once(df, path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    if (tables := _passing.get()) is not None:
        tables.append(table)
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` has written, once nothing reads it any more."""
    if path := _paths.pop(table, None):
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored_alone(step: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """The result of ``step()``, stored; the tables that it has stored on its way are removed."""
    before = _passing.set(tables := [])
    try:
        df = step()
    finally:
        _passing.reset(before)
    result = stored(df, name)
    for table in tables:
        discard(table)
    return result
