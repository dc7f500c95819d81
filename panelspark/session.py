"""Session helpers: the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}  # removed when the process ends


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; elsewhere a missing setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.TemporaryDirectory(prefix="panelspark-", ignore_cleanup_errors=True)
    return _LOCAL_FOLDERS[app].name


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_BUCKETED: set[str] = set()


def materialise_bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """As :func:`materialise`, laid out by a hash of ``column``: what groups, joins or windows by it needs no shuffle."""
    spark, ident = df.sparkSession, uuid.uuid4().hex
    name, path = f"table_{ident}", f"{shared_folder(spark)}/table-{ident}"
    spread = df.repartition(buckets, column)  # a file for each bucket
    spread.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(name)
    _BUCKETED.add(name)
    return spark.read.table(name)


def release(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialise` and :func:`materialise_bucketed` wrote, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        root = shared_folder(spark)
        for file in df.inputFiles():
            name = re.search(r"/table-[0-9a-f]{32}(?=/)", file)
            if name:
                path = jvm.org.apache.hadoop.fs.Path(root + name[0])
                path.getFileSystem(conf).delete(path, True)
                listed = name[0].strip("/").replace("-", "_")
                if listed in _BUCKETED:
                    spark.sql(f"DROP TABLE IF EXISTS {listed}")
                    _BUCKETED.discard(listed)
                break


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    """SQL settings that hold for the jobs started inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Tasks behind a shuffle by their size, not about one a core: a single one more than cores would double a step's time.
SIZED_TASKS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": False,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once for each application: their Python path need not hold it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.TemporaryDirectory(prefix="panelspark-zip-", ignore_cleanup_errors=True)
    target = Path(folder.name) / f"{package.name}.zip"  # handed out by the driver
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED[app] = folder
