"""Session settings and the shared scratch area for intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on; ``conf`` overrides them.

    Partition counts are left to AQE: it coalesces small shuffle partitions and
    splits skewed joins. Cluster sizing, storage keys and jars belong to
    ``spark-submit`` and are not set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the length of a block; dots are written as double underscores."""
    wanted = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only a local master may run without it; a temporary folder is then made once
    and remembered in the session. On a cluster a machine-local folder would be
    lost with its machine, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    remembered = spark.conf.get("spark.tachyline.localScratch", None)
    if not remembered:
        remembered = tempfile.mkdtemp(prefix="tachyline-")
        spark.conf.set("spark.tachyline.localScratch", remembered)
    return remembered


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch area and read it back.

    Cuts the lineage of a plan that several jobs start from. Unlike a cached
    frame the table outlives lost executors, and later scans still prune columns
    and push filters.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str, codec: str | None = None) -> Iterator[DataFrame]:
    """``stage`` for the length of a block, which must finish all jobs on the table: it is removed afterwards.

    For jobs that run again and again, such as micro-batches. ``codec`` is the compression, if not the session's.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    (df.write.option("compression", codec) if codec else df.write).mode("error").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def freed_shuffles(spark: SparkSession):
    """Shuffle files of a write inside go when it has ended, not when the driver collects garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


@contextmanager
def staged_buckets(df: DataFrame, column: str, name: str) -> Iterator[DataFrame]:
    """``staged`` in as many buckets by ``column`` as a shuffle has partitions: joins on it move the other side only."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
