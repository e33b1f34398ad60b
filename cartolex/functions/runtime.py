"""Session helpers: where intermediate results may be kept, and how they are kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir` of the session.

    A machine-local folder is made only where the setting is absent and the session is local, as in tests; on a cluster
    no such folder is shared, so the setting is asked for.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = getattr(spark, "_cartolex_dir", None)
    if own is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="cartolex-")
        spark._cartolex_dir = own
    return own


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor, and several readers
    do not repeat the work behind `df`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cartolex/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cartolex_path = path
    return out


def discard(written: DataFrame) -> None:
    """Delete what `materialise` wrote, once all that was derived from it is written itself."""
    path = written.sparkSession._jvm.org.apache.hadoop.fs.Path(written._cartolex_path)
    path.getFileSystem(written.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many parts as there are cores, where its files split into fewer than that.

    For steps whose work is in Python. The input of a cluster splits into more parts than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
