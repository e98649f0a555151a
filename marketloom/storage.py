"""Small helpers on the Hadoop file systems Spark already talks to."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any URI Spark can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return bool(fs.exists(target))


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file and the folders above it; False where the file exists."""
    fs, target = hadoop_path(spark, path)
    try:
        fs.create(target, False).close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, without hidden and bookkeeping entries."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def entries(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """(name, path, is a folder) of what lies directly below a folder, without hidden entries."""
    fs, target = hadoop_path(spark, path)
    found = [(s.getPath().getName(), s.getPath().toString(), bool(s.isDirectory())) for s in fs.listStatus(target)]
    return [e for e in found if not e[0].startswith(("_", "."))]


def read_partitions(spark: SparkSession, path: str, schema: StructType | None, column: str,
                    values: Sequence) -> DataFrame | None:
    """Rows of the named partitions; None where the table holds none of them.

    Only those folders are listed and read, however many the table has. Without
    a schema that of the files is taken.
    """
    names = [f"{column}={NULL_PARTITION if v is None else v}" for v in values]
    paths = [p for p in (f"{path}/{n}" for n in names) if exists(spark, p)]
    if not paths:
        return None
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*paths)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
