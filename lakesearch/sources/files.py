"""Small file-system steps on the driver: exists, list, rename, a text file.

They go through Hadoop's FileSystem, so any scheme that Spark reads works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out by `key` if the input has fewer splits than there are cores.

    A lone Parquet file with one row group is read by one task, and everything up to
    the next shuffle would run there too. Inputs of many files are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


#: Whether Spark deletes the shuffle files of an execution at its end.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", **options: str) -> None:
    """Write the rows, texts a third smaller than by Spark's default codec.

    The shuffle files of this one write go with it; else they would stay until the driver
    happens to collect its garbage, and those of a whole refresh would add up.
    """
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, "false")
    conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.mode(mode).options(compression="zstd", **options).partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(_SHUFFLES_GO, before)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that the rows come from."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in df.inputFiles()]
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def list(self, path: str) -> list[str]:
        """Names directly below `path`."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def modified_ms(self, path: str) -> int:
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def size(self, path: str) -> int:
        """Bytes of all files below `path`."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def rename(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Write a file that does not exist yet; it appears complete or not at all."""
        beside = path + ".tmp"
        stream = self._fs.create(self._path(beside), True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        self.rename(beside, path)
