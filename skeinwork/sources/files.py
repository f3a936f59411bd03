"""Small files beside tables, by Hadoop's file system API, so that every store that Spark reaches will do; and intermediate tables."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm, self._gateway, self._conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, name: str, text: str, overwrite: bool) -> None:
        """Write beside it, then rename in one step: a reader sees all of it or none, and so does one after a crash."""
        aside = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        how = self._jvm.org.apache.hadoop.fs.Options.Rename
        hows = self._gateway.new_array(how, 1)
        hows[0] = how.OVERWRITE if overwrite else how.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(aside, self._at(name), hows)
        except Exception:
            self._fs.delete(aside, False)
            raise

    def create(self, name: str, text: str) -> bool:
        """Write a file that is not there yet; False if another writer was first."""
        if self.exists(name):
            return False
        try:
            self._put(name, text, overwrite=False)
        except Exception as e:  # py4j wraps FileAlreadyExistsException
            if "Exist" in str(e):
                return False
            raise
        return True

    def replace(self, name: str, text: str) -> None:
        self._put(name, text, overwrite=True)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write_json(self, name: str, value) -> None:
        self.replace(name, json.dumps(value, indent=1, sort_keys=True))

    def read_json(self, name: str):
        return json.loads(self.read(name))


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; set here only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="skeinwork-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Kept:
    """A DataFrame written to the shared folder: it stays as it is whatever becomes of its sources or of an executor."""

    def __init__(self, df: DataFrame, name: str) -> None:
        spark = df.sparkSession
        self._folder = Folder(spark, f"{shared_folder(spark)}/skeinwork/{name}-{uuid.uuid4().hex}")
        df.write.option("compression", "zstd").parquet(self._folder.path)
        self.rows = spark.read.schema(df.schema).parquet(self._folder.path)

    def release(self) -> None:
        self._folder.delete("")
