"""Metadata calls on the shared file system: look up, rename, small text files.

Only names and a few hundred bytes of JSON pass through here. Rows are read and written by Spark.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from topicflow.errors import InvalidName, NoSharedFolder


class Store:
    """The Hadoop file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        if re.search(r"[,{}*?\[\]]", root):
            raise InvalidName(f"folder {root!r}: commas, brackets and wildcards cannot be used")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._commons = spark._jvm.org.apache.commons
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._path(root).toUri(), conf)
        rename = getattr(self._hadoop, "Options$Rename")
        self._no_overwrite = spark.sparkContext._gateway.new_array(rename, 0)
        self._overwrite = spark.sparkContext._gateway.new_array(rename, 1)
        self._overwrite[0] = rename.OVERWRITE

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of the children of ``path``. One call, however many there are."""
        if not self.exists(path):
            return []
        listed = self._hadoop.FileUtil.stat2Paths(self._fs.listStatus(self._path(path)))
        text = self._commons.lang3.ArrayUtils.toString(listed)
        return re.findall(r"/([^/,{}]+)(?=[,}])", text)

    def commit(self, source: str, target: str) -> bool:
        """Rename ``source`` to ``target``; False, changing nothing, when ``target`` exists."""
        self.mkdirs(target.rpartition("/")[0])
        qualified = [self._fs.makeQualified(self._path(p)) for p in (source, target)]
        try:
            self._context.rename(*qualified, self._no_overwrite)
        except Exception:
            if self.exists(target) and self.exists(source):
                return False
            raise
        return True

    def commit_text(self, path: str, text: str) -> bool:
        """Create a small file in one step; False when it exists."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.write_text(draft, text)
        done = self.commit(draft, path)
        if not done:
            self.drop(draft)
        return done

    def replace_text(self, path: str, text: str) -> None:
        """Write a small file in one step, over an older one if there is one."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.write_text(draft, text)
        self._context.rename(*(self._fs.makeQualified(self._path(p)) for p in (draft, path)), self._overwrite)

    def text_if_there(self, path: str) -> str | None:
        """The text of a small file, or None when there is no such file."""
        try:
            return self.read_text(path)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() in ("FileNotFoundException", "NoSuchFileException"):
                return None
            raise

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def drop(self, path: str) -> None:
        """Remove something this library has just written (staging, drafts)."""
        self._fs.delete(self._path(path), True)


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the one in ``spark.checkpoint.dir``.

    Where it is unset, a program that runs in one process gets a temporary folder; a cluster has to name one.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = _LOCAL_FOLDERS.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="topicflow-")
        _LOCAL_FOLDERS[context.applicationId] = folder
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name inside the shared folder."""
    return f"{shared_folder(spark)}/topicflow/{label}-{uuid.uuid4().hex}"


def written_once(frame: DataFrame) -> DataFrame:
    """``frame`` with its partitions fixed on shared storage, so that later jobs see the same ones."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame, folder: str) -> DataFrame:
    """``frame`` written to ``folder`` and read back: later steps start from the files."""
    frame.write.mode("overwrite").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
