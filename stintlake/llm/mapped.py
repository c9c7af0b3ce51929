"""Tables of the shared folder as memory-mapped arrays beside each executor.

Spark writes a table sorted; its files go straight from the shared folder to every executor
(``addFile``), where the first worker that needs them lays the columns out as flat arrays in the
executor's own folder for shipped files. All workers of an executor map the same arrays, so a
table may be larger than the memory of a worker. A new executor fetches the files anew.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import SparkSession

_ENDS = ".ends"


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files of a written table, with their bytes, in the order of their tasks."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(s.getPath(), s.getLen()) for s in fs.listStatus(folder)]
    return sorted((p.toString(), n) for p, n in found if p.getName().startswith("part-"))


class MappedTable:
    """A handle that tasks take along; :meth:`column` works in a task, after :func:`send`."""

    def __init__(self, names: list[str]):
        self.names, self.tag = names, uuid.uuid4().hex
        self._open: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {"names": self.names, "tag": self.tag, "_open": {}}

    def _path(self, column: str) -> str:
        return os.path.join(SparkFiles.getRootDirectory(), f"{self.tag}-{column}")

    def _map(self, column: str, kind: str) -> np.ndarray:
        if column not in self._open:
            path = self._path(column)
            if not os.path.exists(path):
                self._lay_out(column.removesuffix(_ENDS))
            empty = os.path.getsize(path) == 0
            self._open[column] = np.zeros(0, kind) if empty else np.memmap(path, kind, "r")
        return self._open[column]

    def _lay_out(self, column: str) -> None:
        """Write a column as one flat array; of texts, their bytes and the ends of each."""
        own = uuid.uuid4().hex
        data, ends = self._path(f"{own}-{column}"), self._path(f"{own}-{column}{_ENDS}")
        total = 0
        with open(data, "wb") as values, open(ends, "wb") as places:
            for name in self.names:
                source = pq.ParquetFile(SparkFiles.get(name))
                for batch in source.iter_batches(columns=[column]):
                    array = batch.column(0)
                    if pa.types.is_string(array.type) or pa.types.is_binary(array.type):
                        array = array.cast(pa.large_binary())
                        at = np.frombuffer(array.buffers()[1], np.int64)[array.offset:][:len(array) + 1]
                        values.write(memoryview(array.buffers()[2] or b"")[at[0]:at[-1]])
                        places.write((at[1:] - at[0] + total).tobytes())
                        total += int(at[-1] - at[0])
                    else:
                        values.write(array.to_numpy(zero_copy_only=False).tobytes())
        os.replace(ends, self._path(column + _ENDS))
        os.replace(data, self._path(column))

    def column(self, name: str, kind: str) -> np.ndarray:
        return self._map(name, kind)

    def texts(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and the end of each."""
        data = self._map(name, "u1")
        return data, self._map(name + _ENDS, "i8")


def send(spark: SparkSession, path: str) -> MappedTable:
    """Have the files of a written table fetched by every executor."""
    files = files_of(spark, path)
    for file, _ in files:
        spark.sparkContext.addFile(file)
    return MappedTable([os.path.basename(f) for f, _ in files])
