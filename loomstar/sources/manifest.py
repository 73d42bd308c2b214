"""Load manifests (C-11): which datasets of a load are finished, and from what.

An entry is one small JSON file per finished dataset: its name, the fingerprint of its source, its
folder, its row count and state.  It is written after the dataset's own commit, under a name of
its own, and never changed; the entry with the latest time counts.  So a load that
is killed anywhere leaves either a finished dataset with its entry, or none, and a later
load goes on from there.  Files are written and listed through the file system that
Spark uses for the folder.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def source_files(df: DataFrame) -> list[tuple[str, int, int]]:
    """(name, bytes, time) of the files that ``df`` reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        found.append((name, status.getLen(), status.getModificationTime()))
    return found


def source_fingerprint(df: DataFrame, files: list[tuple[str, int, int]] | None = None) -> str | None:
    """A digest of the files that ``df`` reads (names, lengths, times) and of its columns; None without files."""
    files = source_files(df) if files is None else files
    if not files:
        return None
    digest = hashlib.sha256(json.dumps(df.schema.jsonValue()).encode())
    for name, length, modified in files:
        digest.update(f"{name}|{length}|{modified}\n".encode())
    return digest.hexdigest()


class LoadManifest:
    """The entries under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path))

    def _rows(self, folder: str) -> int:
        # a column that isn't there: counting reads footers only, and a folder without files has no rows
        return self.spark.read.schema("_none int").parquet(folder).count()

    def enter(self, dataset: str, fingerprint: str | None, folder: str) -> None:
        """Enter a dataset whose folder has been committed."""
        entry = {"dataset": dataset, "fingerprint": fingerprint, "folder": folder, "state": "finished",
                 "rows": self._rows(folder), "time": time.time_ns()}
        name = f"{dataset}-{uuid.uuid4().hex}.json"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        draft, final = hadoop(self._path, f"_{name}"), hadoop(self._path, name)
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if not self._fs.rename(draft, final):  # an entry is there whole or not at all
            raise RuntimeError(f"could not enter {dataset} in {self.folder}")

    def finished(self) -> dict[str, dict]:
        """dataset -> its latest entry."""
        if not self._fs.exists(self._path):
            return {}
        found = self.spark.read.schema("dataset string, fingerprint string, folder string, state string, rows long, time long") \
            .json(self.folder).collect()  # one row per load of a dataset
        return {r["dataset"]: r.asDict() for r in sorted(found, key=lambda r: r["time"]) if r["state"] == "finished"}

    def intact(self, entry: dict) -> bool:
        """Whether an entry's folder is there with the rows it had."""
        return self._exists(entry["folder"]) and self._rows(entry["folder"]) == entry["rows"]

    def new_folder(self, path: str) -> str:
        """``path``, or beside it the first name that no earlier attempt has taken."""
        k, name = 1, path
        while self._exists(name):
            k, name = k + 1, f"{path}-{k + 1}"
        return name
