"""Dataset versions and lineage (V3, V4).

A version is a Parquet folder under a shared root; the lineage table is an
append-only Parquet folder beside it. "Overwrite" writes a new folder and
appends a row that repoints the key, so no job ever reads and overwrites the
same path.
"""

from __future__ import annotations

import datetime as _dt
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE_SCHEMA = ("key string, label string, path string, n_rows long, n_cols int, source_key string, "
                  "transform string, created_at timestamp_ntz, seq long")


def descriptive_key(action: str, columns=None, method: str | None = None) -> str:
    """Readable key stem: operation (+ method) + at most two column stems."""
    parts = [action] + ([method] if method else [])
    for c in list(columns or [])[:2]:
        parts.append(re.sub(r"[^0-9a-zA-Z]+", "_", str(c)).strip("_")[:16])
    return re.sub(r"_+", "_", "_".join(parts)).lower()


class VersionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.lineage_path = f"{self.root}/_lineage"

    def history(self) -> DataFrame:
        """All lineage rows; none only where the lineage folder doesn't exist yet. Any other failure to read is raised."""
        if not self._exists(self.lineage_path):
            return self.spark.createDataFrame([], LINEAGE_SCHEMA)
        return self.spark.read.parquet(self.lineage_path).orderBy("seq")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _claim(self) -> int:
        """A sequence number of this writer's own: the folder that marks it is created, and creating it fails for all but one."""
        seq = self._next_seq()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(path(f"{self.root}/_claims"))
        while True:
            mark = path(f"{self.root}/_claims/{seq}")
            try:
                fs.create(mark, False).close()
                return seq
            except Py4JJavaError:
                if not fs.exists(mark):
                    raise
                seq += 1

    def current(self, seq: int | None = None) -> DataFrame:
        """Latest row per key (an overwrite repoints a key), as of sequence number ``seq`` if given."""
        h = self.history()
        if seq is not None:
            h = h.where(F.col("seq") <= seq)
        return h.groupBy("key").agg(F.max_by(F.struct(*h.columns), "seq").alias("r")).select("r.*")

    def _next_seq(self) -> int:
        r = self.history().agg(F.max("seq").alias("m")).first()
        return 0 if r is None or r["m"] is None else int(r["m"]) + 1

    def next_key(self, stem: str) -> str:
        keys = {r["key"] for r in self.history().select("key").distinct().collect()}
        i = 1
        while f"{stem}_{i}" in keys:
            i += 1
        return f"{stem}_{i}"

    def _append(self, key, label, path, df, source_key, transform, seq):
        n = self.spark.read.parquet(path).count()
        row = [(key, label, path, int(n), len(df.columns), source_key, transform,
                _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), seq)]
        self.spark.createDataFrame(row, LINEAGE_SCHEMA).write.mode("append").parquet(self.lineage_path)

    def register(self, df: DataFrame, stem: str, label: str, source_key: str | None = None,
                 transform: str | None = None) -> str:
        """V3 save as a new derived version; returns its key."""
        key = self.next_key(stem)
        seq = self._claim()
        path = f"{self.root}/{key}@{seq}"
        df.write.mode("errorifexists").parquet(path)
        self._append(key, label, path, df, source_key, transform, seq)
        return key

    def overwrite(self, key: str, df: DataFrame, transform: str | None = None) -> str:
        """V3 overwrite: a new folder, then the key is repointed."""
        cur = self.current().filter(F.col("key") == key).first()
        if cur is None:
            raise KeyError(key)
        seq = self._claim()
        path = f"{self.root}/{key}@{seq}"
        df.write.mode("errorifexists").parquet(path)
        self._append(key, cur["label"], path, df, cur["source_key"], transform, seq)
        return key

    def load(self, key: str, seq: int | None = None) -> DataFrame:
        """The key's table, or what it was as of ``seq``; overwritten folders stay, so every state can be read."""
        cur = self.current(seq).filter(F.col("key") == key).first()
        if cur is None:
            raise KeyError(key if seq is None else f"{key} as of {seq}")
        return self.spark.read.parquet(cur["path"])
