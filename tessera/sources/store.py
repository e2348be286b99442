"""Tables below one root, in Parquet, written so that readers only see whole ones.

A table is a folder of numbered versions and a file per commit, `_commits/<n>`, that lists the data folders of version n.
Writers stage a data folder, count its rows while writing, claim the next version by creating its claim file, which only one
can, and publish with one rename; the loser of a race fails. Works on any Hadoop file system that creates files exclusively
and renames atomically. One writer per table is assumed, as no rows are compared at commit. All folders of a version are read
in one scan; `compact` makes them one, and `vacuum` removes those that no version kept needs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.vault import new_rows


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _versions(self, table: str) -> list[int]:
        fs, p = self._fs(f"{self.path(table)}/_commits")
        return sorted(int(n) for s in fs.listStatus(p) if (n := s.getPath().getName()).isdigit()) if fs.exists(p) else []

    def _commit(self, table: str, version: int) -> dict:
        fs, p = self._fs(f"{self.path(table)}/_commits/{version}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _version(self, table: str) -> tuple[int, dict | None]:
        found = self._versions(table)
        return (found[-1], self._commit(table, found[-1])) if found else (-1, None)

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def version(self, table: str) -> int:
        """The number of the last version, -1 where there is no table."""
        return (self._versions(table) or [-1])[-1]

    def read(self, table: str, after: int | None = None) -> DataFrame:
        """The table as of now, in one scan. Reads of a table that is not there fail; nothing is taken for empty.

        With `after`, only the folders that this version did not have: what was appended since. A version that is gone, or a
        table written anew or compacted since, gives all rows.
        """
        last, v = self._version(table)
        if v is None:
            raise FileNotFoundError(f"no table {table!r} below {self.root}")
        folders = v["folders"]
        if after is not None and after in self._versions(table):
            before = self._commit(table, after)["folders"]
            folders = folders[len(before) :] if folders[: len(before)] == before else folders
        kind = StructType.fromJson(v["schema"])
        if not folders:
            return self.spark.createDataFrame([], kind)
        base = self.path(table)
        return self.spark.read.schema(kind).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).select(*kind.names)

    def _publish(self, table: str, df: DataFrame, folders: list[str], version: int, partition_by: Sequence[str] = ()) -> int:
        folder = f"load={uuid.uuid4().hex}"
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path(table)}/{folder}")
        n = int(seen.get["n"])
        if n == 0 and folders:
            self._delete(f"{self.path(table)}/{folder}")
            return 0
        # folders of columns that came later are read with nulls
        previous = self._version(table)[1]
        schema = df.schema
        if previous and folders:
            old = StructType.fromJson(previous["schema"])
            schema = StructType(old.fields + [f for f in schema.fields if f.name not in old.names])
        kept = previous["partition_by"] if previous and folders else list(partition_by)
        self._claim(table, version + 1, {"schema": schema.jsonValue(), "folders": [*folders, folder], "partition_by": kept})
        return n

    def _claim(self, table: str, version: int, commit: dict) -> None:
        commits = f"{self.path(table)}/_commits"
        fs, staged = self._fs(f"{commits}/.{uuid.uuid4().hex}")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps(commit).encode()))
        out.close()
        final, claim = self._fs(f"{commits}/{version}")[1], self._fs(f"{commits}/.claim-{version}")[1]
        if fs.exists(final) or not fs.createNewFile(claim) or not fs.rename(staged, final):
            fs.delete(staged, False)
            raise RuntimeError(f"another writer published version {version} of {table!r}, or died with its claim")
        fs.delete(claim, False)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def compact(self, table: str, partitions: int | None = None) -> int:
        """Rewrites the table as one folder of `partitions` files (per partition value), in a new version; its rows."""
        version, v = self._version(table)
        df = self.read(table)
        return self._publish(table, df.repartition(partitions) if partitions else df, [], version, v["partition_by"])

    def vacuum(self, table: str, keep: int = 1) -> int:
        """Deletes folders and commits that none of the last `keep` versions needs; how many folders. Older readers then fail."""
        versions = self._versions(table)
        needed = {f for v in versions[-max(1, keep) :] for f in self._commit(table, v)["folders"]}
        fs, p = self._fs(self.path(table))
        gone = [n for s in fs.listStatus(p) if (n := s.getPath().getName()).startswith("load=") and n not in needed]
        for v in versions[: -max(1, keep)]:
            self._delete(f"{self.path(table)}/_commits/{v}")
        for name in gone:
            self._delete(f"{self.path(table)}/{name}")
        return len(gone)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Rows written. New columns are taken up; rows from before have nulls there."""
        version, v = self._version(table)
        return self._publish(table, df, v["folders"] if v else [], version, partition_by)

    def overwrite(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Rows written, counted while writing. `df` may read the table itself: old folders stay."""
        return self._publish(table, df, [], self._version(table)[0], partition_by)

    def insert_only(self, table: str, candidates: DataFrame, keys: Sequence[str]) -> int:
        """Appends the candidates whose keys the table lacks; rows added."""
        return self.append(table, new_rows(candidates, self.read(table) if self.exists(table) else None, keys))
