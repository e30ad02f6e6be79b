"""Tables that jobs and streams keep up to date for years, as a log of commits.

A log is a folder of data and of commits. What a run adds to a table is a data folder of its own, written once and never
changed. A commit is a small file that names the data folders of all tables of the log; it is written last and in one
piece, so readers see every table as of one commit, and a run that is killed before it leaves no half state, only
folders that no commit names. A batch that is run again after its commit adds nothing.

Folders are merged by levels: as soon as ``FANOUT`` of one level stand side by side, the job that commits makes them one
of the next level. So a reader opens at most ``FANOUT`` folders a level, the levels grow with the logarithm of the
commits, and a row is rewritten once a level. Folders and commits that the last ``KEEP`` commits don't name are removed.

Two writers at a time are in order: a commit that finds its number taken starts again from the commit that took it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 8
KEEP = 10


@dataclass(frozen=True)
class Table:
    """Columns, and the columns that name what a row replaces: none of them, or a row, or a whole set of rows."""

    schema: T.StructType
    keys: tuple[str, ...] = ()
    sets: bool = False


@dataclass(frozen=True)
class Commit:
    """The state of a log: who writes it, its last batch, and by table the folders [name, level, number], oldest first."""

    number: int = -1
    owner: str | None = None
    batch: int | None = None
    tables: Mapping[str, list] = field(default_factory=dict)


class Log:
    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, Table]):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    # --- commits

    def commit_at(self, number: int) -> Commit:
        stream = self.fs.open(self._at(f"commits/{number:020d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(**json.loads(text))

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("commits") if n.endswith(".json"))

    def last(self) -> Commit:
        numbers = self._numbers()
        return self.commit_at(numbers[-1]) if numbers else Commit()

    def _put(self, commit: Commit) -> bool:
        """Write a commit in one piece; False if its number is taken."""
        made, target = self._at(f"commits/.{uuid.uuid4().hex}"), self._at(f"commits/{commit.number:020d}.json")
        out = self.fs.create(made, True)
        out.write(bytearray(json.dumps(commit.__dict__).encode()))
        out.close()
        none = self.spark._sc._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            self.hadoop.FileContext.getFileContext(target.toUri(), self.conf).rename(made, target, none)
        except Py4JJavaError as error:
            self.fs.delete(made, False)
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        return True

    def claim(self, owner: str) -> None:
        """Tie the log to one writer's numbering of batches; fail if it belongs to another."""
        known = self.last().owner
        if known is None:
            self._append(lambda c: Commit(c.number + 1, owner, c.batch, c.tables))
            known = self.last().owner
        if known != owner:
            raise ValueError(f"the log {self.path} belongs to another checkpoint")

    def _append(self, make: Callable[[Commit], Commit | None]) -> None:
        while True:
            commit = make(self.last())
            if commit is None or self._put(commit):
                return

    def done(self, batch: int) -> bool:
        """Whether a batch is committed."""
        last = self.last().batch
        return last is not None and last >= batch

    def commit(self, added: Mapping[str, str | None], batch: int | None = None) -> None:
        """Add the folders that ``write`` made, all at once."""
        written = {f for f in added.values() if f}

        def make(c: Commit) -> Commit | None:
            if batch is not None and c.batch is not None and c.batch >= batch:
                return None
            tables = {name: list(folders) for name, folders in c.tables.items()}
            for name, folder in added.items():
                if folder:
                    tables.setdefault(name, []).append([folder, 0, c.number + 1])
            for name, folders in tables.items():
                tables[name] = self._merged(name, folders)
                written.update(f[0] for f in tables[name][-1:])
            return Commit(c.number + 1, c.owner, c.batch if batch is None else batch, tables)

        self._append(make)
        self._clean(written)

    def _merged(self, name: str, folders: list) -> list:
        while len(folders) >= FANOUT and len({f[1] for f in folders[-FANOUT:]}) == 1:
            run = folders[-FANOUT:]
            rows = self._newest(name, self._rows(name, run)).drop("commit")
            folders = [*folders[:-FANOUT], [self.write(name, rows), run[0][1] + 1, run[-1][2]]]
        return folders

    def _named(self, numbers: Sequence[int]) -> set[str]:
        return {f[0] for n in numbers for folders in self.commit_at(n).tables.values() for f in folders}

    def _clean(self, written: set[str]) -> None:
        """Remove what only old commits name, and what was merged at once or for a commit that came too late."""
        numbers = self._numbers()
        for folder in (written | self._named(numbers[:-KEEP])) - self._named(numbers[-KEEP:]):
            self.fs.delete(self._at(f"data/{folder}"), True)
        for n in numbers[:-KEEP]:
            self.fs.delete(self._at(f"commits/{n:020d}.json"), False)

    def remove_unnamed(self) -> int:
        """Remove what killed runs left behind. Only while nobody writes."""
        named = self._named(self._numbers())
        left = [n for n in self._names("data") if n not in named]
        for name in left:
            self.fs.delete(self._at(f"data/{name}"), True)
        return len(left)

    def seen_by(self, reader: str, batch: int) -> Commit:
        """The commit a reader's batch goes by: the last one when the batch first ran, also if it runs again.

        An empty file in the reader's folder is named after both before the batch reads a row. Where the log has moved on
        by more than ``KEEP`` commits since, that commit is gone and the last one serves.
        """
        folder = self.hadoop.Path(f"{reader.rstrip('/')}/_seen")
        fs = folder.getFileSystem(self.conf)
        seen = [s.getPath().getName().split("-") for s in fs.listStatus(folder)] if fs.exists(folder) else []
        for at, number in seen:
            if int(at) == batch:
                return self.commit_at(int(number)) if int(number) in self._numbers() else self.last()
        last = self.last()
        if last.number >= 0:
            fs.create(self.hadoop.Path(folder, f"{batch}-{last.number}"), True).close()
        for at, number in seen:  # only the last batch runs again
            if int(at) < batch - 1:
                fs.delete(self.hadoop.Path(folder, f"{at}-{number}"), False)
        return last

    # --- rows

    def write(self, name: str, rows: DataFrame) -> str | None:
        """Write rows for a later commit, in the order of the keys; None if there are none."""
        table, folder = self.tables[name], f"{name}-{uuid.uuid4().hex}"
        rows = rows.select(*table.schema.names)
        (rows.sortWithinPartitions(*table.keys) if table.keys else rows).write.parquet(f"{self.path}/data/{folder}")
        if self.at(name, folder).isEmpty():
            self.fs.delete(self._at(f"data/{folder}"), True)
            return None
        return folder

    def at(self, name: str, folder: str | None) -> DataFrame:
        """The rows of one folder."""
        schema = self.tables[name].schema
        if folder is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")

    def _rows(self, name: str, folders: Sequence) -> DataFrame:
        parts = [self.at(name, f[0]).withColumn("commit", F.lit(f[2]).cast("long")) for f in folders]
        return reduce(DataFrame.unionByName, parts or [self.at(name, None).withColumn("commit", F.lit(0).cast("long"))])

    def _newest(self, name: str, rows: DataFrame) -> DataFrame:
        table = self.tables[name]
        if not table.keys:
            return rows
        if table.sets:
            newest = F.max("commit").over(Window.partitionBy(*table.keys))
            return rows.withColumn("_newest", newest).where(F.col("commit") == F.col("_newest")).drop("_newest")
        values = [c for c in ("commit", *table.schema.names) if c not in table.keys]
        # the maximum combines before the shuffle: one row per key and folder part
        newest = rows.groupBy(*table.keys).agg(F.max(F.struct(*values)).alias("_v"))
        return newest.select(*table.keys, *[F.col(f"_v.{v}").alias(v) for v in values])

    def rows(self, name: str, commit: Commit | None = None) -> DataFrame:
        """What was added to a table and not yet merged away, with the number of its commit."""
        return self._rows(name, (commit or self.last()).tables.get(name, []))

    def read(self, name: str, commit: Commit | None = None, where: Column | None = None, more: str | None = None) -> DataFrame:
        """A table as of a commit, or as of now: of each key what was added last.

        ``where`` is a condition on keys, which the scans of the folders apply; ``more`` is a folder that is not
        committed yet and counts as the last.
        """
        commit = commit or self.last()
        rows = self._rows(name, [*commit.tables.get(name, []), *([[more, 0, commit.number + 1]] if more else [])])
        rows = rows if where is None else rows.where(where)
        return self._newest(name, rows).select(*self.tables[name].schema.names)
