"""Stored tables whose changes appear all at once.

Every write goes into a folder of its own, ``rows/commit_id=<id>/``; a numbered manifest in ``log/`` then
names the folders that make up each partition. A manifest can be put in place only once, so of two
writers of one number the second sees that it lost. Readers hold on to the manifest they began with:
folders it names stay until :meth:`CommittedTable.vacuum`.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyfold.session import drop_path, partition_name

_COMMIT = "commit_id"


class LostCommit(RuntimeError):
    """Another writer changed the same partitions first; nothing of this write is visible."""


class Version(NamedTuple):
    """What the table consists of: the commits of each partition, and the batches it holds."""

    number: int
    parts: dict[str, list[str]]
    batches: tuple[str, ...]


class CommittedTable:
    """A Parquet table at ``path`` with the columns of ``schema``, partitioned by some of them.

    The manifests hold names of partitions and batches, never rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str] = ()) -> None:
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, list(by)
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]).rstrip("/"))

    def numbers(self) -> list[int]:
        """The versions there are, ascending."""
        found = self._fs.globStatus(self._path("log", "*.json")) or []
        return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found)

    def version(self, number: int | None = None) -> Version:
        """A version by its number, the newest by default; a table never written to has number -1."""
        numbers = self.numbers() if number is None else [number]
        if not numbers:
            return Version(-1, {}, ())
        stream = self._fs.open(self._path("log", f"{numbers[-1]:020d}.json"))
        try:
            held = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(numbers[-1], held["parts"], tuple(held["batches"]))

    def part(self, values: Sequence[str | None]) -> str:
        """The name of the partition with these values."""
        return "/".join(partition_name(self.spark, column, value) for column, value in zip(self.by, values))

    def read(self, version: Version | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version (the newest by default), or of some of its partitions only.

        Later commits do not change what the frame holds. Only the named folders are listed.
        """
        version = version or self.version()
        wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        folders = [self._folder(commit, part) for part, commits in wanted.items() for commit in commits]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        fields = StructType([*self.schema, StructField(_COMMIT, StringType())])
        rows = self.spark.read.schema(fields).option("basePath", f"{self.path}/rows").parquet(*folders)
        return rows.select(*self.schema.names)

    def _folder(self, commit: str, part: str = "") -> str:
        return f"{self.path}/rows/{_COMMIT}={commit}/{part}".rstrip("/")

    def append(self, rows: DataFrame, batch: str, seen: Version | None = None) -> int:
        """Add rows as batch ``batch``; a batch that the table holds already changes nothing.

        Appends of several writers follow one another, unless the rows were computed from a version
        ``seen``: if there is a newer one by then, :class:`LostCommit` is raised. Returns the version
        that holds the batch.
        """
        now = self.version()
        if batch in now.batches:
            return now.number
        commit, written = self._write(rows)
        while True:
            now = self.version()
            if batch in now.batches:  # another writer brought it meanwhile
                drop_path(self.spark, self._folder(commit))
                return now.number
            if seen is not None and now.number != seen.number:
                drop_path(self.spark, self._folder(commit))
                raise LostCommit(f"{self.path}: version {now.number} came after {seen.number}, from which the rows were computed")
            parts = now.parts | {p: [*now.parts.get(p, []), commit] for p in written}
            if self._publish(now, parts, batch):
                return now.number + 1

    def replace(
        self, rows: DataFrame, touched: Iterable[str], seen: Version, batch: str | None = None, alone: bool = False
    ) -> int:
        """Put ``rows`` in place of the partitions ``touched``, which were read from version ``seen``.

        Partitions left without rows disappear. If any of them has changed since, :class:`LostCommit`
        is raised and the table stays as it is; changes of other partitions are kept. With ``alone`` any
        newer version is such a change, for rows that depend on more than the partitions they replace.
        """
        if batch is not None and batch in seen.batches:
            return seen.number
        commit, written = self._write(rows)
        replaced = {*touched, *written}
        while True:
            now = self.version()
            overtaken = any(now.parts.get(p) != seen.parts.get(p) for p in replaced) or (alone and now.number != seen.number)
            if overtaken or (batch is not None and batch in now.batches):
                drop_path(self.spark, self._folder(commit))
                raise LostCommit(f"{self.path}: version {now.number} changed partitions that were read from {seen.number}")
            parts = {p: c for p, c in now.parts.items() if p not in replaced} | {p: [commit] for p in written}
            if self._publish(now, parts, batch):
                return now.number + 1

    def overwrite(self, rows: DataFrame, batch: str | None = None) -> int:
        """Put ``rows`` in place of the whole table."""
        seen = self.version()
        return self.replace(rows, seen.parts, seen, batch)

    def compact(self, small: int) -> int | None:
        """Rewrite the partitions that consist of several files of less than ``small`` bytes on average.

        Returns the new version, or None if there was nothing to do. Rows and batches stay the same.
        """
        seen = self.version()
        parts = []
        for part, commits in seen.parts.items():
            held = [self._fs.getContentSummary(self._jvm.org.apache.hadoop.fs.Path(self._folder(c, part))) for c in commits]
            files = sum(s.getFileCount() for s in held)
            if len(commits) > 1 and sum(s.getLength() for s in held) < small * files:
                parts.append(part)
        return self.replace(self.read(seen, parts), parts, seen) if parts else None

    def vacuum(self, keep: int = 1, grace_seconds: float = 86_400) -> None:
        """Forget all but the last ``keep`` versions, and drop the folders that none of these names.

        Folders younger than the grace time stay, since a writer may be about to commit them.
        """
        numbers = self.numbers()
        kept = [self.version(n) for n in numbers[-keep:]]
        for number in numbers[:-keep]:
            self._fs.delete(self._path("log", f"{number:020d}.json"), False)
        named = {c for v in kept for commits in v.parts.values() for c in commits}
        for status in self._fs.globStatus(self._path("rows", f"{_COMMIT}=*")) or []:
            folder = status.getPath()
            old = status.getModificationTime() / 1000 < time.time() - grace_seconds
            if old and folder.getName().removeprefix(f"{_COMMIT}=") not in named:
                self._fs.delete(folder, True)

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Write rows into a folder of their own; its id and the partitions in it."""
        commit = uuid.uuid4().hex
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        rows.hint("rebalance", *self.by).write.partitionBy(*self.by).parquet(self._folder(commit))
        if not self.by:
            return commit, [""]
        found = self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(self._folder(commit, "/".join("*=*" for _ in self.by)))) or []
        depth = len(self.by)
        return commit, ["/".join(str(status.getPath()).split("/")[-depth:]) for status in found]

    def _publish(self, now: Version, parts: dict[str, list[str]], batch: str | None) -> bool:
        """Put the next manifest in place, unless there is one of its number."""
        batches = [*now.batches, *([batch] if batch is not None else [])]
        target = self._path("log", f"{now.number + 1:020d}.json")
        draft = self._path("log", f".{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"parts": parts, "batches": batches}).encode()))
        finally:
            stream.close()
        try:
            return self._put_if_absent(draft, target)
        finally:
            self._fs.delete(draft, False)

    def _put_if_absent(self, draft, target) -> bool:
        if self._fs.getScheme() == "file":
            # A local rename would replace the target; a second link to the draft does not.
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True
