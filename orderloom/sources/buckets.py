"""A parquet table in hash buckets of its key, where a commit writes the buckets it touches and no others.

As in ``snapshots``, a commit is a numbered folder that counts once Spark's marker is in it; here the folder holds whole
buckets, and a reader takes every bucket from the newest folder that has it. Folders are never written again, so a reader
that has begun keeps what it has listed. With a table format on the class path use its ``MERGE INTO`` instead.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.session import freed_shuffles
from orderloom.sources.schemas import evolved, fitted

BUCKET = "_bucket"
CLAIM_SECONDS = 600  # a claim this old without its folder was left by a writer that is gone


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the rows at hand were read."""


class BucketTable:
    """``keys`` decide the bucket of a row. Their number is fixed with the first commit: about as many as give buckets of
    a few hundred megabytes. ``keep`` versions of a bucket stay for readers that have begun."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 32,
                 schema: StructType | None = None, keep: int = 2):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self.buckets, self.schema, self.keep = buckets, schema, keep

    # files

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _names(self, path: str) -> list[str]:
        fs, target = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _put(self, path: str, text: str) -> bool:
        """Write a small file unless it is there already; of several writers one succeeds."""
        fs, target = self._fs(path)
        try:
            out = fs.create(target, False)
        except Exception as error:
            if "already exists" in str(error).lower():
                return False
            raise
        out.write(text.encode())
        out.close()
        return True

    def _text(self, path: str) -> str:
        fs, target = self._fs(path)
        source = fs.open(target)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def _folder(self, number: int) -> str:
        return f"{self.path}/v{number:010d}"

    # state

    def versions(self) -> list[int]:
        """Committed numbers, oldest first."""
        numbers = sorted(int(n[1:]) for n in self._names(self.path) if n[:1] == "v" and n[1:].isdigit())
        found = []
        for number in numbers:
            fs, marker = self._fs(f"{self._folder(number)}/_SUCCESS")
            if fs.exists(marker):
                found.append(number)
        return found

    def version(self) -> int:
        return max(self.versions(), default=0)

    def exists(self) -> bool:
        return bool(self.versions())

    def _held(self, version: int | None = None) -> dict[int, list[int]]:
        """For every bucket the commits that hold it, newest first. One entry per bucket and kept version."""
        held: dict[int, list[int]] = {}
        for number in reversed(self.versions()):
            if version is not None and number > version:
                continue
            for name in self._names(self._folder(number)):
                if name.startswith(f"{BUCKET}="):
                    held.setdefault(int(name.split("=")[1]), []).append(number)
        return held

    def recorded(self) -> StructType | None:
        """The schema of the newest commit, which holds the columns of all before it."""
        number = self.version()
        return StructType.fromJson(json.loads(self._text(f"{self._folder(number)}/_schema"))) if number else self.schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into; at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    # reading and writing

    def read(self, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some buckets, as they are or as they were at a version that is still kept: a job that
        pins the versions of several tables reads them as one set while loads go on."""
        schema = self.recorded()
        if schema is None:
            raise ValueError(f"no commit yet at {self.path}")
        wanted = None if buckets is None else set(buckets)
        folders = [f"{self._folder(numbers[0])}/{BUCKET}={b}" for b, numbers in sorted(self._held(version).items())
                   if wanted is None or b in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def commit(self, rows: DataFrame, buckets: Sequence[int], base: int, dealt_by_key: bool = False) -> int:
        """Make ``rows`` the whole content of ``buckets``, given that the newest commit is still ``base``. Rows that
        are dealt out by the key already are written as they lie, a file per task and bucket.

        New columns are added and narrower types kept in the wider one; a type that does not fit fails before anything
        is written. Raises ConcurrentCommit, and leaves the table as it is, where another writer came first.
        """
        layout = json.dumps({"keys": list(self.keys), "buckets": self.buckets})
        if not self._put(f"{self.path}/layout", layout) and self._text(f"{self.path}/layout") != layout:
            raise ValueError(f"{self.path} has other keys or buckets: {self._text(f'{self.path}/layout')}")
        known = self.recorded()
        schema = evolved(known, rows.schema) if known is not None else rows.schema
        if self.version() != base:
            raise ConcurrentCommit(f"{self.path} is at {self.version()}, not at {base}")
        staged = f"{self.path}/staging/{uuid.uuid4().hex}"
        placed = fitted(rows, schema).withColumn(BUCKET, self.bucket())
        if not dealt_by_key:
            placed = placed.hint("rebalance", BUCKET)
        with freed_shuffles(self.spark):
            placed.write.option("compression", "zstd").partitionBy(BUCKET).parquet(staged)
        for b in buckets:  # a bucket that lost all its rows is an empty folder
            fs, target = self._fs(f"{staged}/{BUCKET}={b}")
            fs.mkdirs(target)
        self._put(f"{staged}/_schema", schema.json())
        self._publish(staged, base + 1)
        self._clean()
        return base + 1

    def _publish(self, staged: str, number: int) -> None:
        claim = f"{self.path}/claims/{number:010d}"
        fs, source = self._fs(staged)
        if not self._put(claim, staged):
            _, target = self._fs(claim)
            age = time.time() - fs.getFileStatus(target).getModificationTime() / 1000
            if number in self.versions() or age < CLAIM_SECONDS:
                fs.delete(source, True)
                raise ConcurrentCommit(f"commit {number} of {self.path} belongs to another writer")
            fs.delete(target, False)
            return self._publish(staged, number)
        if self.version() != number - 1 or not fs.rename(source, self._fs(self._folder(number))[1]):
            fs.delete(source, True)
            raise ConcurrentCommit(f"commit {number} of {self.path} could not be published")

    def _clean(self) -> None:
        """Drop versions of a bucket beyond ``keep``, and commits that hold none any more."""
        held = self._held()
        needed = {n for numbers in held.values() for n in numbers[:self.keep]}
        for b, numbers in held.items():
            for number in numbers[self.keep:]:
                fs, target = self._fs(f"{self._folder(number)}/{BUCKET}={b}")
                fs.delete(target, True)
        for number in self.versions()[:-1]:
            if number not in needed:
                fs, target = self._fs(self._folder(number))
                fs.delete(target, True)
