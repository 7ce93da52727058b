"""Append-only keyed tables (key index, job state, batch ledger).

A round of n rows writes n rows: each ``append`` is a generation of its own below
``<path>/_log``.  Readers take, per key, the row of the latest generation.  Once the
generations hold more than ``MERGE_SHARE`` of the base's rows they are merged into a new
base, the plain Parquet table at ``path``; a row is so rewritten about 1 / MERGE_SHARE
times in all, however many rounds there are.

A generation counts once Spark has marked it complete, and a merged base is complete
beside the old one before that goes, so a run may end at any point.  Appending a
generation again replaces it.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MERGE_SHARE = 0.1


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``."""
    fs, where = file_system(spark, target)
    fs.delete(where, True)
    fs.mkdirs(where.getParent())
    if not fs.rename(file_system(spark, source)[1], where):
        raise OSError(f"cannot move {source} to {target}")


class KeyedLog:
    """A keyed table at ``path``.  ``keep_non_null`` names columns in which a later null keeps the earlier value."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: str, keep_non_null: Sequence[str] = ()):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.schema, self.keep = schema, list(keep_non_null)
        self.fresh = f"{self.path}.next"

    def _home(self) -> str:
        """Where the table is: a base that was completed but not moved counts if there is no other."""
        fs, where = file_system(self.spark, self.path)
        if not fs.exists(where) and "_SUCCESS" in child_names(self.spark, self.fresh) and self._merged(self.fresh) >= 0:
            return self.fresh
        return self.path

    def _generations(self, home: str) -> dict[int, str]:
        out = {}
        merged = self._merged(home)
        for name in child_names(self.spark, f"{home}/_log"):
            kind, _, number = name.partition("-")
            if kind == "gen" and int(number) > merged and "_SUCCESS" in child_names(self.spark, f"{home}/_log/{name}"):
                out[int(number)] = f"{home}/_log/{name}"
        return out

    def _merged(self, home: str) -> int:
        """The last generation that the base holds."""
        marks = [int(n.partition("-")[2]) for n in child_names(self.spark, f"{home}/_log") if n.startswith("base-")]
        return max(marks, default=-1)

    def next_generation(self) -> int:
        home = self._home()
        return max([self._merged(home), *self._generations(home)]) + 1

    def exists(self) -> bool:
        home = self._home()
        return "_SUCCESS" in child_names(self.spark, home) or bool(self._generations(home))

    def history(self) -> DataFrame:
        """All live rows with the generation that wrote them (``_gen``, -1 for the base)."""
        base, late = self._parts()
        if base is None and late is None:
            return self.spark.createDataFrame([], self.schema).withColumn("_gen", F.lit(-1).cast("bigint"))
        # the base holds nearly all rows: only those of the generations take their number from the file's path
        parts = []
        if base is not None:
            parts.append(base.withColumn("_gen", F.lit(-1).cast("bigint")))
        if late is not None:
            number = F.regexp_extract(F.col("_metadata.file_path"), r"/_log/gen-(\d+)/[^/]*$", 1)
            parts.append(late.withColumn("_gen", number.cast("bigint")))
        return parts[0] if len(parts) == 1 else parts[0].union(parts[1])

    def _parts(self) -> tuple[DataFrame | None, DataFrame | None]:
        """The base and the live generations; None where there is none."""
        home = self._home()
        folders = list(self._generations(home).values())
        read = self.spark.read.schema(self.schema).parquet
        return read(home) if "_SUCCESS" in child_names(self.spark, home) else None, read(*folders) if folders else None

    def read(self) -> DataFrame:
        """One row per key, the latest."""
        rows = self.history()
        payload = [c for c in rows.columns if c not in (*self.key, "_gen")]
        last = F.max(F.struct("_gen", *payload)).alias("_last")
        kept = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_gen"))).alias(f"_kept_{c}") for c in self.keep]
        out = rows.groupBy(*self.key).agg(last, *kept)
        return out.select(*self.key, *[F.col(f"_kept_{c}" if c in self.keep else f"_last.{c}").alias(c) for c in payload])

    def append(self, rows: DataFrame, generation: int | None = None) -> int:
        """Write ``rows`` (one per key) as a generation; rewriting one that is merged already changes nothing."""
        home = self._home()
        if home != self.path:
            move_folder(self.spark, home, self.path)
        number = self.next_generation() if generation is None else generation
        if number <= self._merged(self.path):
            return number
        rows = rows.select(*self.spark.createDataFrame([], self.schema).columns)
        if self.exists():
            rows.write.mode("overwrite").parquet(f"{self.path}/_log/gen-{number:012d}")
            self._merge_if_due()
        else:
            self._replace_base(rows, number)
        return number

    def append_folder(self, folder: str, generation: int) -> None:
        """``append`` of rows that are complete in a folder of their own; the first ones are not written again, their folder
        becomes the base (columns beside those of the log stay unread).  Can be repeated as long as the folder is there."""
        if self.exists():
            self.append(self.spark.read.schema(self.schema).parquet(folder), generation)
        else:
            self._move_base(folder, generation)

    def _merge_if_due(self) -> None:
        base, late = (0 if rows is None else rows.count() for rows in self._parts())
        if late > MERGE_SHARE * base:
            self.merge()

    def merge(self) -> None:
        """One base of all generations."""
        self._replace_base(self.read(), self.next_generation() - 1)

    def _replace_base(self, rows: DataFrame, upto: int) -> None:
        rows.write.mode("overwrite").parquet(self.fresh)
        self._move_base(self.fresh, upto)

    def _move_base(self, folder: str, upto: int) -> None:
        fs, mark = file_system(self.spark, f"{folder}/_log/base-{upto:012d}")
        fs.mkdirs(mark)
        move_folder(self.spark, folder, self.path)
