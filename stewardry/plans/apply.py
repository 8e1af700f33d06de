"""Applying a load: change sets merged into tables, and versions published together.

A change set holds rows to insert and rows to replace, by the key of their table.
Merging it leaves all other rows as they are, and merging it twice is the same as
once. A store keeps every version of a table in a folder of its own; a small head
file names the folders that make up one version of all tables. Writing that file is
the one step that publishes, so a reader sees all tables as before or as after.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.operators.lookup import ROW, all_of, not_in
from stewardry.plans.outcomes import CREATED


def created(plan: DataFrame, columns: dict[str, str], outcome: str = CREATED) -> DataFrame:
    """Created rows of a plan in the shape of their catalog list."""
    made = plan.where(F.col("outcome") == outcome)
    return made.select(*[F.col(source).alias(name) for source, name in columns.items()])


def next_snapshot(catalog: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Catalog rows and the new rows whose key it does not hold.

    Applying the same rows again changes nothing. New rows are taken as unique
    by key, which plans and edge lists are.
    """
    absent = not_in(new, catalog, {k: k for k in key})
    return catalog.unionByName(absent, allowMissingColumns=True)


def one_per_key(rows: DataFrame, key: list[str], order: Column, last: bool = False) -> DataFrame:
    """The first (or last) row of every key; rows with a null in their key are left out.

    An aggregation, so a hot key shrinks to one row per map task.
    """
    fields = [c for c in rows.columns if c not in (*key, ROW)]
    pick = F.max_by if last else F.min_by
    known = rows.where(all_of([F.col(k).isNotNull() for k in key]))
    chosen = known.groupBy(*key).agg(pick(F.struct(F.lit(1).alias("_there"), *fields), order).alias("_one"))
    return chosen.select(*key, *[F.col(f"_one.{c}").alias(c) for c in fields])


def merge(
    catalog: DataFrame,
    key: list[str],
    inserts: DataFrame | None = None,
    replaces: DataFrame | None = None,
    order: Column | None = None,
) -> DataFrame:
    """The table after a change set.

    An insert is added unless the table holds its key; of several with one key the
    first in ``order`` counts. A replace gives the rows of its key the values of its
    own columns and leaves the others; of several the last counts. It also holds for
    rows that this change set inserts; a replace of a key that is nowhere does nothing.
    Changes with a null in their key do nothing. Merging again changes nothing.
    """
    order = F.col(ROW) if order is None else order
    out = catalog
    if inserts is not None:
        out = next_snapshot(out, one_per_key(inserts, key, order), key)
    if replaces is None:
        return out
    changed = one_per_key(replaces, key, order, last=True)
    fields = [c for c in changed.columns if c not in key]
    side = changed.select(*[F.col(c).alias(f"_new_{c}") for c in changed.columns], F.lit(True).alias("_changed"))
    # One row per key on the right, so a hot key of the table may be split.
    joined = out.join(side, all_of([F.col(k) == F.col(f"_new_{k}") for k in key]), "left")
    return joined.select(
        *[
            F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in out.columns
        ]
    )


def write_version(rows: DataFrame, path: str) -> None:
    """Write one snapshot version to a folder that must not be there yet."""
    rows.write.mode("errorifexists").parquet(path)


class Conflict(RuntimeError):
    """Another load has published since this one read the tables."""


class Store:
    """Tables in versions, below one folder that all executors reach.

    ``heads/`` holds a file per version, named by its number, with the folder of
    every table. Tables that a version doesn't change stay in their folders.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        place = self._hadoop.Path(self.folder)
        self._files = self._hadoop.FileContext.getFileContext(
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(),
            spark.sparkContext._jsc.hadoopConfiguration(),
        )

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.folder, *parts]))

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        heads = self._path("heads")
        if not self._files.util().exists(heads):
            return []
        names = [status.getPath().getName() for status in self._files.util().listStatus(heads)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def head(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """A version's number and the folder of each of its tables; the last version
        if none is named, 0 and no tables if there is none."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, {}
        text = self.spark.read.text(f"{self.folder}/heads/{version:012d}.json", wholetext=True).first()[0]
        return version, json.loads(text)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{self.head(version)[1][table]}")

    def write(self, tables: dict[str, DataFrame]) -> dict[str, str]:
        """Write tables to new folders, which nothing names yet."""
        places = {name: f"tables/{name}/{uuid.uuid4().hex}" for name in tables}
        for name, rows in tables.items():
            write_version(rows, f"{self.folder}/{places[name]}")
        return places

    def point(self, places: dict[str, str], base: int) -> int:
        """Publish written tables as the version after ``base``; its number.

        The head is written under another name and then renamed to its own, which
        fails if a head of that number is there.
        """
        number = base + 1
        text = json.dumps({**self.head(base)[1], **places}, sort_keys=True)
        draft, final = self._path("drafts", f"{uuid.uuid4().hex}.json"), self._path("heads", f"{number:012d}.json")
        flags = self.spark._jvm.java.util.EnumSet.of(self._hadoop.CreateFlag.CREATE)
        options = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.CreateOpts, 1)
        options[0] = self._hadoop.Options.CreateOpts.createParent()
        out = self._files.create(draft, flags, options)
        out.write(bytearray(text.encode()))
        out.close()
        self._files.mkdir(final.getParent(), self._hadoop.permission.FsPermission.getDirDefault(), True)
        never = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            self._files.rename(draft, final, never)
        except Exception as error:
            if number in self.versions():
                raise Conflict(f"version {number} is there already") from error
            raise
        return number

    def publish(self, tables: dict[str, DataFrame], base: int | None = None) -> int:
        """Write the tables and publish them as one version.

        ``base`` is the version the tables were made from (default: the last now);
        if another was published since, :class:`Conflict` is raised and nothing
        changes for readers.
        """
        base = self.head()[0] if base is None else base
        return self.point(self.write(tables), base)
