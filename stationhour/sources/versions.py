"""Monthly tables whose content changes by publishing a snapshot.

    table/_data/version=<id>/year=<y>/month_num=<m>/   rows; a version is written once and never changed
    table/_snapshots/<number>.json                     the version of every month, and the lists of files behind them

A snapshot is written under a temporary name and then renamed to the next number, which fails if that number is taken. Readers
take the highest number. So a reader sees all of a change or nothing of it, and a run that breaks off leaves data
that no snapshot names. A table in the plain layout (``year=/month_num=`` below its root) is read as it is until the first publication, which
takes its months over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationhour.schemas import PERIOD

PLAIN = ""  # version of a month in the plain layout


class Conflict(RuntimeError):
    """Someone else has published in the meantime."""


@dataclass(frozen=True)
class Month:
    version: str
    landed: bool = False  # computed from the files that the ledgers list


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    months: dict[tuple[int, int], Month] = field(default_factory=dict)
    ledgers: tuple[str, ...] = ()

    def to_json(self) -> str:
        months = [[*period, m.version, m.landed] for period, m in sorted(self.months.items())]
        return json.dumps({"months": months, "ledgers": list(self.ledgers)})

    @staticmethod
    def from_json(number: int, text: str) -> Snapshot:
        read = json.loads(text)
        return Snapshot(number, {(y, m): Month(v, landed) for y, m, v, landed in read["months"]}, tuple(read["ledgers"]))


class Folder:
    """A table's folder on the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.root = spark, table.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self._conf)

    def path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *[p for p in parts if p]]))

    def names(self, *parts: str) -> list[str]:
        """Children of a folder, none where it does not exist."""
        path = self.path(*parts)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, folder: str, name: str) -> None:
        """A complete file under a name that nobody else has taken, else ``Conflict``."""
        hidden, final = self.path(folder, f".{uuid.uuid4().hex}"), self.path(folder, name)
        stream = self.fs.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._hadoop.FileContext.getFileContext(final.toUri(), self._conf) if final.isAbsolute() and final.toUri().getScheme() else \
            self._hadoop.FileContext.getFileContext(self._conf)
        never = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            context.rename(hidden, final, never)
        except Py4JJavaError as error:
            self.fs.delete(hidden, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise Conflict(f"{final} has been published by another run") from error
            raise

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def _periods_below(folder: Folder, *parts: str) -> list[tuple[int, int]]:
    """(year, month) of the partitions below a folder; names only are listed."""
    found = []
    for year in folder.names(*parts):
        if year.startswith("year=") and year[5:].isdigit():
            for month in folder.names(*parts, year):
                if month.startswith("month_num=") and month[10:].isdigit():
                    found.append((int(year[5:]), int(month[10:])))
    return found


def latest(spark: SparkSession, table: str) -> Snapshot:
    folder = Folder(spark, table)
    numbers = [int(n[:-5]) for n in folder.names("_snapshots") if n.endswith(".json") and n[:-5].isdigit()]
    if numbers:
        return Snapshot.from_json(max(numbers), folder.read("_snapshots", f"{max(numbers):012d}.json"))
    return Snapshot(0, {p: Month(PLAIN) for p in _periods_below(folder)})


def publish(spark: SparkSession, table: str, change: Callable[[Snapshot], Snapshot], attempts: int = 20) -> Snapshot:
    """Make ``change`` of the latest snapshot the next one. If another run publishes first, it is applied to that run's
    snapshot; ``change`` raises ``Conflict`` where this would be wrong."""
    folder = Folder(spark, table)
    for attempt in range(attempts):
        now = latest(spark, table)
        new = replace(change(now), number=now.number + 1)
        try:
            folder.create(new.to_json(), "_snapshots", f"{new.number:012d}.json")
            return new
        except Conflict:
            if attempt == attempts - 1:
                raise
    raise AssertionError


def read(spark: SparkSession, table: str, schema: T.StructType, snapshot: Snapshot | None = None) -> DataFrame:
    """The rows of a snapshot, of the latest if none is given. Partition filters apply to year and month_num."""
    snapshot, root = snapshot or latest(spark, table), table.rstrip("/")
    plain = [f"{root}/year={y}/month_num={m}" for (y, m), x in snapshot.months.items() if x.version == PLAIN]
    versioned = [f"{root}/_data/version={x.version}/year={y}/month_num={m}" for (y, m), x in snapshot.months.items() if x.version != PLAIN]
    with_version = T.StructType([*schema, T.StructField("version", T.StringType())])
    parts = []
    if versioned:
        parts.append(spark.read.option("basePath", f"{root}/_data").schema(with_version).parquet(*versioned))
    if plain:
        parts.append(spark.read.option("basePath", root).schema(schema).parquet(*plain))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0].select(*schema.names)
    return rows.unionByName(parts[1].select(*schema.names)) if len(parts) > 1 else rows


def periods(spark: SparkSession, table: str) -> DataFrame:
    """(year, month_num) of the table from its snapshot; no data file is opened. At most twelve rows a year."""
    return spark.createDataFrame(sorted(latest(spark, table).months), "year INT, month_num INT")


def write_version(df: DataFrame, table: str) -> tuple[str, list[tuple[int, int]]]:
    """Write rows as a version that no snapshot names yet; (its id, its months).

    The rebalance hint sizes files at run time: it splits a month that holds much of the data and packs small ones, so no month is
    forced through one task.
    """
    version, root = uuid.uuid4().hex, table.rstrip("/")
    df.hint("rebalance", *PERIOD).write.partitionBy(*PERIOD).parquet(f"{root}/_data/version={version}")
    return version, _periods_below(Folder(df.sparkSession, table), "_data", f"version={version}")


def with_months(snapshot: Snapshot, version: str, present: Iterable[tuple[int, int]], gone: Iterable[tuple[int, int]] = (), *, landed: bool) -> Snapshot:
    months = {p: m for p, m in snapshot.months.items() if p not in set(gone)}
    return replace(snapshot, months=months | {p: Month(version, landed) for p in present})


def expire(spark: SparkSession, table: str, keep: int = 1, hours: float = 24.0) -> int:
    """Remove what only snapshots before the last ``keep`` name, or none; returns the number of folders removed.

    Folders changed within the last ``hours`` stay, as a run may be about to publish them; give readers of older snapshots that time too.
    """
    folder = Folder(spark, table)
    names = [n for n in folder.names("_snapshots") if n.endswith(".json") and n[:-5].isdigit()]
    kept = [Snapshot.from_json(int(n[:-5]), folder.read("_snapshots", n)) for n in names[-keep:]]
    named = {(m.version, *p) for s in kept for p, m in s.months.items()}
    lists = {x for s in kept for x in s.ledgers}
    limit = spark._jvm.System.currentTimeMillis() - int(hours * 3_600_000)

    def stale(*parts: str) -> bool:
        return folder.fs.getFileStatus(folder.path(*parts)).getModificationTime() <= limit

    removed = 0
    for version in folder.names("_data"):
        for year, month in _periods_below(folder, "_data", version):
            parts = ("_data", version, f"year={year}", f"month_num={month}")
            if (version.removeprefix("version="), year, month) not in named and stale(*parts):
                folder.remove(*parts)
                removed += 1
    for ledger in folder.names("_files"):
        if ledger.removeprefix("load=") not in lists and stale("_files", ledger):
            folder.remove("_files", ledger)
            removed += 1
    if kept and kept[0].number:
        for year, month in _periods_below(folder):
            if (PLAIN, year, month) not in named and stale(f"year={year}", f"month_num={month}"):
                folder.remove(f"year={year}", f"month_num={month}")
                removed += 1
    for name in names[:-keep]:
        folder.remove("_snapshots", name)
    return removed
