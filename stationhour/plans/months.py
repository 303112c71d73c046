"""Monthly pipelines: raw rows to enriched months, and the table that follows raw files as they come and change."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationhour.functions.periods import in_name_period
from stationhour.functions.scalar import computed_once
from stationhour.operators.cleaning import clean
from stationhour.operators.enrichment import enrich
from stationhour.operators.partials import STATE_SCHEMA, file_states, summary_of_states
from stationhour.operators.summary import station_hour_summary
from stationhour.schemas import PERIOD, Params
from stationhour.session import write_shared
from stationhour.sources import raw as raw_source
from stationhour.sources import versions
from stationhour.sources.tables import scan_processed


def month_pipeline(raw_rows: DataFrame, meta: DataFrame, calendar: DataFrame, params: Params = Params(),
                   on_missing: str = "drop_month") -> DataFrame:
    """Clean, summarise and enrich raw rows of any number of months; the raw rows are read once.

    The coverage gate reads the summary a second time, so the summary is written to the shared
    folder instead of being computed twice from the raw rows.
    """
    summary = station_hour_summary(clean(raw_rows, calendar, params), params)
    if on_missing == "drop_month":
        summary = write_shared(summary, "summary")
    return enrich(summary, meta, on_missing)


FILE_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month_num", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("load", T.StringType()),
    T.StructField("seq", T.LongType()),
])
LISTS = 24  # lists of files after which a load writes one for all


def known_files(spark: SparkSession, table: str, snapshot: versions.Snapshot | None = None) -> DataFrame:
    """The files that a snapshot of the table is made of (file, file_name, digest, bytes, modified, year, month_num, rows, load, seq), each in
    the version that was loaded last. ``rows`` is the number of rows it gave; a file that gives none stays known."""
    snapshot = snapshot or versions.latest(spark, table)
    if not snapshot.ledgers:
        return spark.createDataFrame([], FILE_SCHEMA)
    every = spark.read.schema(FILE_SCHEMA).parquet(*[f"{table.rstrip('/')}/_files/load={x}" for x in snapshot.ledgers])
    last = F.max_by(F.struct(*FILE_SCHEMA.names), "seq").alias("last")
    return every.groupBy(F.col("file").alias("of")).agg(last).select("last.*")


def changed_files(spark: SparkSession, listed: DataFrame, known: DataFrame, folder: str, *, verify: bool = False) -> list[dict]:
    """Listed files that are new or were stored anew since they became known, with their digest: a dict of ``FILE_SCHEMA`` and file_path each.

    ``load`` and ``rows`` are those of the version known where the content is still the same, and None where it is to be loaded. Files of the same size
    and time stamp count as unchanged without being read; with ``verify`` every file is read and compared. Known files that no listing
    has are looked up by name, as listings leave out files without a byte.
    """
    had = known.selectExpr("file", "file_name AS known_name", "digest AS had", "bytes AS known_bytes", "modified AS known_modified",
                           "year AS known_year", "month_num AS known_month", "rows", "load")
    both = listed.select("file", "file_path", "file_name", "bytes", "modified", *PERIOD).join(had, "file", "full")
    differs = "true" if verify else "had IS NULL OR bytes <> known_bytes OR modified <> known_modified"
    # a row for each file of this load
    found = [r.asDict() for r in both.where(f"(file_path IS NULL AND rows > 0) OR (file_path IS NOT NULL AND ({differs}))").collect()]
    gone = [r for r in found if r["file_path"] is None]
    there = [r for r in found if r["file_path"] is not None]
    for r in raw_source.emptied_files(spark, folder, [(r["file"], r["known_name"], r["known_year"], r["known_month"]) for r in gone]) if gone else []:
        there.append(next(g for g in gone if g["file"] == r["file"]) | r)
    paths = [r["file_path"] for r in there if r["bytes"]]
    digests = {x.file_path: x.digest for x in raw_source.digests(spark, paths).collect()} if paths else {}
    news = []
    for r in there:
        r["digest"] = digests.get(r["file_path"], raw_source.EMPTY)
        if r["digest"] != r["had"]:
            news.append(r | {"load": None, "rows": None})
        elif (r["bytes"], r["modified"]) != (r["known_bytes"], r["known_modified"]):
            news.append(r)
    return news


def load_files(spark: SparkSession, listed: DataFrame, table: str, meta: DataFrame, calendar: DataFrame, params: Params = Params(), *,
               folder: str, on_missing: str = "drop_month", strict_file: bool = False, verify: bool = False, only: DataFrame | None = None) -> int:
    """Bring the table up to date with the listed files and return how many were new or changed.

    New states replace those of a file's earlier version, a file that gives no rows any more leaves none behind. The months in the names of these files are
    merged anew from the states of all files known, whichever way they came; rows dated outside that month are left to the quarantine. Months, states and
    list of files change together, in one publication; a run that breaks off is simply repeated, and one that another run overtakes raises
    ``Conflict``. A month that was written without its files is never replaced by a part of it: the load is refused before anything changes.
    ``only`` (file) restricts the files that months are merged from; ``folder`` is what was listed, the files' ids begin below it.
    """
    snapshot, root = versions.latest(spark, table), raw_source.root_of(spark, folder)
    known = known_files(spark, table, snapshot)
    news = changed_files(spark, listed, known, folder, verify=verify)
    if not news:
        return 0
    fresh, base, load = [r for r in news if r["load"] is None], table.rstrip("/"), uuid.uuid4().hex
    periods = sorted({(r["year"], r["month_num"]) for r in fresh})
    foreign = [p for p in periods if p in snapshot.months and not snapshot.months[p].landed]
    if foreign:
        raise ValueError(f"{table} holds months that were written without their files: {foreign}; load these files into a new table, or remove the months")
    given: dict[str, int] = {}
    if paths := [r["file_path"] for r in fresh if r["bytes"]]:
        if strict_file:
            rows, rejected = raw_source.scan_checked(spark, paths, params)
            rows = raw_source.without_bad_files(rows, rejected.where(F.col("reason") != raw_source.ANOTHER_MONTH))
        else:
            rows = raw_source.scan_raw(spark, paths, origin=True)
        own = _own_states(file_states(clean(rows, calendar, params).withColumn("file", F.col("file_path")), params), root)
        own.hint("rebalance", *PERIOD).write.partitionBy(*PERIOD).parquet(f"{base}/_states/load={load}")
        counted = _states(spark, table, [(load, *p) for p in periods]).groupBy("file").agg(F.sum("rows").alias("given"))
        given = {r.file: r.given for r in counted.collect()}
    entries = [r | {"rows": given.get(r["file"], 0), "load": load} if r["load"] is None else r for r in news]
    entry = spark.createDataFrame([tuple((r | {"seq": snapshot.number + 1})[f] for f in FILE_SCHEMA.names) for r in entries], FILE_SCHEMA)
    current = known.join(entry.select("file"), "file", "left_anti").unionByName(entry) if snapshot.ledgers else entry
    compact = len(snapshot.ledgers) >= LISTS
    (current if compact else entry).coalesce(1 + len(news) // 100_000).write.parquet(f"{base}/_files/load={load}")
    ledgers = (load,) if compact else (*snapshot.ledgers, load)
    version, present = versions.PLAIN, []
    if periods:
        if only is not None:
            current = current.join(only.select("file").distinct(), "file", "left_semi")
        summary = summary_of_states(states_of(spark, table, current, periods), params)
        if on_missing == "drop_month":
            summary = write_shared(summary, "summary")  # the gate reads it too
        version, present = versions.write_version(enrich(summary, meta, on_missing), table)

    def change(now: versions.Snapshot) -> versions.Snapshot:
        if now.number != snapshot.number:
            raise versions.Conflict(f"{table} has changed during this load; run it again")
        return replace(versions.with_months(now, version, present, periods, landed=True), ledgers=ledgers)

    versions.publish(spark, table, change, attempts=1)
    return len(fresh)


def _own_states(states: DataFrame, root: str) -> DataFrame:
    """States by path as states by file, without those of another month than their file's name has. Names are read once a state, not once a row."""
    states = computed_once(states.withColumnRenamed("file", "path"), "local", raw_source.decoded(F.col("path")))
    own = in_name_period(F.element_at(F.split("local", "/"), -1), F.make_date("year", "month_num", F.lit(1)))
    return states.where(own).withColumn("file", raw_source.file_id(F.col("local"), root)).select(*STATE_SCHEMA.names)


def _states(spark: SparkSession, table: str, parts: list[tuple[str, int, int]]) -> DataFrame:
    """States of the given (load, year, month), where there are any."""
    folder, base = versions.Folder(spark, table), table.rstrip("/")
    schema = T.StructType([*STATE_SCHEMA, T.StructField("load", T.StringType())])
    found = [f"{base}/_states/load={x}/year={y}/month_num={m}" for x, y, m in parts
             if folder.fs.exists(folder.path("_states", f"load={x}", f"year={y}", f"month_num={m}"))]
    return spark.read.option("basePath", f"{base}/_states").schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def states_of(spark: SparkSession, table: str, files: DataFrame, periods: list[tuple[int, int]]) -> DataFrame:
    """States of the given files in the given months; only their folders are read."""
    wanted = spark.createDataFrame(periods, "year INT, month_num INT")
    files = files.join(F.broadcast(wanted), PERIOD, "left_semi").where("rows > 0").select("file", "load", *PERIOD)
    parts = [tuple(r) for r in files.select("load", *PERIOD).distinct().collect()]  # some loads a month
    return _states(spark, table, parts).join(files.select("file", "load"), ["file", "load"], "left_semi")


def backfill(spark: SparkSession, raw_folder: str, table: str, meta: DataFrame, calendar: DataFrame,
             params: Params = Params(), *, on_missing: str = "drop_month", latest_only: bool = False,
             strict_file: bool = False, verify: bool = False) -> DataFrame:
    """Process every raw file that is new to ``table`` or differs from the version it has seen; returns the table.

    A late file of a month, a corrected one (of whatever size) and one that has been emptied bring their month up to date; see ``load_files``.
    Files that are no longer there keep what they gave. gzip text is parsed once.
    """
    files = raw_source.discover_files(spark, raw_folder)
    if latest_only:
        files = files.join(raw_source.latest_files(files).select("file_path"), "file_path", "left_semi")
    load_files(spark, files, table, meta, calendar, params, folder=raw_folder, on_missing=on_missing,
               strict_file=strict_file, verify=verify, only=files if latest_only else None)
    return scan_processed(spark, table)
