"""From landed listing responses to files that are still to be fetched, and the record of those that were."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationhour.operators.files import new_files
from stationhour.sources.documents import flatten_listing
from stationhour.schemas import MANIFEST_SCHEMA
from stationhour.session import write_shared
from stationhour.sources.tables import append_ledger, scan_ledger


def pending_files(responses: DataFrame, requests: DataFrame, ledger: DataFrame,
                  months: Sequence[str] | None = None) -> DataFrame:
    """Files in the responses to ``requests`` (file_type, district, year) that are not in the ledger."""
    asked = responses.join(requests.select("file_type", "district", "year").distinct(),
                           ["file_type", "district", "year"], "left_semi")
    return new_files(flatten_listing(asked, months), ledger)


def each_file_once(files: DataFrame) -> DataFrame:
    """One row for each file, told apart as in ``new_files``."""
    identity = F.coalesce("file_id", "file_name", "download_url")
    return files.withColumn("identity", identity).dropDuplicates(["identity"]).drop("identity")


def record_fetched(spark: SparkSession, fetched: DataFrame, ledger_path: str) -> DataFrame:
    """Append files that have been fetched to the ledger table and return those it did not hold yet.

    ``fetched`` has the columns of the manifest, or also ``ok``: rows where it is not true are left out, so that files whose transfer failed stay
    pending. Rows that name one file twice are recorded once, and so are files that are reported again.
    """
    done = fetched.where("ok") if "ok" in fetched.columns else fetched
    first = each_file_once(done.select(*MANIFEST_SCHEMA.names))
    new = write_shared(new_files(first, scan_ledger(spark, ledger_path)), "fetched-files")
    append_ledger(new, ledger_path)
    return new


def list_new_files(responses: DataFrame, requests: DataFrame, ledger_path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The pending files, each once, as a list that no longer changes. The ledger is left alone: ``record_fetched`` confirms
    what has been fetched, and what has not is listed again next time."""
    found = pending_files(responses, requests, scan_ledger(responses.sparkSession, ledger_path), months)
    return write_shared(each_file_once(found), "new-files")
