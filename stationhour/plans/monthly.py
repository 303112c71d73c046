"""The monthly round: what the month before a day brought, and what becomes of the files at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationhour.functions.periods import previous_month
from stationhour.operators.files import request_grid, retention
from stationhour.plans.manifest import list_new_files


def monthly_round(responses: DataFrame, scopes: DataFrame, base_url: str, ledger_path: str, held: DataFrame, as_of: str,
                  **options) -> tuple[DataFrame, DataFrame]:
    """(files of the month before ``as_of`` that are still to be fetched, retention decisions on all files held).

    ``scopes`` has file_types and districts (arrays); ``held`` is (kind, file_name, year, month name); ``options`` go to
    ``retention``. The files to fetch are judged as raw files along with those held. ``plans.manifest.record_fetched`` confirms them; until then every
    round lists them.
    """
    year, month = responses.sparkSession.range(1).select(*previous_month(F.lit(as_of).cast("date"))).first()
    requests = request_grid(scopes.withColumns({"start_year": F.lit(year), "end_year": F.lit(year)}), base_url)
    found = list_new_files(responses, requests, ledger_path, [month])
    fetched = found.select(F.lit("raw").alias("kind"), "file_name", "year", "month")
    every = held.select("kind", "file_name", "year", "month").unionByName(fetched).distinct()
    return found, retention(every, as_of, **options)
