"""JSON and HTML documents that were landed as text: listings, form catalogues, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationhour.functions.scalar import megabites
from stationhour.schemas import CATALOGUE_SCHEMA, LISTING_SCHEMA, MANIFEST_SCHEMA

# Fixed value: the assignment in a page script that carries the form catalogue.
PAGE_VARIABLE = "YAHOO.bts.Data"
# Rewrites that quote the bare keys of an object literal: after a brace, after a
# comma, before a colon.
KEY_QUOTING = [(r"\{\s*(\w)", '{"$1'), (r",\s*(\w)", ',"$1'), (r"(\w):", '$1":')]
# Districts meant by the entry "all".
DISTRICTS = [str(i) for i in range(1, 13)]


def flatten_listing(responses: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """File manifest from listing responses (file_type, district, year, json).

    A response without data yields no row; ``months`` keeps the named months that are available.
    """
    parsed = responses.withColumn("listing", F.from_json("json", LISTING_SCHEMA))
    by_month = parsed.select("file_type", "district", "year", F.explode("listing.data").alias("month", "files"))
    if months is not None:
        by_month = by_month.where(F.col("month").isin(list(months)))
    files = by_month.select("file_type", "district", "year", "month", F.explode("files").alias("f"))
    return files.select(
        "file_type", F.col("district").cast("string").alias("district"), F.col("year").cast("string").alias("year"),
        "month", "f.file_name", "f.file_id", megabites(F.col("f.bytes")).alias("megabites"),
        F.col("f.url").alias("download_url")).to(MANIFEST_SCHEMA)


def parse_catalogue(text: Column) -> Column:
    """Form catalogue JSON as struct(labels, form_data)."""
    return F.from_json(text, CATALOGUE_SCHEMA)


def file_types(catalogues: DataFrame, form_data: str = "form_data") -> DataFrame:
    """Distinct file types, the keys of the outer map."""
    return catalogues.select(F.explode(F.map_keys(form_data)).alias("file_type")).distinct()


def districts(catalogues: DataFrame, form_data: str = "form_data") -> DataFrame:
    """Districts offered per file type; a list that starts with "all" means the twelve districts."""
    inner = catalogues.select(F.explode(form_data).alias("file_type", "entries"))
    keys = F.map_keys("entries")
    offered = F.when(F.get(keys, F.lit(0)) == "all", F.array(*[F.lit(d) for d in DISTRICTS])).otherwise(keys)
    return (inner.select("file_type", F.explode(offered).alias("district")).distinct()
            .orderBy("file_type", F.col("district").try_cast("int")))


def page_script(html: Column, variable: str = PAGE_VARIABLE) -> Column:
    """Text of the first script element of a page that mentions ``variable``."""
    holding = F.filter(F.split(html, r"(?i)<script[^>]*>"), lambda part, i: (i > 0) & part.contains(variable))
    return F.get(F.split(F.get(holding, F.lit(0)), r"(?i)</script\s*>"), F.lit(0))


def page_object_json(html: Column, variable: str = PAGE_VARIABLE) -> Column:
    """JSON text of the object assigned to ``variable``, with bare keys quoted; null if absent."""
    name = variable.replace(".", r"\.")
    literal = F.regexp_extract(page_script(html, variable), rf"(?sm)^\s*{name}\s*=\s*(\{{.*?\}})\s*$", 1)
    quoted = literal
    for pattern, replacement in KEY_QUOTING:
        quoted = F.regexp_replace(quoted, pattern, replacement)
    return F.when(literal != "", quoted)


def page_catalogues(pages: DataFrame, html: str = "html", variable: str = PAGE_VARIABLE) -> DataFrame:
    """Add ``labels`` and ``form_data`` found in each page; null where there is none."""
    found = pages.withColumn("catalogue", parse_catalogue(page_object_json(F.col(html), variable)))
    return found.select(*pages.columns, "catalogue.labels", "catalogue.form_data")


def page_variants(pages: DataFrame, html: str = "html", variable: str = PAGE_VARIABLE, column: str = "catalogue") -> DataFrame:
    """Add the whole object found in each page as a VARIANT, whatever its depth; null where there is none or it is not JSON."""
    return pages.withColumn(column, F.try_parse_json(page_object_json(F.col(html), variable)))


def variant_leaves(rows: DataFrame, column: str = "catalogue") -> DataFrame:
    """The columns of ``rows`` but the variant, with a row for each of its leaves: path (keys from the root) and value as text.

    Objects are opened level by level until none is left, a job a level; anything else, lists included, is a leaf (a JSON null one without a value). An empty object has none, and neither has a null variant.
    """
    others = [c for c in rows.columns if c != column]
    level = rows.where(F.col(column).isNotNull()).select(*others, F.array().cast("array<string>").alias("path"), F.col(column).alias("node"))
    found = []
    while True:
        level = level.withColumn("inner", F.col("node").try_cast("map<string,variant>"))
        leaf = level.where("inner IS NULL")
        text = F.coalesce(F.col("node").try_cast("string"), F.to_json("node"))
        found.append(leaf.select(*others, "path", F.when(~F.is_variant_null("node"), text).alias("value")))
        inner = level.where("inner IS NOT NULL")
        if inner.isEmpty():
            break
        level = inner.select(*others, "path", F.explode("inner").alias("key", "node")).select(
            *others, F.concat("path", F.array("key")).alias("path"), "node")
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result
