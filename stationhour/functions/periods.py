"""Month dimension, holiday calendar and period arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# English month and weekday names in calendar order.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# United States and California holidays.
# (name, month, day, first year)
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1),
    ("Cesar Chavez Day", 3, 31, 1995),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1),
    ("Veterans Day", 11, 11, 1),
    ("Christmas Day", 12, 25, 1),
]
# (name, month, weekday with Sunday = 1, first day of month it can fall on)
FLOATING_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 2, 15),
    ("Washington's Birthday", 2, 2, 15),
    ("Memorial Day", 5, 2, 25),
    ("Labor Day", 9, 2, 1),
    ("Columbus Day", 10, 2, 8),
    ("Thanksgiving Day", 11, 5, 22),
    ("Day After Thanksgiving", 11, 6, 23),
]


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def month_name(month_num: Column) -> Column:
    return F.get(_names(MONTHS), month_num - 1)


def weekday_name(date: Column) -> Column:
    return F.get(_names(WEEKDAYS), F.dayofweek(date) - 1)


def month_number(name: Column) -> Column:
    """Position of an English month name, null when unknown."""
    position = F.array_position(_names(MONTHS), name).cast("int")
    return F.when(position > 0, position)


def month_dimension(spark: SparkSession) -> DataFrame:
    """The twelve months as (month_num, month)."""
    numbered = spark.range(1, 13, numPartitions=1).select(F.col("id").cast("int").alias("month_num"))
    return numbered.withColumn("month", month_name(F.col("month_num")))


def with_every_month(years: DataFrame) -> DataFrame:
    """Repeat each row for the twelve calendar months, adding ``month_num``."""
    return years.withColumn("month_num", F.explode(F.sequence(F.lit(1), F.lit(12))))


def holiday_calendar(spark: SparkSession, first_year: int = 2019, last_year: int = 2025) -> DataFrame:
    """Holidays as (date, name); its size follows the requested span of years only.

    A fixed-date holiday on a weekend is also observed on the nearest weekday.
    """
    def rule(name: str, month: int, day: int, since: int, weekday: int | None) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(month).alias("month"), F.lit(day).alias("day"),
                        F.lit(since).alias("since"), F.lit(weekday).cast("int").alias("weekday"))

    rules = F.array(*[rule(name, month, day, since, None) for name, month, day, since in FIXED_HOLIDAYS],
                    *[rule(name, month, day, 1, weekday) for name, month, weekday, day in FLOATING_HOLIDAYS])
    dated = (spark.range(first_year, last_year + 1, numPartitions=1)
             .select(F.col("id").cast("int").alias("year"), F.explode(rules).alias("r"))
             .where("year >= r.since")
             .withColumn("base", F.make_date("year", "r.month", "r.day")))
    days_on = F.coalesce(F.pmod(F.col("r.weekday") - F.dayofweek("base"), F.lit(7)), F.lit(0)).cast("int")
    shift = F.when(F.col("r.weekday").isNull(), F.when(F.dayofweek("base") == 7, -1).when(F.dayofweek("base") == 1, 1))
    actual = F.struct(F.date_add("base", days_on).alias("date"), F.col("r.name").alias("name"))
    observed = F.struct(F.date_add("base", shift).alias("date"),
                        F.concat("r.name", F.lit(" (observed)")).alias("name"))
    return (dated.select(F.explode(F.array(actual, observed)).alias("h")).select("h.date", "h.name")
            .where("date IS NOT NULL"))


# Fixed value: the period in a file name.
NAME_PERIOD = r"(\d{4})_(\d{2})"


def name_period(file_name: Column) -> tuple[Column, Column]:
    """(year, month_num) from the first ``yyyy_mm`` in a file name; nulls if none or no such month."""
    year = F.regexp_extract(file_name, NAME_PERIOD, 1).try_cast("int")
    month = F.regexp_extract(file_name, NAME_PERIOD, 2).try_cast("int")
    valid = month.between(1, 12)
    return F.when(valid, year), F.when(valid, month)


def in_name_period(file_name: Column, date: Column) -> Column:
    """Whether ``date`` lies in the month that a file name states."""
    return F.regexp_extract(file_name, NAME_PERIOD, 0) == F.concat_ws(
        "_", F.lpad(F.year(date).cast("string"), 4, "0"), F.lpad(F.month(date).cast("string"), 2, "0"))


def with_name_period(files: DataFrame, column: str = "file_name") -> DataFrame:
    year, month = name_period(F.col(column))
    return (files.withColumns({"year": year, "month_num": month})
            .withColumn("month", month_name(F.col("month_num"))))


def previous_month(day: Column) -> tuple[Column, Column]:
    """(year, month name) of the calendar month before ``day``."""
    before = F.add_months(F.trunc(day, "MM"), -1)
    return F.year(before), month_name(F.month(before))


def period_date(year: Column, month: Column) -> Column:
    """First day of (year, month name); null when either is missing or not a period."""
    number = month_number(month)
    year = year.try_cast("int")
    return F.when(year.between(1, 9999) & number.isNotNull(), F.make_date(year, number, F.lit(1)))


def age_in_months(as_of: Column, day: Column) -> Column:
    """Whole 30-day months between ``day`` and ``as_of``, rounded down (negative in the future)."""
    return F.floor(F.datediff(as_of, day) / 30).cast("int")
