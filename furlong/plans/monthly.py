"""A month of races from landed calendar, day and result pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from furlong import fixed_values as fixed
from furlong.functions.text import query_value
from furlong.operators.aggregates import ids_per_date
from furlong.operators.joins import still_missing
from furlong.operators.project import concat_rows, rename_columns
from furlong.plans.race_result import build_race_results
from furlong.schemas import PAGE_KEYS
from furlong.sources.extract import read_cells, read_table
from furlong.sources.flat import item_links, table_links
from furlong.sources.tables import read_table as read_stored
from furlong.sources.tables import write_monthly


def race_dates(calendar_pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Dates linked from calendar pages; links without a date are dropped."""
    links = table_links(calendar_pages, keys, html, fixed.CALENDAR_TABLE_CLASS)
    dated = links.withColumn("race_date", query_value("href", fixed.DATE_PARAMETER, fixed.DATE_VALUE))
    return dated.filter(F.col("race_date").isNotNull()).select(*keys, "link_no", "race_date")


def race_ids(day_pages: DataFrame, html: str = "html") -> DataFrame:
    """Race ids listed on the pages of days (``race_date, html``)."""
    items = item_links(day_pages, ["race_date"], html, fixed.RACE_ITEM_CLASS)
    named = items.withColumn("race_id", query_value("href", fixed.RACE_PARAMETER))
    return named.filter(F.col("race_id").isNotNull()).select("race_date", "item_no", "race_id")


def pages_to_fetch(day_pages: DataFrame, landed: DataFrame) -> DataFrame:
    """Races listed for a day whose page has not landed, or landed empty."""
    return still_missing(race_ids(day_pages), landed, PAGE_KEYS, content="html")


def horse_history(pages: DataFrame, keys: list[str], html: str = "html", errors: str = "raise") -> DataFrame:
    """The race history of each horse page, all cells as text."""
    columns = {name: name for name in fixed.HISTORY_COLUMNS}
    return read_table(pages, keys, html, columns, css_class=fixed.HISTORY_TABLE_CLASS, errors=errors)


def horse_profile(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """The profile table of each horse page, row by row."""
    return read_cells(pages, keys, html, fixed.PROFILE_TABLE_CLASS, first_only=True).drop("table_no")


def with_source_names(rows: DataFrame) -> DataFrame:
    """Result rows under the header cells of the source, the horse number aside."""
    return rename_columns(
        rows, {name: header for header, name in fixed.RESULT_COLUMNS.items() if name != "horse_number"}
    )


def store_month(frames: list[DataFrame], path: str) -> None:
    """Stack result rows and write them by month; months that are there already are replaced, others stay."""
    write_monthly(concat_rows(frames), path, "race_date", mode="overwrite")


def horses_per_date(rows: DataFrame) -> DataFrame:
    """The horses that ran on each date, as lists of bounded length."""
    return ids_per_date(rows, "race_date", "horse_id")


class Month(NamedTuple):
    rows: DataFrame
    horses: DataFrame  # race_date, part, horse_ids
    missing: DataFrame  # race_date, race_id of listed races without a page
    rejects: DataFrame  # race_date, race_id, error of listed races whose page cannot be read


def collect_month(
    spark: SparkSession, calendar_pages: DataFrame, day_pages: DataFrame, result_pages: DataFrame, path: str
) -> Month:
    """Dates of the calendar, races of those days, their results; stored by month.

    ``calendar_pages`` holds ``html``, ``day_pages`` ``race_date, html`` and
    ``result_pages`` ``race_date, race_id, html``. Races whose page has not landed are
    listed as missing, those whose page cannot be read as rejects.
    """
    dates = race_dates(calendar_pages, []).select("race_date").distinct()
    days = day_pages.join(dates, "race_date", "left_semi")
    listed = race_ids(days).select(*PAGE_KEYS).distinct()
    wanted = result_pages.filter(F.length("html") > 0).join(listed, PAGE_KEYS, "left_semi")
    built = build_race_results(wanted, stage=True)
    store_month([with_source_names(built.rows)], path)
    rows = read_stored(spark, path)
    missing = still_missing(listed, result_pages, PAGE_KEYS, content="html")
    return Month(rows, horses_per_date(rows), missing, built.rejects)
