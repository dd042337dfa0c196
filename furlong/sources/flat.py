"""Links and list items of flat pages, by expressions in the JVM.

For pages whose wanted elements do not lie within each other: lists of links, calendars, lists
of a day. Pages with tables in cells need the parser of ``extract``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlong.functions import text


def page_links(pages: DataFrame, keys: list[str], html: str, link_key: str, name: str = "name", prefix: str = "link") -> DataFrame:
    """Links to ``<link_key>/<id>`` as (name, id)."""
    links = pages.filter(F.length(html) > 0).select(*keys, F.explode(text.link_elements(text.without_comments(html))).alias("__link"))
    href = text.tag_attribute(F.col("__link"), "href")
    found = links.withColumn(f"{prefix}_id", text.id_after(href, link_key)).filter(F.col(f"{prefix}_id").isNotNull())
    return found.select(*keys, text.inner_text(F.col("__link")).alias(name), f"{prefix}_id")


def item_links(pages: DataFrame, keys: list[str], html: str, item_class: str | None = None) -> DataFrame:
    """The first link of each list item (of a class, if given): place among those items, href and text."""
    items = text.elements(text.without_comments(html), "li", r"</li\s*>|<li[\s>]|</[uo]l\s*>")
    if item_class is not None:
        items = F.filter(items, lambda item: text.has_class(item, item_class))
    listed = pages.filter(F.length(html) > 0).select(*keys, F.posexplode(items).alias("item_no", "__item"))
    link = listed.withColumn("__link", F.get(text.link_elements("__item"), 0))
    found = link.select(*keys, "item_no", text.tag_attribute(F.col("__link"), "href").alias("href"), text.inner_text(F.col("__link")).alias("text"))
    return found.filter(F.col("href").isNotNull())


def table_links(pages: DataFrame, keys: list[str], html: str, css_class: str) -> DataFrame:
    """Every link in the first table of a class: place among the table's links and href. A page without that table fails."""
    tables = F.filter(text.elements(text.without_comments(html), "table", r"</table\s*>"), lambda table: text.has_class(table, css_class))
    table = F.get(tables, 0)
    sure = F.when(table.isNotNull(), table).otherwise(F.raise_error(F.lit(f"no table {css_class}")).cast("string"))
    links = pages.filter(F.length(html) > 0).select(*keys, F.posexplode(text.link_elements(sure)).alias("link_no", "__link"))
    found = links.select(*keys, "link_no", text.tag_attribute(F.col("__link"), "href").alias("href"))
    return found.filter(F.col("href").isNotNull())
