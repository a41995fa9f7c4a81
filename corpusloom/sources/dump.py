"""Reading a compressed page dump in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import DUMP_PAGE

# The element that encloses one page.
OPEN_TAG = "<page>"
CLOSE_TAG = "</page>"


def scan_dump(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One row per ``<page>`` of an XML dump, plain or bzip2.

    The text reader cuts at the closing tag, which also works from the middle of a compressed
    file, so one large file feeds many tasks. Escaping keeps the tag out of page text. What
    precedes the first page, and the tail after the last, hold no page. The text is that of
    the last revision. A page that is not well-formed stops the job, or in lenient mode comes
    out empty.
    """
    pieces = spark.read.option("lineSep", CLOSE_TAG).text(path)
    start = F.instr("value", OPEN_TAG)
    xml = F.concat(F.substr("value", start), F.lit(CLOSE_TAG))
    page = F.from_xml(xml, DUMP_PAGE.simpleString(), {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST" if strict else "PERMISSIVE"})
    return (
        pieces.filter(start > 0)
        .select(page.alias("p"))
        .select(
            F.try_element_at("p.id", F.lit(1)).try_cast("long").alias("page_id"),
            F.coalesce("p.title", F.lit("")).alias("title"),
            F.col("p.ns").try_cast("int").alias("ns"),
            F.col("p.redirect").isNotNull().alias("redirect"),
            F.coalesce(F.try_element_at("p.revision", F.lit(-1))["text"]["_VALUE"], F.lit("")).alias("text"),
        )
    )


def write_dump(pages: DataFrame, path: str, compression: str = "bzip2") -> None:
    """Write ``(page_id, title, ns, redirect, text)`` in the dump's page format."""
    def escaped(name: str):
        value = F.col(name).cast("string")
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
            value = F.replace(value, F.lit(char), F.lit(entity))
        return value

    def element(name: str, value):
        return F.concat(F.lit(f"    <{name}>"), value, F.lit(f"</{name}>\n"))

    page = F.concat(
        F.lit("  <page>\n"),
        element("title", escaped("title")),
        element("ns", escaped("ns")),
        element("id", escaped("page_id")),
        F.when(F.col("redirect"), F.lit('    <redirect title="x" />\n')).otherwise(F.lit("")),
        F.lit("    <revision>\n      <id>1</id>\n      <text xml:space=\"preserve\">"),
        escaped("text"),
        F.lit("</text>\n    </revision>\n  </page>"),
    )
    pages.select(page.alias("value")).write.option("compression", compression).text(path)
