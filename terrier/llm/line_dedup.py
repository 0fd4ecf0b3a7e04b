"""Boilerplate lines of a site: lines on more than a given share of the site's pages are dropped.

A page counts once for each distinct line. Counting is one combining aggregate over two hashes per
line. The lines that exceed the share are few for each site by arithmetic: their shares add up to no
more than the lines of an average page, so there are at most ``lines per page / max_share`` of them.
One array per site therefore goes back to the pages; a site with very many pages is spread over salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line on more than this share of its site's pages is boilerplate.
MAX_SHARE = 0.1
#: ... if it is on so many pages at least: the lines of a site with one page are all on all pages.
MIN_PAGES = 3
#: Each site's pages are spread over so many values when they look up the site's boilerplate.
SALTS = 32


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def drop_boilerplate_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    site_col: str = "source",
    text_col: str = "text",
    max_share: float = MAX_SHARE,
    min_pages: int = MIN_PAGES,
    length_col: str | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with the text edited, then ``lines_before`` and ``lines_dropped``.

    Lines end at line feeds and are compared without spaces, tabs and carriage returns at their ends.
    Blank lines are never boilerplate. Rows without a site form one site. A null text stays null and
    has no lines, but its page counts for the site; a page whose lines all go keeps an empty text;
    repeated rows count as pages of their own. Input columns of the two added names are replaced.
    ``length_col`` names a column with the text's length, if there is one, that is kept in step.
    """
    site, text = F.col(site_col), F.col(text_col)
    lines = F.array_remove(F.array_distinct(F.transform(F.split(text, "\n"), _bare)), "")
    on_pages = (
        docs.select(site.alias("site"), F.explode(lines).alias("line"))
        .select("site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
        .groupBy("site", "h1", "h2")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = docs.groupBy(site.alias("of_site")).agg(F.count("*").alias("total"))
    common = on_pages.join(totals, F.col("site").eqNullSafe(F.col("of_site"))).where(F.col("pages") > F.col("total") * max_share)
    per_site = (
        common.groupBy("site")
        .agg(F.collect_set("h1").alias("boilerplate"))
        .select(
            F.col("site").alias("boilerplate_site"),
            "boilerplate",
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("boilerplate_salt"),
        )
    )
    # Packed in one column, the rows can't clash with the names below, whatever theirs are.
    columns = [c for c in docs.columns if c not in ("lines_before", "lines_dropped")]
    rows = docs.select(F.struct(*columns).alias("row"))
    row = {c: F.col("row")[c] for c in columns}
    salt = F.pmod(F.xxhash64(row[id_col], row[text_col]), F.lit(SALTS)).cast("int")
    at_site = row[site_col].eqNullSafe(F.col("boilerplate_site")) & (salt == F.col("boilerplate_salt"))
    joined = rows.join(per_site, at_site, "left")
    split = F.split(row[text_col], "\n")
    hashes = F.transform(split, lambda line: F.xxhash64(_bare(line)))
    held = joined.select("row", split.alias("lines"), F.array_intersect(hashes, "boilerplate").alias("here"))
    kept = F.filter("lines", lambda line: ~F.array_contains(F.col("here"), F.xxhash64(_bare(line))))
    touched = F.size("here") > 0
    edited = F.when(touched, F.array_join(kept, "\n")).otherwise(row[text_col])
    count = F.when(row[text_col].isNull(), F.lit(0)).otherwise(F.size("lines"))
    dropped = F.when(touched, F.size("lines") - F.size(kept)).otherwise(F.lit(0))
    new = {text_col: edited.alias("text"), "lines_before": count.cast("long").alias("before"), "lines_dropped": dropped.cast("long").alias("dropped")}
    if length_col:
        in_step = F.when(touched, F.length(edited)).otherwise(row[length_col])
        new[length_col] = in_step.cast(docs.schema[length_col].dataType).alias("length")
    done = held.select("row", F.struct(*new.values()).alias("new"))
    name = {text_col: "text", "lines_before": "before", "lines_dropped": "dropped", length_col: "length"}
    return done.select(*[(F.col("new")[name[c]] if c in new else row[c]).alias(c) for c in [*columns, "lines_before", "lines_dropped"]])
