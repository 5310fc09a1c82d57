"""Line dedup by site-relative frequency: lines that many pages of one host share are furniture."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stage

# Names of this module's working columns, unlike any a table has.
HOST, LINES, FURNITURE, TOTAL = "__ld_host", "__ld_lines", "__ld_furniture", "__ld_total"

# A line goes if it stands on more than this share of its host's pages: in sf0.1, furniture
# stands on 8.6% of a host's pages or more, the next most frequent lines on 4.8% or less,
BOILERPLATE_RATIO = 0.06
# and on at least so many of them: on a host of few pages every line has a high share.
MIN_PAGES = 5


def line_key(line: Column) -> Column:
    """What makes lines equal: their text without spaces at both ends, as a 128-bit digest."""
    return F.unhex(F.md5(F.trim(line).cast("binary")))


def boilerplate_lines(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """The furniture of each host: ``__ld_host`` and ``__ld_furniture``, an array of line keys.

    A line counts once for a page. The shares of a host's lines add up to its mean number of
    lines for a page, so an array has that number divided by ``ratio`` entries at most, however
    many pages the host has. Both counts combine before their shuffle: a host with a third of
    all pages is a few rows from each task.
    """
    site = pages.select(
        F.col(host).alias(HOST),
        F.array_distinct(
            F.transform(
                F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), is_line), line_key
            )
        ).alias(LINES),
    )
    totals = site.groupBy(HOST).agg(F.count("*").alias(TOTAL))
    counts = (
        site.select(HOST, F.explode(LINES).alias("line"))
        .groupBy(HOST, "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    total_host = F.col(f"t.{HOST}")
    return (
        counts.alias("c")
        .join(totals.alias("t"), F.col(f"c.{HOST}").eqNullSafe(total_host))
        .where(F.col("n") > ratio * F.col(TOTAL))
        .groupBy(total_host.alias(HOST))
        .agg(F.collect_list("line").alias(FURNITURE))
    )


def is_line(line: Column) -> Column:
    """Whether a line holds anything; blank lines only give a text its shape."""
    return F.trim(line) != ""


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
    dropped: str | None = None,
) -> DataFrame:
    """All rows and columns of ``pages``, their texts without the furniture of their host.

    A line (text between line feeds) is furniture if it stands on more than ``ratio`` of the
    host's pages and on ``min_pages`` at least. Blank lines stay. A page that has nothing but
    furniture keeps its row, with an empty text. A null text stays null and counts as a page without lines; pages without a host form a site
    of their own; repeated rows count each. An empty table gives an empty one. ``dropped`` names
    a further column for the number of lines that went. Texts of any length are taken whole; other
    columns may have any name but those that start with ``__ld_``.

    Each host's furniture is a short array. It is written first, so that its size is known before
    the pages are joined to it by host: while it is small, no text moves.
    """
    furniture = stage(boilerplate_lines(pages, host, text, ratio, min_pages), "furniture")
    own = pages.columns
    lines = F.split(F.col(f"p.{_quoted(text)}"), "\n")
    page_host = F.col(f"p.{_quoted(host)}")
    kept = F.filter(
        lines, lambda line: ~(is_line(line) & F.array_contains(FURNITURE, line_key(line)))
    )
    joined = (
        pages.alias("p")
        .join(furniture.alias("f"), page_host.eqNullSafe(F.col(f"f.{HOST}")), "left")
        .withColumn(LINES, F.when(F.col(FURNITURE).isNotNull(), kept))
    )
    cleaned = F.when(
        F.col(LINES).isNotNull(), F.array_join(F.col(LINES), "\n")
    ).otherwise(F.col(f"p.{_quoted(text)}"))
    columns = [
        (cleaned if name == text else F.col(f"p.{_quoted(name)}")).alias(name) for name in own
    ]
    if dropped:
        went = F.when(F.col(LINES).isNotNull(), F.size(lines) - F.size(LINES)).otherwise(0)
        columns = [c for c, name in zip(columns, own, strict=True) if name != dropped]
        columns.append(went.cast("long").alias(dropped))
    return joined.select(columns)


def _quoted(name: str) -> str:
    return f"`{name}`"
