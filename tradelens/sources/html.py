"""Links out of raw web pages (the listing pages of new filings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Fixed value: target of an anchor, in double or single quotes.
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href=["']([^"']*)["']"""


def page_links(pages: DataFrame, *, html: str = "html", suffix: str = "",
               prefix_regex: str = "^/Archives/") -> DataFrame:
    """Distinct anchor targets ending in ``suffix``, the archive prefix stripped."""
    links = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), 1)).alias("href"))
    if suffix:
        links = links.where(F.col("href").endswith(suffix))
    return links.select(S.strip_prefix("href", prefix_regex).alias("link")).distinct()
