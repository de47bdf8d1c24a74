"""Page-text source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_pages(pages: DataFrame, column: str = "text", least: int = 50) -> DataFrame:
    """Collapse blank lines, trim, and drop pages with ``least`` characters or fewer."""
    text = F.trim(F.regexp_replace(column, r"\n\s*\n", "\n\n"))
    return pages.withColumn(column, text).filter(F.length(column) > least)
