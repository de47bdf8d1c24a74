"""User parsers as table sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Parser = Callable[[pd.DataFrame], pd.DataFrame]


def extract(source: DataFrame, parser: Parser, schema: str, before: Parser | None = None, after: Parser | None = None) -> DataFrame:
    """Run a user parser over Arrow batches of ``source``; ``before`` and ``after`` are optional hooks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shaped = parser(before(batch) if before else batch)
            yield after(shaped) if after else shaped

    return source.mapInPandas(run, schema)
