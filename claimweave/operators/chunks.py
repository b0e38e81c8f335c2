"""User functions on pandas chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def process_in_chunks(
    df: DataFrame,
    func: Callable[..., pd.DataFrame],
    schema: StructType | str,
    chunk_size: int = 10_000,
    **kwargs,
) -> DataFrame:
    """Apply ``func`` to chunks of at most ``chunk_size`` rows and concatenate the results.

    Which rows share a chunk is not fixed, so ``func`` must treat rows independently.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), chunk_size):
                yield func(batch.iloc[start : start + chunk_size].reset_index(drop=True), **kwargs)

    return df.mapInPandas(run, schema)
