"""Season-based train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Test seasons of the stand-in play table (its seasons run 1995-2001; the last
# three are held out, as the final script holds out its last three).
FIXTURE_TEST_SEASONS = ("1999", "2000", "2001")


def mark_split(df: DataFrame, test_seasons: Sequence[str], col: str = "year") -> DataFrame:
    """Add ``is_test``: the row's season is one of ``test_seasons``."""
    return df.withColumn("is_test", F.col(col).isin(*[str(s) for s in test_seasons]))


def train_test_split(df: DataFrame, test_seasons: Sequence[str], col: str = "year") -> tuple[DataFrame, DataFrame]:
    """(train, test) by season; both are filters, so the season predicate can
    prune ``year=`` partitions of a written table."""
    marked = mark_split(df, test_seasons, col)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter(F.col("is_test")).drop("is_test")
