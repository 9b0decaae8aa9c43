"""The tables behind the before/after distribution report, one per figure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.describe import compare, unpivot_numbers
from statloom.operators.distribution import (
    adherence,
    box_stats,
    histogram,
    kernel_density,
    normal_overlay,
    qq_line,
    qq_points,
    violin_marks,
)
from statloom.operators.normality import SAMPLE, shapiro_groups
from statloom.operators.sampling import scatter_sample
from statloom.session import store

HISTOGRAM_BINS = 60
SCATTER_POINTS = 2000


class DistributionReport:
    """Two columns of one table; each method gives one figure's data.

    Where a figure shows both columns, ``variable`` tells them apart. Only the keys
    and the two columns are written for the figures to read.
    """

    def __init__(self, df: DataFrame, before: str, after: str, key_cols: Sequence[str]):
        self.before, self.after, self.keys = before, after, list(key_cols)
        both = [before, after]
        self.table = store(df.select(*dict.fromkeys([*key_cols, *both])), "report")
        self.long = unpivot_numbers(self.table, both, self.keys)
        self.by = ["variable"]

    def histograms(self) -> DataFrame:
        return histogram(self.long, "value", HISTOGRAM_BINS, self.by)

    def normal_overlays(self) -> DataFrame:
        return normal_overlay(self.long, "value", self.by)

    def qq_points(self, column: str) -> DataFrame:
        return qq_points(self.table, column, [k for k in self.keys if k != column])

    def qq_lines(self) -> DataFrame:
        lines = [
            qq_line(self.qq_points(c)).withColumn("variable", F.lit(c))
            for c in (self.before, self.after)
        ]
        return lines[0].unionByName(lines[1])

    def boxes(self) -> DataFrame:
        return box_stats(self.long, "value", self.by)

    def violins(self) -> DataFrame:
        return kernel_density(self.long, "value", self.by)

    def violin_marks(self) -> DataFrame:
        return violin_marks(self.long, "value", self.by)

    def statistics(self) -> DataFrame:
        return compare(self.table, self.before, self.after)

    def tests(self) -> DataFrame:
        tested = shapiro_groups(self.long, "value", self.by, self.keys, SAMPLE)
        return tested.withColumn("adherence", adherence("w"))

    def scatter(self) -> DataFrame:
        return scatter_sample(self.table, self.before, self.after, self.keys, SCATTER_POINTS)
