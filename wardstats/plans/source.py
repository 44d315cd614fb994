"""Where reports get their group partials from."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..columns import ADMISSION_TYPE, CONDITION, PROVIDER, ColumnMap, type_of
from ..operators.facts import admission_facts
from ..operators.stats import group_stats, merge_stats


@dataclass(frozen=True)
class AdmissionTable:
    """Raw admission rows; each report aggregates them with one scan."""

    raw: DataFrame
    cols: ColumnMap = ColumnMap()

    @cached_property
    def facts(self) -> DataFrame:
        return admission_facts(self.raw, self.cols)

    def by(self, *keys: str, los: bool = False, billing: bool = False) -> DataFrame:
        fields = [*keys, *(["admit", "discharge"] if los else []), *(["billing"] if billing else [])]
        for field in fields:
            source = getattr(self.cols, field)
            if type_of(self.raw, source) is None:
                raise ValueError(f"the admissions have no column {source!r}, named by ColumnMap.{field}")
        return group_stats(self.facts, *keys, los=los, billing=billing)

    def summary(self) -> DataFrame:
        """All partials per (condition, admission type, provider).

        Written once as a table, it answers any number of reports through
        ``SummaryTable``, for the price of one scan of the admissions.
        """
        return self.by(CONDITION, ADMISSION_TYPE, PROVIDER, los=True, billing=True)


@dataclass(frozen=True)
class SummaryTable:
    """A stored summary; reports add up its partials instead of the rows."""

    partials: DataFrame

    def by(self, *keys: str, los: bool = False, billing: bool = False) -> DataFrame:
        return merge_stats(self.partials, *keys, los=los, billing=billing)
