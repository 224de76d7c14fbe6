"""Declarative description of a pipeline: table shape, quality rules, folders."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One quality rule: rows for which ``condition`` is true violate it.

    ``max_ratio`` None means report only. Otherwise the gate fails when
    violations / rows is strictly greater than ``max_ratio``.
    """

    metric: str
    condition: str
    label: str
    max_ratio: float | None = None


@dataclass(frozen=True)
class TableSpec:
    """Everything the layers need to know about one table.

    ``order_by`` says which of several rows with one key survives; remaining
    columns follow as tie-breaks, so the choice does not depend on the plan.
    ``measures`` are SQL aggregates of the gold table, by output name.
    """

    schema: T.StructType
    key: tuple[str, ...]
    rules: tuple[Rule, ...]
    fill: Mapping[str, Any] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()
    measures: Mapping[str, str] = field(default_factory=dict)
    duplicate_metric: str = "duplicate_ids"
    duplicate_label: str = "Duplicates"
    time_column: str = "ingestion_time"
    file_column: str = "source_file"
    date_column: str = "processed_date"


# The people table, its default age, its rule bounds and its chart labels.
PEOPLE = TableSpec(
    schema=T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("age", T.IntegerType()),
        ]
    ),
    key=("id",),
    rules=(
        Rule("null_ids", "id IS NULL", "Null IDs", max_ratio=0.5),
        Rule("negative_ages", "age < 0", "Neg. Ages"),
        Rule("invalid_ages", "age > 120", "Inv. Ages"),
    ),
    fill={"age": 45},
    measures={"average_age": "avg(age)", "total_users": "count(*)"},
)


@dataclass(frozen=True)
class Layout:
    """Folders of one pipeline under one base; any Hadoop file system will do."""

    base: str

    def _under(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def input(self) -> str:
        return self._under("input")

    @property
    def landing(self) -> str:
        return self._under("landing")

    @property
    def archive(self) -> str:
        return self._under("archive")

    @property
    def bronze(self) -> str:
        return self._under("tables/bronze")

    @property
    def silver(self) -> str:
        return self._under("tables/silver")

    @property
    def gold(self) -> str:
        return self._under("tables/gold")

    @property
    def dq_metrics(self) -> str:
        return self._under("tables/dq_metrics")

    @property
    def trace(self) -> str:
        return self._under("tables/pipeline_trace")

    @property
    def run_metrics(self) -> str:
        return self._under("tables/run_metrics")

    def checkpoint(self, query: str) -> str:
        return self._under(f"checkpoints/{query}")
