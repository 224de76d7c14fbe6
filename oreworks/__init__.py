"""oreworks: layered table pipelines (raw drop -> bronze -> gate -> silver -> gold) on PySpark."""

from oreworks.plans.medallion import RunResult, run_medallion
from oreworks.sources.versioned import VersionedTable
from oreworks.spec import PEOPLE, Layout, Rule, TableSpec

__all__ = ["PEOPLE", "Layout", "Rule", "RunResult", "TableSpec", "VersionedTable", "run_medallion"]
