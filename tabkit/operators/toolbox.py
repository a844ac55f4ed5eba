"""The analyst's tools by name over one table. Failures come back as records, not as exceptions."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from tabkit.errors import InvalidArgumentsError, OperatorError, TabkitError
from tabkit.functions.scalars import truncated
from tabkit.operators import anomaly, charts, explain, models, profiling, sqltool, stats

SUMMARY_CHARS = 300


@dataclass
class ToolResult:
    tool: str
    ok: bool
    data: DataFrame | None = None
    error: str | None = None

    def page(self, limit: int = sqltool.MAX_ROWS) -> dict:
        """``columns``, at most ``limit`` ``rows`` as dictionaries, their ``row_count``, and whether more were ``truncated``."""
        if self.data is None:
            return {"columns": [], "rows": [], "row_count": 0, "truncated": False}
        found = [r.asDict(recursive=True) for r in self.data.limit(limit + 1).collect()]
        rows = found[:limit]
        return {"columns": self.data.columns, "rows": rows, "row_count": len(rows), "truncated": len(found) > limit}

    def records(self, limit: int = sqltool.MAX_ROWS) -> list[dict]:
        """The rows of a :meth:`page`."""
        return self.page(limit)["rows"]

    def summary(self) -> str:
        """Start of the first row as JSON, or the error."""
        if not self.ok or self.data is None:
            return f"error: {self.error}"
        row = self.data.limit(1).select(truncated(F.to_json(F.struct("*")), SUMMARY_CHARS).alias("s")).first()
        return row["s"] if row else "no rows"


class Toolbox:
    """Tools over one DataFrame. The last training result serves the explaining tools."""

    def __init__(self, df: DataFrame):
        self.df = df
        self._trained: models.TrainResult | None = None

    def inspect_dataset(self) -> DataFrame:
        return profiling.profile_columns(self.df)

    def profile_dataset(self) -> DataFrame:
        return profiling.profile_dataset(self.df)

    def calculate_statistics(
        self,
        operation: str,
        column: str | None = None,
        group_by: str | None = None,
        target_column: str | None = None,
        agg: str = "mean",
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        if operation == "describe_column" and column:
            return stats.describe_column(self.df, column)
        if operation == "group_statistics" and group_by and target_column:
            return stats.group_statistics(self.df, group_by, target_column, agg)
        if operation == "correlation_matrix":
            return stats.correlation_matrix(self.df, columns)
        raise InvalidArgumentsError(f"unknown operation or missing arguments: {operation!r}")

    def run_sql(self, query: str) -> DataFrame:
        """Up to one row more than a page holds, so that the page can tell whether it is whole."""
        return sqltool.run_sql(self.df, query).probe

    def create_visualization(self, chart_type: str, **arguments) -> DataFrame:
        return charts.chart_data(self.df, chart_type, **arguments)

    def train_baseline_model(self, target_column: str, **arguments) -> DataFrame:
        self._trained = models.train_baseline_model(self.df, target_column, **arguments)
        return self._trained.metrics

    def calculate_feature_importance(self, top_n: int = 15) -> DataFrame:
        return models.feature_importance(self._last(), top_n)

    def calculate_shap(self, top_n: int = 10) -> DataFrame:
        return explain.explain_best(self._last(), top_n)

    def detect_anomalies(self, columns: Sequence[str] | None = None, contamination: float = 0.05) -> DataFrame:
        return anomaly.detect_anomalies(self.df, columns, contamination).top()

    def _last(self) -> models.TrainResult:
        if self._trained is None:
            raise OperatorError("train a baseline model first")
        return self._trained

    @classmethod
    def tools(cls) -> dict[str, Callable[..., DataFrame]]:
        return {n: f for n, f in vars(cls).items() if inspect.isfunction(f) and not n.startswith("_") and n != "call"}

    @classmethod
    def specifications(cls) -> list[dict]:
        """Name, required and optional arguments of every tool."""
        found = []
        for name, function in cls.tools().items():
            parameters = list(inspect.signature(function).parameters.values())[1:]
            named = [p for p in parameters if p.kind is not inspect.Parameter.VAR_KEYWORD]
            found.append(
                {
                    "name": name,
                    "required": [p.name for p in named if p.default is inspect.Parameter.empty],
                    "optional": [p.name for p in named if p.default is not inspect.Parameter.empty],
                }
            )
        return found

    def call(self, tool: str, **arguments) -> ToolResult:
        """Run a tool; unknown names, wrong arguments and failures become an error record."""
        if tool not in self.tools():
            return ToolResult(tool, False, error=f"unknown tool {tool!r}; choose one of {sorted(self.tools())}")
        try:
            return ToolResult(tool, True, getattr(self, tool)(**arguments))
        except TabkitError as exc:
            return ToolResult(tool, False, error=str(exc))
        except TypeError as exc:
            return ToolResult(tool, False, error=f"wrong arguments for {tool!r}: {exc}")
        except PySparkException as exc:
            return ToolResult(tool, False, error=f"failed: {exc}")
        except Exception as exc:  # noqa: BLE001 - a tool must never stop its caller
            return ToolResult(tool, False, error=f"unexpected error: {exc}")
