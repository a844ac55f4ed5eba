"""Guarded read-only SQL over one DataFrame, visible as the view ``dataset``."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabkit.errors import SQLValidationError

VIEW = "dataset"
MAX_ROWS = 500

# Words that start a write, a definition or an import.
FORBIDDEN = (
    "insert", "update", "delete", "drop", "alter", "create", "attach", "detach", "copy", "export",
    "import", "pragma", "install", "load", "call", "vacuum", "grant", "revoke",
)
# Functions that reach beyond the data: JVM methods, files, other tables.
FORBIDDEN_FUNCTIONS = ("java_method", "reflect", "try_reflect", "read_files", "input_file_name")

_LITERAL = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.DOTALL)


@dataclass
class SqlResult:
    """At most ``MAX_ROWS`` rows of a query, and whether there were more."""

    query: str
    rows: DataFrame
    probe: DataFrame
    max_rows: int

    @property
    def columns(self) -> list[str]:
        return self.rows.columns

    def record(self) -> dict:
        """Query, columns, rows, row_count and truncated; one job, at most ``max_rows`` rows."""
        found = [r.asDict(recursive=True) for r in self.probe.collect()]
        rows = found[: self.max_rows]
        return {
            "query": self.query, "columns": self.columns, "rows": rows,
            "row_count": len(rows), "truncated": len(found) > self.max_rows,
        }

    def summary(self) -> DataFrame:
        """One row (row_count, truncated); never counts beyond the cap."""
        seen = self.probe.agg(F.count(F.lit(1)).alias("n"))
        return seen.select(
            F.least("n", F.lit(self.max_rows)).cast("long").alias("row_count"),
            (F.col("n") > self.max_rows).alias("truncated"),
        )


def check_text(query: str) -> str:
    """The query without its closing semicolon, or an error. Literals and comments are not searched."""
    text = query.strip().rstrip(";").strip()
    if not text:
        raise SQLValidationError("the query is empty")
    bare = _LITERAL.sub(" '' ", text)
    if ";" in bare:
        raise SQLValidationError("only one statement is allowed")
    if not re.match(r"(with|select)\b", bare.strip(), re.IGNORECASE):
        raise SQLValidationError("only SELECT queries, optionally with WITH, are allowed")
    for word in FORBIDDEN:
        if re.search(rf"\b{word}\b", bare, re.IGNORECASE):
            raise SQLValidationError(f"the word {word!r} is not allowed in a read-only query")
    for name in FORBIDDEN_FUNCTIONS:
        if re.search(rf"\b{name}\b", text, re.IGNORECASE):
            raise SQLValidationError(f"the function {name!r} is not allowed")
    if re.search(r"\bglobal_temp\b", text, re.IGNORECASE):
        raise SQLValidationError(f"only the view {VIEW!r} may be read")
    return text


def isolated_session(df: DataFrame) -> SparkSession:
    """A session whose only view is ``dataset`` and which cannot address files by path."""
    spark = df.sparkSession
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    name = f"tabkit_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        session.table(f"global_temp.{name}").createOrReplaceTempView(VIEW)
    finally:
        spark.catalog.dropGlobalTempView(name)
    return session


def _leaves(df: DataFrame) -> list:
    """Sources of the analysed plan, those inside subqueries included."""
    plan = df._jdf.queryExecution().analyzed()
    found = [plan.collectLeaves()]
    subqueries = plan.subqueriesAll()
    found += [subqueries.apply(i).collectLeaves() for i in range(subqueries.size())]
    return [leaves.apply(i) for leaves in found for i in range(leaves.size())]


def check_sources(result: DataFrame, dataset: DataFrame) -> None:
    """Every source must be the dataset, a common table expression, literals or a range."""
    allowed = _leaves(dataset)
    for leaf in _leaves(result):
        kind = leaf.nodeName()
        if kind in ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef"):
            continue
        if not any(leaf.sameResult(own) for own in allowed):
            raise SQLValidationError(f"only the view {VIEW!r} may be read, not {kind}")


def run_sql(df: DataFrame, query: str, max_rows: int = MAX_ROWS) -> SqlResult:
    """Run one read-only query over ``df``; at most ``max_rows`` rows come back."""
    text = check_text(query)
    session = isolated_session(df)
    try:
        result = session.sql(text)
        check_sources(result, session.table(VIEW))
    except PySparkException as exc:
        raise SQLValidationError(f"the query cannot run: {exc}") from exc
    return SqlResult(query, result.limit(max_rows), result.limit(max_rows + 1), max_rows)
