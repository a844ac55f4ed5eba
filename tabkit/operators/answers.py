"""Scoring of written answers: expected facts, expected tools, ungrounded numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabkit.functions.columns import require_columns
from tabkit.functions.scalars import numbers_in


def fact_match(answer: Column, facts: Column) -> Column:
    """Share of the expected facts that occur in the answer, ignoring case; 1 if none is expected."""
    lowered = F.lower(answer)
    hits = F.size(F.filter(facts, lambda f: F.contains(lowered, F.lower(f))))
    return F.coalesce(F.try_divide(hits, F.nullif(F.size(facts), F.lit(0))), F.lit(1.0))


def tool_match(called: Column, expected: Column) -> Column:
    """Was any expected tool called? True if none is expected."""
    return F.coalesce((F.size(expected) == 0) | F.arrays_overlap(called, expected), F.lit(True))


def ungrounded_numbers(answer: Column, sources: Column) -> Column:
    """Distinct number tokens (longer than one character) of an answer that no source text contains."""
    known = F.flatten(F.transform(sources, numbers_in))
    return F.filter(F.array_except(numbers_in(answer), known), lambda n: F.length(n) > 1)


def ungrounded_turns(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    answering: str = "assistant",
) -> DataFrame:
    """Per answering turn the count of numbers that no earlier turn of the conversation mentions.

    A number is ungrounded exactly where it occurs first, so one minimum per (conversation, number)
    decides. Neither the turns of a conversation nor its numbers are ever gathered in one task.
    """
    require_columns(turns, [conversation, turn, role, text])
    numbers = turns.select(conversation, turn, role, F.explode(F.array_distinct(numbers_in(F.col(text)))).alias("number"))
    first = numbers.filter(F.length("number") > 1).groupBy(conversation, "number").agg(F.min(F.struct(turn, role)).alias("at"))
    new = first.filter(F.col(f"at.{role}") == answering).select(
        conversation, F.col(f"at.{turn}").alias(turn), F.lit(1).cast("long").alias("n")
    )
    every = turns.filter(F.col(role) == answering).select(conversation, turn, F.lit(0).cast("long").alias("n"))
    return every.unionByName(new).groupBy(conversation, turn).agg(F.sum("n").alias("ungrounded"))


def summarize(results: DataFrame) -> DataFrame:
    """Counts of completed and failed runs and the means over the completed ones.

    ``results`` has error, fact_match, tool_match, tool_calls, ungrounded, hit_limit and seconds.
    """
    done = F.col("error").isNull()

    def mean(column: str, digits: int) -> Column:
        value = F.col(column).cast("double")
        return F.round(F.avg(F.when(done, value)), digits).alias(f"avg_{column}")

    return results.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if(done).alias("n_completed"),
        F.count_if(~done).alias("n_failed"),
        mean("fact_match", 3),
        mean("tool_match", 3),
        mean("tool_calls", 2),
        F.count_if(done & F.col("hit_limit")).alias("n_hit_limit"),
        mean("ungrounded", 2),
        mean("seconds", 2),
    )
