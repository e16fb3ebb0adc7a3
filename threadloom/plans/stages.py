"""The three stages as frames to frames, without storage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import analysis as analysing
from threadloom.operators import classifiers, cohorts, context, model_exchange, recommend, transcripts
from threadloom.operators.scale import checkpointed
from threadloom.operators.threads import BLOCK_MESSAGES


def assess_conversations(
    grouped: DataFrame, *, classifier: str = "ml", models=None, replies: DataFrame | None = None
) -> DataFrame:
    """Assessment of every conversation; ``classifier`` is ``ml`` or ``rules``; model replies are merged if given."""
    if classifier not in ("ml", "rules"):
        raise ValueError(f"unknown classifier {classifier!r}")
    labels = None
    if classifier == "ml":
        nature, behaviour = models or classifiers.built_in_models(grouped.sparkSession)
        labels = classifiers.classify(transcripts.lines(grouped), nature, behaviour)
    assessed = analysing.analyse(grouped, labels)
    if replies is not None:
        assessed = model_exchange.merge_replies(assessed, model_exchange.parse_analysis_replies(replies))
    return assessed


def behaviour_summary(analysis: DataFrame, cohort_table: DataFrame) -> DataFrame:
    """Analysed, resolved and open conversations, unique tags, cohorts."""
    parts = [
        analysing.resolution_counts(analysis),
        analysing.unique_tags(analysis).agg(F.count("*").alias("unique_tags")),
        cohort_table.agg(F.count("*").alias("cohorts_created")),
    ]
    names = [name for part in parts for name in part.columns]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in names])


@dataclass(frozen=True)
class NextActions:
    recommendations: DataFrame
    rejects: DataFrame
    reply_rejects: DataFrame | None


def next_actions(
    analysis: DataFrame,
    grouped: DataFrame,
    cohort_table: DataFrame,
    members: DataFrame,
    as_of: dt.datetime | str,
    *,
    replies: DataFrame | None = None,
    rules: bool = True,
    fit: bool = False,
) -> NextActions:
    """Recommendations for unresolved conversations; invalid ones are set aside with the reason."""
    customers = context.customer_context(analysis, grouped, cohort_table, members)
    read = usable = None
    if replies is not None:
        read = model_exchange.read_recommendation_replies(replies)
        usable = model_exchange.usable_replies(read)
    chosen = recommend.decide(customers, as_of, usable, rules=rules)
    # Stored before the split: both sides read it, and a filter on the reason would otherwise be pushed below the
    # optimisation steps with all of them inlined.
    optimised, _ = checkpointed(recommend.optimise(chosen, as_of, fit=fit))
    return NextActions(
        recommend.accepted(optimised),
        recommend.rejected(optimised),
        None if read is None else model_exchange.reply_rejects(read),
    )


def action_summary(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(F.count("*").alias("recommendations_generated"))


def with_chat_history(
    recommendations: DataFrame, grouped: DataFrame, *, fanout: bool = False, block_messages: int = BLOCK_MESSAGES
) -> DataFrame:
    return context.with_history(recommendations, grouped, fanout=fanout, block_messages=block_messages)


def cohort_tables(analysis: DataFrame) -> tuple[DataFrame, DataFrame]:
    return cohorts.build_cohorts(analysis)
