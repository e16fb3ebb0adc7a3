"""Cohorts: rule segments and tag segments over the analysis table."""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import title_case
from threadloom.operators.analysis import analysis_details, tag_counts
from threadloom.operators.scale import checkpointed

# Names, descriptions and criteria appear in the output; the order gives the cohort ids.
RULE_COHORTS = [
    {
        "name": "Frustrated Billing Customers",
        "description": "Customers with negative sentiment about billing issues",
        "criteria": {"nature_of_request": "billing", "customer_sentiment": ["negative", "frustrated"]},
    },
    {
        "name": "Technical Power Users",
        "description": "Customers with technical issues showing technical behavior",
        "criteria": {"nature_of_request": "technical", "customer_behavior": "technical"},
    },
    {
        "name": "Urgent Unresolved Issues",
        "description": "High urgency conversations that remain unresolved",
        "criteria": {"urgency_level": ["high", "critical"], "is_resolved": False},
    },
    {
        "name": "Satisfied Customers",
        "description": "Customers with positive sentiment and resolved issues",
        "criteria": {"customer_sentiment": ["positive", "satisfied"], "is_resolved": True},
    },
    {
        "name": "Impatient Customers",
        "description": "Customers showing impatient behavior patterns",
        "criteria": {"customer_behavior": ["impatient", "angry"]},
    },
    {
        "name": "Account Access Issues",
        "description": "Customers having trouble accessing their accounts",
        "criteria": {"nature_of_request": "account"},
    },
    {
        "name": "Complex Escalations",
        "description": "Complex issues that required escalation",
        "criteria": {"conversation_type": "escalation", "urgency_level": ["high", "critical"]},
    },
    {
        "name": "Polite General Inquiries",
        "description": "Polite customers with general questions",
        "criteria": {"customer_behavior": ["polite", "cooperative"], "nature_of_request": "general"},
    },
]
# End of fixed values.
COMMON_TAGS = 10
MIN_TAG_SIZE = 3


def matches(criteria: Mapping[str, object]) -> Column:
    """All fields must agree: a list means any of its values."""
    tests = [
        F.col(field).isin(expected) if isinstance(expected, (list, tuple)) else F.col(field) == F.lit(expected)
        for field, expected in criteria.items()
    ]
    return functools.reduce(lambda both, test: both & test, tests, F.lit(True))


def matching_conversations(analysis: DataFrame, criteria: Mapping[str, object]) -> DataFrame:
    return analysis.where(matches(criteria)).select("conversation_id")


def rule_members(analysis: DataFrame, definitions: Sequence[Mapping] = RULE_COHORTS) -> DataFrame:
    """``(conversation_id, position)`` of every rule cohort a conversation falls into, in one pass."""
    positions = [F.when(matches(each["criteria"]), F.lit(n)) for n, each in enumerate(definitions)]
    return analysis.select("conversation_id", F.explode(F.array_compact(F.array(*positions))).alias("position"))


def common_tags(analysis: DataFrame) -> DataFrame:
    """The most frequent tags that occur often enough, with their rank from 0; at most COMMON_TAGS rows."""
    top = tag_counts(analysis).orderBy(F.desc("uses"), "tag").limit(COMMON_TAGS)
    ranked = top.withColumn("position", F.row_number().over(Window.orderBy(F.desc("uses"), "tag")) - 1)
    return ranked.where(F.col("uses") >= MIN_TAG_SIZE)


def tag_members(analysis: DataFrame) -> DataFrame:
    """``(conversation_id, tag, position)`` for the common tags; the tag side has at most COMMON_TAGS rows."""
    tagged = analysis.select("conversation_id", F.explode(F.array_distinct("tags")).alias("tag"))
    return tagged.join(F.broadcast(common_tags(analysis).select("tag", "position")), "tag").select(
        "conversation_id", "tag", "position"
    )


def build_cohorts(analysis: DataFrame, definitions: Sequence[Mapping] = RULE_COHORTS) -> tuple[DataFrame, DataFrame]:
    """``(cohorts, members)``: rule cohorts first, then tag cohorts; empty cohorts do not appear.

    Ids are dense from 1 over (kind, position), so a rerun gives the same ids. ``analysis`` is read several times and
    should be a stored table. The cohorts, at most one a definition and common tag, are stored before members join them.
    """
    found = (
        rule_members(analysis, definitions)
        .select("conversation_id", F.lit(0).alias("kind"), "position", F.lit(None).cast("string").alias("tag"))
        .unionByName(tag_members(analysis).withColumn("kind", F.lit(1)))
    )

    def texts(values: Sequence[str]) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("position"))

    is_rule = F.col("kind") == 0
    cohorts = (
        found.groupBy("kind", "position", "tag")
        .agg(F.count("*").alias("conversation_count"))
        .where(is_rule | (F.col("conversation_count") >= MIN_TAG_SIZE))
        .select(
            F.row_number().over(Window.orderBy("kind", "position")).cast("bigint").alias("cohort_id"),
            F.when(is_rule, texts([each["name"] for each in definitions]))
            .otherwise(F.concat(F.lit("Tag: "), title_case(F.replace("tag", F.lit("_"), F.lit(" ")))))
            .alias("cohort_name"),
            F.when(is_rule, texts([each["description"] for each in definitions]))
            .otherwise(F.concat(F.lit("Conversations tagged with '"), F.col("tag"), F.lit("'")))
            .alias("cohort_description"),
            F.when(is_rule, texts([json.dumps(each["criteria"]) for each in definitions]))
            .otherwise(F.concat(F.lit('{"tag": "'), F.col("tag"), F.lit('"}')))
            .alias("cohort_criteria"),
            "conversation_count",
            "kind",
            "position",
        )
    )
    cohorts, _ = checkpointed(cohorts)
    members = found.join(F.broadcast(cohorts.select("cohort_id", "kind", "position")), ["kind", "position"]).select(
        "conversation_id", "cohort_id"
    )
    return cohorts.drop("kind", "position"), members


def cohort_summary(cohorts: DataFrame, members: DataFrame) -> DataFrame:
    """Every cohort with its actual member count (0 when it has none), largest first."""
    counted = members.groupBy("cohort_id").agg(F.count("conversation_id").alias("actual_count"))
    return (
        cohorts.join(counted, "cohort_id", "left")
        .withColumn("actual_count", F.coalesce("actual_count", F.lit(0).cast("bigint")))
        .orderBy(F.desc("actual_count"), "cohort_id")
    )


def _sampled_members(members: DataFrame, per_cohort: int) -> DataFrame:
    """The first conversations of each cohort. Spark limits the ranking per task before the shuffle."""
    in_cohort = Window.partitionBy("cohort_id").orderBy("conversation_id")
    return members.withColumn("rank", F.row_number().over(in_cohort)).where(F.col("rank") <= per_cohort).drop("rank")


def cohort_samples(analysis: DataFrame, members: DataFrame, per_cohort: int = 3) -> DataFrame:
    """The first conversations of each cohort with two of their fields.

    The sample holds at most ``per_cohort`` rows for each cohort, and there are at most as many cohorts as definitions
    and common tags, so it is sent to the analysis rather than the other way round.
    """
    sample = F.broadcast(_sampled_members(members, per_cohort))
    return analysis.join(sample, "conversation_id").select(
        "cohort_id", "conversation_id", "customer_sentiment", "nature_of_request"
    )


def cohort_report(cohorts: DataFrame, members: DataFrame, per_cohort: int = 3) -> DataFrame:
    """Summary with the sample conversation ids of each cohort."""
    samples = (
        _sampled_members(members, per_cohort)
        .groupBy("cohort_id")
        .agg(F.array_sort(F.collect_list("conversation_id")).alias("sample_conversations"))
    )
    empty = F.array().cast("array<bigint>")
    return (
        cohort_summary(cohorts, members)
        .join(samples, "cohort_id", "left")
        .withColumn("sample_conversations", F.coalesce("sample_conversations", empty))
        .orderBy(F.desc("actual_count"), "cohort_id")
    )


def analysis_report(analysis: DataFrame, cohorts: DataFrame) -> DataFrame:
    """The figures of an analysis run as rows of (section, name, size).

    Sections: ``status`` (resolved and open conversations), ``cohort`` (conversations of each), ``tag`` (uses of each). A status
    that no conversation has gives no row; a conversation without a known state is open. Every section is a partial
    aggregate, so no row count but that of distinct tags reaches the shuffle.
    """
    status = analysis_details(analysis).groupBy(F.col("status").alias("name")).agg(F.count("*").alias("size"))
    sections = {
        "status": status,
        "cohort": cohorts.select(F.col("cohort_name").alias("name"), F.col("conversation_count").alias("size")),
        "tag": tag_counts(analysis).select(F.col("tag").alias("name"), F.col("uses").alias("size")),
    }
    return functools.reduce(
        DataFrame.unionByName, [rows.select(F.lit(name).alias("section"), "name", "size") for name, rows in sections.items()]
    )
