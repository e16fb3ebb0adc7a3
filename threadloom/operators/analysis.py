"""Conversation analysis: one aggregate over messages, then expressions per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import rules, sentiment
from threadloom.operators import transcripts
from threadloom.operators.scale import one_per_key, spread
from threadloom.operators.threads import BLOCK_MESSAGES, with_part
from threadloom.schemas import RECORD_COLUMNS

LOW_CONFIDENCE = 0.6
MAX_TAGS = 5
MAX_ISSUES = 3

# Texts that appear in the output.
SUMMARY_START = "Customer's "
SUMMARY_RESOLVED = " issue was successfully resolved"
SUMMARY_OPEN = " issue remains unresolved"
# End of fixed values.

def conversation_features(line_rows: DataFrame) -> DataFrame:
    """Message counts, summed valence and rule terms per conversation, from ``(conversation_id, sequence_number, line)``.

    Lines are single-line text, as cleaning leaves them. With a column ``customer_message`` each line is one message, and
    that column what the customer says in it; otherwise both are read off the line. Lines are narrow and are dealt by conversation and
    block; there each message yields its terms, which are added up in columns of fixed width, so a conversation gives a row for
    each block at most to the shuffle after it.
    """
    if "customer_message" in line_rows.columns:
        pieces, fragments = F.lit(1), F.array_compact(F.array("customer_message"))
    else:
        pieces, fragments = F.size(transcripts.pieces(F.col("line"))), transcripts.customer_pieces(F.col("line"))
    dealt = spread(with_part(line_rows, BLOCK_MESSAGES), "conversation_id", "part")
    per_message = dealt.select(
        "conversation_id",
        "sequence_number",
        F.lower("line").alias("transcript"),
        pieces.alias("pieces"),
        fragments.alias("fragments"),
    ).select(
        "conversation_id",
        "sequence_number",
        "transcript",
        "pieces",
        F.size("fragments").alias("heard"),
        F.concat_ws(" ", "fragments").alias("spoken"),
        F.lower(F.concat_ws(" ", "fragments")).alias("customer"),
    )
    per_message = sentiment.with_valence(per_message, "spoken")
    terms = rules.message_terms(F.col("valence"), F.col("pieces"), F.col("heard"))
    table = F.broadcast(rules.term_table(line_rows.sparkSession))
    answered = per_message.select("conversation_id", F.inline(terms)).join(table, F.col("term") == F.col("_term"), "left")
    return answered.groupBy("conversation_id").agg(*rules.conversation_measures(), *rules.conversation_terms())


def _resolution(features: DataFrame) -> DataFrame:
    solved = rules.family_hits("resolved_positive").cast("double")
    for hit in rules.gap_hits("resolved_confirmation"):
        solved = solved + hit * F.lit(0.8)
    scored = features.withColumns(
        {"resolved_score": solved, "unresolved_score": rules.family_hits("unresolved_indicators")}
    )
    won = (F.col("resolved_score") > F.col("unresolved_score")) & (F.col("resolved_score") > 0)
    spread = F.col("resolved_score") + F.col("unresolved_score") + 1
    return scored.withColumns(
        {
            "is_resolved": won,
            "resolution_confidence": F.when(won, F.least(F.col("resolved_score") / spread, F.lit(0.95))).otherwise(
                F.least(F.col("unresolved_score") / spread, F.lit(0.85))
            ),
        }
    )


def _urgency(features: DataFrame) -> DataFrame:
    levels = list(rules.URGENCY_PATTERNS)
    scored = features.withColumns({f"{level}_score": rules.family_hits(f"urgency_{level}") for level in levels})
    level = (
        F.when(F.col("critical_score") > 0, F.lit("critical"))
        .when(F.col("high_score") > 0, F.lit("high"))
        .when(F.col("low_score") > F.col("medium_score"), F.lit("low"))
        .otherwise(F.lit("medium"))
    )
    return scored.withColumn("urgency_level", level)


def _rule_labels(features: DataFrame) -> DataFrame:
    families = {"nature": list(rules.NATURE_PATTERNS), "behaviour": list(rules.BEHAVIOUR_PATTERNS)}
    scored = features.withColumns(
        {f"{kind}_{label}": rules.family_hits(f"{kind}_{label}") for kind, labels in families.items() for label in labels}
    )
    nature, nature_confidence = rules.best_label("nature", families["nature"])
    behaviour, behaviour_confidence = rules.best_label("behaviour", families["behaviour"])
    return scored.withColumns(
        {
            "nature_of_request": nature,
            "nature_confidence": nature_confidence,
            "customer_behavior": behaviour,
            "behavior_confidence": behaviour_confidence,
        }
    )


def _sentiment(features: DataFrame) -> DataFrame:
    return features.withColumn("compound", sentiment.compound(F.col("valence"))).withColumns(
        {
            "customer_sentiment": sentiment.bucket(F.col("compound")),
            "sentiment_confidence": sentiment.bucket_confidence(F.col("compound")),
        }
    )


def _tags() -> Column:
    def labelled(name: str, suffix: str) -> Column:
        return F.concat(F.col(name), F.lit(suffix))

    candidates = [
        F.when(F.col("nature_of_request") != "general", labelled("nature_of_request", "_issue")),
        F.when(F.col("customer_sentiment") != "neutral", labelled("customer_sentiment", "_customer")),
        F.when(F.col("urgency_level").isin("critical", "high"), labelled("urgency_level", "_urgency")),
        F.when(rules.said("escalat"), F.lit("escalation")),
        F.when(rules.said("first", "new", "never"), F.lit("first_time_customer")),
        F.when(rules.said("again", "before", "previous"), F.lit("repeat_customer")),
        F.when(rules.said("thank", "appreciate"), F.lit("polite_customer")),
    ]
    return F.slice(F.array_compact(F.array(*candidates)), 1, MAX_TAGS)


def _conversation_type() -> Column:
    return (
        F.when(F.col("piece_count") <= 2, F.lit("simple_inquiry"))
        .when(rules.said("escalat", "manager"), F.lit("escalation"))
        .when(F.col("piece_count") > 6, F.lit("complex_issue"))
        .otherwise(F.lit("follow_up"))
    )


def _summary() -> Column:
    ending = F.when(F.col("is_resolved"), F.lit(SUMMARY_RESOLVED)).otherwise(F.lit(SUMMARY_OPEN))
    return F.concat(F.lit(SUMMARY_START), F.col("nature_of_request"), ending)


def _agent_performance() -> Column:
    good, poor = F.col("good_words"), F.col("poor_words")
    return F.when((good > poor) & (good > 0), F.lit("good")).when(poor > good, F.lit("poor")).otherwise(F.lit("fair"))


def _needs_llm() -> Column:
    unsure = (
        (F.col("resolution_confidence") < LOW_CONFIDENCE)
        | (F.col("nature_confidence") < LOW_CONFIDENCE)
        | (F.col("behavior_confidence") < LOW_CONFIDENCE)
    )
    hard = F.col("nature_of_request").isin("complaint", "technical") & F.col("customer_sentiment").isin(
        "frustrated", "angry"
    )
    return unsure | hard


def _fallback() -> dict[str, Column]:
    # The record of a conversation without customer messages.
    return {
        "is_resolved": F.lit(False),
        "resolution_confidence": F.lit(0.5),
        "tags": F.array(F.lit("analysis_failed")),
        "nature_of_request": F.lit("general"),
        "customer_sentiment": F.lit("neutral"),
        "urgency_level": F.lit("medium"),
        "conversation_type": F.lit("simple_inquiry"),
        "customer_behavior": F.lit("neutral"),
        "resolution_summary": F.lit("Unable to analyze conversation"),
        "key_issues": F.array(F.lit("unknown")),
        "agent_performance": F.lit("fair"),
    }


def assess(features: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The analysis record of every conversation, with the scores behind it and the ``needs_llm`` flag.

    ``labels`` holds classifier output per conversation (nature, behaviour and their confidences); without it the
    pattern rules decide.
    """
    if labels is None:
        labelled = _rule_labels(features)
    else:
        labelled = features.join(labels, "conversation_id", "left")
    full = (
        labelled.transform(_resolution)
        .transform(_urgency)
        .transform(_sentiment)
        .withColumns(
            {
                "good_words": rules.words_said(rules.GOOD_AGENT_WORDS),
                "poor_words": rules.words_said(rules.POOR_AGENT_WORDS),
            }
        )
        .withColumns(
            {
                "tags": _tags(),
                "conversation_type": _conversation_type(),
                "resolution_summary": _summary(),
                "key_issues": rules.issues_named(MAX_ISSUES),
                "agent_performance": _agent_performance(),
                "needs_llm": _needs_llm(),
            }
        )
    )
    heard = F.col("customer_messages") > 0
    record = {name: F.when(heard, F.col(name)).otherwise(value) for name, value in _fallback().items()}
    return full.withColumns({**record, "needs_llm": heard & F.col("needs_llm")}).select(
        "conversation_id",
        *RECORD_COLUMNS,
        "needs_llm",
        "message_count",
        "piece_count",
        "customer_messages",
        "resolved_score",
        "unresolved_score",
        *[f"{level}_score" for level in rules.URGENCY_PATTERNS],
        "nature_confidence",
        "behavior_confidence",
        "compound",
        "sentiment_confidence",
    )


def analyse(grouped: DataFrame, labels: DataFrame | None = None, *, structured: bool = False) -> DataFrame:
    """Assessment of all conversations in a grouped message table.

    ``structured`` takes messages and speakers from the table's columns, so that a separator or a speaker's label inside a
    text does not count as one; by default the lines are read as they would be in a transcript.
    """
    lines = transcripts.structured_lines(grouped) if structured else transcripts.lines(grouped)
    return assess(conversation_features(lines), labels)


def analyse_transcripts(texts: DataFrame, text: str = "full_conversation") -> DataFrame:
    """Assessment of conversations given as ``(conversation_id, transcript)``."""
    return assess(conversation_features(transcripts.lines_of_transcripts(texts, text)))


def records(assessed: DataFrame) -> DataFrame:
    """The stored form: record columns, the method, and the whole record as JSON text."""
    return assessed.select(
        "conversation_id",
        *RECORD_COLUMNS,
        F.lit("hybrid").alias("analysis_method"),
        F.to_json(F.struct(*RECORD_COLUMNS)).alias("payload"),
    )


def with_defaults(partial: DataFrame) -> DataFrame:
    """Stored form of records that may lack values: each missing one gets its storage default."""
    defaults = {
        "is_resolved": F.lit(False),
        "resolution_confidence": F.lit(0.0),
        "tags": F.array().cast("array<string>"),
        "nature_of_request": F.lit(""),
        "customer_sentiment": F.lit(""),
        "urgency_level": F.lit(""),
        "conversation_type": F.lit(""),
        "customer_behavior": F.lit(""),
    }
    payload = F.to_json(F.struct(*RECORD_COLUMNS))
    return partial.withColumn("payload", payload).withColumns(
        {name: F.coalesce(F.col(name), value) for name, value in defaults.items()}
    ).select("conversation_id", *RECORD_COLUMNS, F.lit("hybrid").alias("analysis_method"), "payload")


def upsert(stored: DataFrame, fresh: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Stored rows, with one row per key, replaced by fresh ones of the same key; of fresh rows with one key the largest
    counts. Stored rows are filtered, not combined."""
    names = [name for name in stored.columns if name != key]
    kept = stored.join(fresh.select(key).distinct(), key, "left_anti").select(key, *names)
    return kept.unionByName(one_per_key(fresh, key, names, F.max))


def resolution_counts(analysis: DataFrame) -> DataFrame:
    return analysis.agg(
        F.count("*").alias("total_analyzed"), F.count_if("is_resolved").alias("resolved_count")
    ).withColumn("open_count", F.col("total_analyzed") - F.col("resolved_count"))


def unresolved(analysis: DataFrame) -> DataFrame:
    return analysis.where(~F.col("is_resolved"))


def unique_tags(analysis: DataFrame) -> DataFrame:
    return analysis.select(F.explode("tags").alias("tag")).distinct()


def tags_from_json(texts: DataFrame, column: str = "tags") -> DataFrame:
    """Distinct tags of JSON-text arrays; rows that are not valid JSON arrays are skipped."""
    return texts.select(F.explode(F.from_json(column, "array<string>")).alias("tag")).where(
        F.col("tag").isNotNull()
    ).distinct()


def tag_counts(analysis: DataFrame) -> DataFrame:
    return analysis.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("uses"))


def analysis_details(analysis: DataFrame) -> DataFrame:
    """Detail rows of the analysis report, by conversation."""
    return analysis.select(
        "conversation_id",
        F.when(F.col("is_resolved"), F.lit("resolved")).otherwise(F.lit("open")).alias("status"),
        "tags",
        "nature_of_request",
        "customer_sentiment",
        "urgency_level",
        "conversation_type",
        "customer_behavior",
    ).orderBy("conversation_id")
