"""Language-model exchange as tables: requests are rendered, replies are read, parsed and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import strip
from threadloom.operators.context import HISTORY_SEPARATOR
from threadloom.operators.recommend import CHANNELS, STATUSES
from threadloom.operators.threads import BLOCK_MESSAGES
from threadloom.operators.transcripts import transcripts
from threadloom.schemas import RECORD_COLUMNS

_LISTS = ["tags", "key_issues"]
_REPLY_FIELDS = ["channel", "send_time", "message", "reasoning", "issue_status"]

ANALYSIS_INSTRUCTIONS = """\
Read the customer-support conversation below and judge it.

{conversation}

Answer with one JSON object and nothing else. Its fields:
is_resolved (true or false): the issue was solved or the customer is content.
resolution_confidence (0.0 to 1.0): how certain that is.
tags (3 to 5 short labels): what the conversation is about.
nature_of_request: billing, technical, account, general, product_info or complaint.
customer_sentiment: positive, negative, neutral, frustrated or satisfied.
urgency_level: low, medium, high or critical.
conversation_type: simple_inquiry, complex_issue, escalation or follow_up.
customer_behavior: polite, impatient, technical, confused, angry or cooperative.
resolution_summary: one sentence on what happened.
key_issues (list): the main problems named.
agent_performance: poor, fair, good or excellent.
"""

RECOMMENDATION_INSTRUCTIONS = """\
Choose the next best action for this unresolved support case.

{facts}

Conversation so far:
{history}

Channels: twitter_dm_reply for quick answers, email_reply for detailed or formal ones, scheduling_phone_call for
complex, urgent or sensitive cases.
Timing: urgent cases within two hours, medium within eight, low within a day, during office hours (9 to 18).
Message: acknowledge the concern, give clear next steps, match the tone to channel and mood.
Status: resolved if the message settles the issue, pending_customer_reply if the customer has to act or answer.

Answer with one JSON object and nothing else, with the fields channel, send_time (ISO 8601, UTC), message,
reasoning (specific to this customer) and issue_status.
"""


def _render(template: str, **parts: Column) -> Column:
    """A text template with columns put in for its named places."""
    pieces: list[Column] = []
    rest = template
    for name, value in parts.items():
        before, _, rest = rest.partition("{" + name + "}")
        pieces += [F.lit(before), value]
    return F.concat(*pieces, F.lit(rest))


def analysis_requests(assessed: DataFrame, grouped: DataFrame, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """A prompt for every conversation flagged ``needs_llm``, with its whole transcript."""
    flagged = assessed.where("needs_llm").select("conversation_id")
    texts = transcripts(grouped.join(flagged, "conversation_id", "left_semi"), block_messages)
    return texts.select(
        "conversation_id", _render(ANALYSIS_INSTRUCTIONS, conversation=F.col("full_conversation")).alias("prompt")
    )


def one_reply(replies: DataFrame, last_choice: Column | None = None) -> DataFrame:
    """One row per conversation: rows for which ``last_choice`` holds only if there is no other, then the smallest in
    the order of the columns. A minimum, so copies combine before the shuffle."""
    names = [name for name in replies.columns if name != "conversation_id"]
    kept = replies.withColumn("_last", F.lit(False) if last_choice is None else F.coalesce(last_choice, F.lit(False)))
    best = kept.groupBy("conversation_id").agg(F.min(F.struct("_last", *names)).alias("best"))
    return best.select("conversation_id", *[F.col("best")[name].alias(name) for name in names])


def unfence(text: Column) -> Column:
    """The text without surrounding whitespace and code fence."""
    opened = F.regexp_replace(strip(text), r"^(?:```json)?(?:```)?", "")
    return strip(F.regexp_replace(opened, r"```\z", ""))


def _is_object(text: Column) -> Column:
    """One JSON object and nothing after it (the JSON reader alone would accept trailing text)."""
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.startswith(text, F.lit("{")) & F.coalesce(alone, F.lit(False))


def _fields(text: Column, names: list[str]) -> Column:
    """The named fields as text, null as a whole when the text is not a JSON object."""
    schema = ", ".join(f"{name} STRING" for name in [*names, "_corrupt"])
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    parsed = F.from_json(text, schema, options)
    return F.when(_is_object(text) & parsed["_corrupt"].isNull(), parsed)


def parse_analysis_replies(replies: DataFrame) -> DataFrame:
    """``(conversation_id, response_text)`` to analysis records; unreadable text gives the failure record.

    A field that is null counts as missing.
    """
    read = replies.select("conversation_id", unfence(F.col("response_text")).alias("text")).select(
        "conversation_id", _fields(F.col("text"), RECORD_COLUMNS).alias("reply")
    )
    value = {name: F.col("reply")[name] for name in RECORD_COLUMNS}
    for name in _LISTS:
        value[name] = F.from_json(value[name], "array<string>")
    value["is_resolved"] = F.coalesce(value["is_resolved"].try_cast("boolean"), F.lit(False))
    value["resolution_confidence"] = value["resolution_confidence"].try_cast("double")
    # Replacements for missing fields, and the record of a failed reply.
    missing = {
        "tags": F.array(F.lit("unanalyzed")),
        "nature_of_request": F.lit("general"),
        "customer_sentiment": F.lit("neutral"),
    }
    failure = {
        "is_resolved": F.lit(False),
        "resolution_confidence": F.lit(0.0),
        "tags": F.array(F.lit("gemini_analysis_failed")),
        "nature_of_request": F.lit("unknown"),
        "customer_sentiment": F.lit("neutral"),
        "urgency_level": F.lit("medium"),
        "conversation_type": F.lit("unknown"),
        "customer_behavior": F.lit("unknown"),
        "resolution_summary": F.lit("Analysis failed"),
        "key_issues": F.array(F.lit("analysis_error")),
        "agent_performance": F.lit("unknown"),
    }
    for name, default in missing.items():
        value[name] = F.coalesce(value[name], default)
    readable = F.col("reply").isNotNull()
    return read.select(
        "conversation_id",
        *[F.when(readable, value[name]).otherwise(failure[name]).alias(name) for name in RECORD_COLUMNS],
    )


def merge_replies(assessed: DataFrame, parsed: DataFrame) -> DataFrame:
    """Assessment with the model's tags, summary, issues and agent rating where a reply was asked for and came.

    Everything else stays with the rules and classifiers. A reply that could not be read still overrides the tags;
    only a missing reply leaves the record as it is. Of several replies for a conversation one counts: a readable one
    if there is one, of these the smallest in the order of the four fields.
    """
    taken = ["tags", "resolution_summary", "key_issues", "agent_performance"]
    answered = F.col("needs_llm") & F.col("answer").isNotNull()
    otherwise = {
        "tags": F.col("tags"),
        "resolution_summary": F.col("resolution_summary"),
        "key_issues": F.array().cast("array<string>"),
        "agent_performance": F.lit("fair"),
    }
    merged = {
        name: F.when(answered, F.coalesce(F.col("answer")[name], otherwise[name])).otherwise(F.col(name))
        for name in taken
    }
    failed = F.array_contains("tags", "gemini_analysis_failed")
    answers = one_reply(parsed.select("conversation_id", *taken), failed).select(
        "conversation_id", F.struct(*taken).alias("answer")
    )
    return assessed.join(answers, "conversation_id", "left").withColumns(merged).drop("answer")


def recommendation_requests(context: DataFrame) -> DataFrame:
    """A prompt for each row of context with history."""
    shown = {
        "Customer": F.col("customer_id"),
        "Conversation": F.col("conversation_id").cast("string"),
        "Nature of request": F.col("nature_of_request"),
        "Sentiment": F.col("customer_sentiment"),
        "Urgency": F.col("urgency_level"),
        "Conversation type": F.col("conversation_type"),
        "Behavior": F.col("customer_behavior"),
        "Cohorts": F.col("customer_cohorts"),
        "Tags": F.array_join("tags", ", "),
        "Latest message": F.col("latest_message"),
        "Messages": F.col("total_messages").cast("string"),
        "Last interaction": F.date_format("latest_interaction", "yyyy-MM-dd HH:mm:ss"),
    }
    facts = F.concat_ws(
        "\n", *[F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("none"))) for name, value in shown.items()]
    )
    history = F.replace("chat_history", F.lit(HISTORY_SEPARATOR), F.lit("\n---\n"))
    return context.select(
        "conversation_id",
        _render(RECOMMENDATION_INSTRUCTIONS, facts=facts, history=history).alias("prompt"),
    )


def read_recommendation_replies(replies: DataFrame) -> DataFrame:
    """Replies with their fields and ``reject_reason`` (null for usable ones); an unknown status becomes pending."""
    # What is read of a text is a row of one, past which no filter moves: a test of the reason would read it again for every
    # field it concerns.
    read = replies.select("conversation_id", F.explode(F.array(unfence(F.col("response_text")))).alias("text")).select(
        "conversation_id",
        F.inline(
            F.array(
                F.struct(
                    _fields(F.col("text"), _REPLY_FIELDS).alias("reply"), F.json_object_keys("text").alias("present")
                )
            )
        ),
    )
    reason = F.when(F.col("reply").isNull(), F.lit("malformed"))
    for name in _REPLY_FIELDS:
        reason = reason.when(~F.array_contains("present", name), F.lit(f"missing_{name}"))
    channel_ok = F.coalesce(F.col("reply.channel").isin(*CHANNELS), F.lit(False))
    reason = reason.when(~channel_ok, F.lit("bad_channel"))
    status = F.col("reply.issue_status")
    return read.select(
        "conversation_id",
        reason.alias("reject_reason"),
        *[F.col("reply")[name].alias(name) for name in _REPLY_FIELDS[:-1]],
        F.when(F.col("reply").isNotNull(), F.when(status.isin(*STATUSES), status).otherwise("pending_customer_reply"))
        .alias("issue_status"),
    )


def usable_replies(read: DataFrame) -> DataFrame:
    """One usable reply per conversation; of several, the smallest in the order of its fields."""
    return one_reply(read.where(F.col("reject_reason").isNull()).drop("reject_reason"))


def reply_rejects(read: DataFrame) -> DataFrame:
    return read.where(F.col("reject_reason").isNotNull())


def attach_context(recommendations: DataFrame, context: DataFrame) -> DataFrame:
    """Usable replies, one per conversation, with the customer and the chat history."""
    return one_reply(recommendations).join(
        context.select("customer_id", "conversation_id", "chat_history"), "conversation_id"
    )
