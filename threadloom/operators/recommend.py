"""Next best action: decide a channel, time and message, apply the channel limits, validate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Limits and texts that appear in the output.
CHANNELS = {
    "twitter_dm_reply": {"from_hour": 9, "to_hour": 20, "max_length": 500},
    "email_reply": {"from_hour": 9, "to_hour": 18, "max_length": 1000},
    "scheduling_phone_call": {"from_hour": 9, "to_hour": 17, "max_length": 500},
}
STATUSES = ["resolved", "pending_customer_reply"]
BUSINESS_START, BUSINESS_END = 9, 18
EMAIL_SIGNATURE = "\n\nBest regards,\nCustomer Support Team"
CALL_OFFER = " We'd like to schedule a quick call to resolve this personally."
CALL_TIME = " Please let us know your preferred time."
PHONE_REASON = ("Phone call recommended due to ", " urgency and ", " sentiment requiring immediate personal attention.")
MAIL_REASON = "Email selected for technical customer requiring detailed written solution and documentation."
REPLY_REASON = ("Twitter DM chosen for quick acknowledgment of ", " priority ", " issue.")
APOLOGY = ("Hi! We're sorry for the inconvenience. Let us help resolve your ", " issue.")
# End of fixed values.

REQUIRED = ["customer_id", "channel", "send_time", "message", "reasoning", "issue_status"]
_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$"
)


def moment(as_of: dt.datetime | str) -> Column:
    """The reference clock as a wall-clock literal."""
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def _hours(count) -> Column:
    return F.make_dt_interval(hours=F.lit(count) if isinstance(count, int) else count)


def _at_hour(day: Column, hour, seconds: Column | None = None) -> Column:
    hour = F.lit(hour) if isinstance(hour, int) else hour
    secs = F.lit(0) if seconds is None else seconds
    return F.to_date(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, F.lit(0), secs)


def iso_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def rule_recommendations(context: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """The deterministic decider: phone for urgent or upset customers, e-mail for technical ones, else a reply."""
    urgency, mood, nature = F.col("urgency_level"), F.col("customer_sentiment"), F.col("nature_of_request")
    personal = urgency.isin("high", "critical") | mood.isin("frustrated", "angry")
    written = (mood == "technical") | (F.col("customer_behavior") == "technical")

    def choose(phone: Column, mail: Column, reply: Column) -> Column:
        return F.when(personal, phone).when(written, mail).otherwise(reply)

    def filled(texts: tuple[str, ...], *values: Column) -> Column:
        return F.concat(F.lit(texts[0]), *[part for value, text in zip(values, texts[1:]) for part in (value, F.lit(text))])

    phone_reason = filled(PHONE_REASON, urgency, mood)
    mail_reason = F.lit(MAIL_REASON)
    reply_reason = filled(REPLY_REASON, urgency, nature)
    pending = F.lit("pending_customer_reply")
    return context.withColumns(
        {
            "channel": choose(*[F.lit(n) for n in ("scheduling_phone_call", "email_reply", "twitter_dm_reply")]),
            "send_time": iso_text(moment(as_of) + _hours(2)),
            "message": filled(APOLOGY, nature),
            "reasoning": choose(phone_reason, mail_reason, reply_reason),
            "issue_status": choose(pending, pending, F.lit("resolved")),
        }
    )


def _limit(name: str) -> Column:
    """A limit of the row's channel; null for an unknown channel."""
    chosen = F.lit(None).cast("int")
    for channel, limits in CHANNELS.items():
        chosen = F.when(F.col("channel") == channel, F.lit(limits[name])).otherwise(chosen)
    return chosen


def channel_limits(recommendations: DataFrame) -> DataFrame:
    return recommendations.withColumns({name: _limit(name) for name in ("max_length", "from_hour", "to_hour")})


def parse_iso(text: Column) -> Column:
    """Wall-clock time of ISO text; a zone suffix is read and ignored; null when it does not parse."""
    return F.when(text.rlike(_ISO), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz"))


def with_send_time(recommendations: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Send time within the channel's hours, or as soon as office hours allow when it is urgent.

    Clamping the hour keeps the seconds; e-mail on a weekend moves to Monday morning. Each step is a column of its
    own: written as one expression, the parsed time would be repeated dozens of times in the generated code.
    """
    now = moment(as_of)
    soon = (
        F.when(F.hour(now) < BUSINESS_START, _at_hour(now, BUSINESS_START))
        .when(F.hour(now) >= BUSINESS_END, _at_hour(now, BUSINESS_START) + _hours(24))
        .otherwise(now + _hours(1))
    )
    asked, opening, closing, chosen = F.col("_asked"), F.col("_opening"), F.col("_closing"), F.col("_chosen")
    clamped = (
        F.when(F.hour(asked) < opening, _at_hour(asked, opening, F.second(asked)))
        .when(F.hour(asked) >= closing, _at_hour(asked, closing - 1, F.second(asked)))
        .otherwise(asked)
    )
    monday = F.date_add(F.to_date(chosen), 7 - F.weekday(chosen))
    shifted = F.when(
        (F.col("channel") == "email_reply") & (F.weekday(chosen) >= 5),
        _at_hour(monday, BUSINESS_START, F.second(chosen)),
    ).otherwise(chosen)
    usable = asked.isNotNull() & opening.isNotNull()
    return (
        recommendations.withColumns(
            {
                "_asked": F.when(F.col("send_time").isNull(), now).otherwise(parse_iso(F.col("send_time"))),
                "_opening": _limit("from_hour"),
                "_closing": _limit("to_hour"),
            }
        )
        .withColumn("_chosen", F.when(F.col("urgency_level").isin("critical", "high"), soon).otherwise(clamped))
        .withColumn("_final", F.when(usable, shifted).otherwise(now + _hours(2)))
        .withColumn("send_time", iso_text(F.col("_final")))
        .drop("_asked", "_opening", "_closing", "_chosen", "_final")
    )


def with_message(recommendations: DataFrame, fit: bool = False) -> DataFrame:
    """The message cut to the channel's limit, with the channel's greeting and ending.

    The cut comes first, so greeting and ending can push a long message past the limit and validation then rejects
    it; ``fit`` leaves room for them instead.
    """
    channel, customer, limit, start = F.col("channel"), F.col("customer_id"), F.col("_limit"), F.col("_start")

    def begins(*openings: str) -> Column:
        return F.startswith(start, F.lit(openings[0])) | F.startswith(start, F.lit(openings[1]))

    def cut(room: Column) -> Column:
        body = F.col("message")
        shortened = F.concat(F.substring(body, F.lit(1), room - 3), F.lit("..."))
        return F.when(F.length(body) > room, shortened).otherwise(body)

    greeting = (
        F.when((channel == "twitter_dm_reply") & ~begins("Hi", "Hello"), F.concat(F.lit("Hi "), customer, F.lit(", ")))
        .when(
            (channel == "email_reply") & ~begins("Dear", "Hello"), F.concat(F.lit("Dear "), customer, F.lit(",\n\n"))
        )
        .otherwise(F.lit(""))
    )
    calls = F.contains(F.lower(start), F.lit("call"))
    ending = (
        F.when(channel == "email_reply", F.lit(EMAIL_SIGNATURE))
        .when((channel == "scheduling_phone_call") & calls, F.lit(CALL_TIME))
        .when(channel == "scheduling_phone_call", F.lit(CALL_OFFER + CALL_TIME))
        .otherwise(F.lit(""))
    )
    framed = (
        recommendations.withColumn("_limit", _limit("max_length"))
        .withColumn("_start", cut(limit))
        .withColumns({"_greeting": greeting, "_ending": ending})
    )
    if fit:
        framed = framed.withColumn("_start", cut(limit - F.length("_greeting") - F.length("_ending")))
    whole = F.coalesce(F.concat("_greeting", "_start", "_ending"), F.col("message"))
    return framed.withColumn("message", F.when(limit.isNull(), F.col("message")).otherwise(whole)).drop(
        "_limit", "_start", "_greeting", "_ending"
    )


def reject_reason() -> Column:
    """First rule a finished recommendation breaks; null when it is valid."""
    reason = F.when(F.lit(False), F.lit(""))
    for name in REQUIRED:
        reason = reason.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(f"missing_{name}"))
    return (
        reason.when(~F.col("channel").isin(*CHANNELS), F.lit("bad_channel"))
        .when(~F.col("issue_status").isin(*STATUSES), F.lit("bad_issue_status"))
        .when(parse_iso(F.col("send_time")).isNull(), F.lit("bad_send_time"))
        .when(F.length("message") > _limit("max_length"), F.lit("message_too_long"))
    )


def optimise(recommendations: DataFrame, as_of: dt.datetime | str, *, fit: bool = False) -> DataFrame:
    """Optimised recommendations with ``reject_reason`` (null for valid ones)."""
    improved = with_message(with_send_time(recommendations, as_of), fit)
    return improved.withColumn("reject_reason", reject_reason())


def accepted(optimised: DataFrame) -> DataFrame:
    return optimised.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(optimised: DataFrame) -> DataFrame:
    return optimised.where(F.col("reject_reason").isNotNull())


def decide(context: DataFrame, as_of: dt.datetime | str, replies: DataFrame | None = None, *, rules: bool = True):
    """One recommendation per conversation: the accepted model reply, else the rule-based one if ``rules``.

    Of several replies for a conversation the smallest in the order of its fields counts.
    """
    if replies is None:
        return rule_recommendations(context, as_of)
    fields = ["channel", "send_time", "message", "reasoning", "issue_status"]
    offered = replies.groupBy("conversation_id").agg(F.min(F.struct(*fields)).alias("reply"))
    if not rules:
        joined = context.join(offered, "conversation_id")
        return joined.select(*context.columns, "reply.*")
    joined = rule_recommendations(context, as_of).join(offered, "conversation_id", "left")
    chosen = {
        name: F.when(F.col("reply").isNotNull(), F.col("reply")[name]).otherwise(F.col(name)) for name in fields
    }
    return joined.withColumns(chosen).drop("reply")


def export_history(history: Column) -> Column:
    """Chat history as one line of readable text."""
    readable = F.replace(history, F.lit(" ### "), F.lit(" | "))
    return F.replace(F.replace(readable, F.lit("\n"), F.lit(" | ")), F.lit("\r"), F.lit(""))


def channel_distribution(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("channel").agg(F.count("*").alias("recommendations"))


def recommendation_sample(recommendations: DataFrame, rows: int = 3) -> DataFrame:
    """The first recommendations with shortened texts."""
    return (
        recommendations.orderBy("conversation_id")
        .limit(rows)
        .select(
            "conversation_id",
            "customer_id",
            "channel",
            "send_time",
            F.concat(F.substring("message", 1, 100), F.lit("...")).alias("message"),
            F.concat(F.substring("reasoning", 1, 150), F.lit("...")).alias("reasoning"),
        )
    )
