"""The registered queries: one Spark query per operator, with its reference SQL where SQL can express it."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from checks.sql import AS_OF, clean_id, clean_text, clock, logistic, naive_bayes, optimised, turns, upto, valences
from threadloom.functions import sentiment, text
from threadloom.operators import (
    analysis,
    classifiers,
    cleaning,
    cohorts,
    context,
    model_exchange,
    recommend,
    scale,
    stats,
    threads,
    transcripts,
)
from threadloom.plans import jobs, stages
from threadloom.schemas import GROUPED_COLUMNS, RECOMMENDATION_COLUMNS, RECORD_COLUMNS
from threadloom.session import ensure_checkpoint_dir
from threadloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(function(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def flat(df: DataFrame) -> DataFrame:
    """Comparable columns: whole numbers as BIGINT, fractions to six decimals, times and lists as text."""
    shown = []
    for name, kind in df.dtypes:
        column: Column = F.col(name)
        if kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind == "double":
            column = F.round(column, 6)
        elif kind.startswith("timestamp"):
            column = text.clock_text(column)
        elif kind.startswith("array"):
            column = F.array_join(column.cast("array<string>"), ",")
        shown.append(column.alias(name))
    return df.select(*shown)


class Staged:
    """Stage tables of one scale factor, each computed once per Spark application and kept as a checkpoint."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @functools.cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_messages(self.spark, self.sf_dir)

    @functools.cached_property
    def messages(self) -> DataFrame:
        return scale.checkpointed(cleaning.clean_messages(self.raw))[0]

    @functools.cached_property
    def roots(self) -> DataFrame:
        return scale.checkpointed(threads.thread_roots(self.messages))[0]

    @functools.cached_property
    def conversations(self) -> DataFrame:
        return threads.conversation_ids(threads.thread_sizes(self.roots))

    @functools.cached_property
    def grouped(self) -> DataFrame:
        return scale.checkpointed(threads.group_messages(self.messages))[0]

    @functools.cached_property
    def assessed(self) -> DataFrame:
        return scale.checkpointed(analysis.analyse(self.grouped))[0]

    @functools.cached_property
    def cohort_tables(self) -> tuple[DataFrame, DataFrame]:
        made, members = cohorts.build_cohorts(self.assessed)
        return scale.checkpointed(made)[0], scale.checkpointed(members)[0]

    @functools.cached_property
    def context(self) -> DataFrame:
        return scale.checkpointed(context.customer_context(self.assessed, self.grouped, *self.cohort_tables))[0]

    @functools.cached_property
    def turns(self) -> DataFrame:
        """The ``conversations`` table as grouped messages."""
        return self.spark.read.parquet(f"{self.sf_dir}/conversations.parquet").select(
            F.col("conv_id").alias("conversation_id"),
            F.concat_ws("-", "conv_id", "turn").alias("tweet_id"),
            F.col("role").alias("author_id"),
            (F.col("role") == "user").alias("is_customer"),
            text.clean_text(F.col("text")).alias("message_text"),
            F.timestamp_add("MINUTE", F.col("turn").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias(
                "created_at"
            ),
            F.col("turn").cast("int").alias("sequence_number"),
        )


_STAGED: dict[tuple[str, str], Staged] = {}


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        _STAGED[key] = Staged(spark, sf_dir)
    return _STAGED[key]


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RECORD_SQL = """conversation_id, is_resolved, round(resolution_confidence, 6) AS resolution_confidence,
    array_to_string(tags, ',') AS tags, nature_of_request, customer_sentiment, urgency_level, conversation_type,
    customer_behavior, resolution_summary, array_to_string(key_issues, ',') AS key_issues, agent_performance"""
MESSAGE_SQL = f"""tweet_id, author_id, inbound, {clock('created_at')} AS created_at, text, response_tweet_id,
    in_response_to_tweet_id"""
GROUPED_SQL = f"""conversation_id, tweet_id, author_id, is_customer, message_text, {clock('created_at')} AS created_at,
    response_tweet_id, in_response_to_tweet_id, sequence_number"""
STATS_SQL = f"""conversation_id, count(*) AS message_count, {clock('min(created_at)')} AS start_time,
    {clock('max(created_at)')} AS end_time, count(DISTINCT author_id) AS participants"""

# Sources and sinks


@query("s1_csv_scan", upto("raw", f"SELECT {MESSAGE_SQL} FROM raw"))
def s1_csv_scan(spark, sf_dir):
    path = scratch(spark, "feed")
    staged(spark, sf_dir).raw.write.option("header", True).option("escape", '"').csv(path)
    scanned = files.read_messages_csv(spark, path)
    return scanned.withColumn("created_at", text.parse_time(F.col("created_at")))


@query("s2_raw_sink", upto("clean", f"SELECT {MESSAGE_SQL}, true AS loaded FROM clean"))
def s2_raw_sink(spark, sf_dir):
    stored = files.store_messages(staged(spark, sf_dir).messages, scratch(spark, "tables"))
    return stored.withColumn("loaded", F.col("created_timestamp").isNotNull()).drop("created_timestamp")


@query("s3_grouped_sink", upto("grouped", f"SELECT {GROUPED_SQL} FROM grouped"))
def s3_grouped_sink(spark, sf_dir):
    return files.store_grouped(staged(spark, sf_dir).grouped, scratch(spark, "tables"))


@query(
    "s4_analysis_upsert",
    upto(
        "assessed",
        """SELECT conversation_id, CASE WHEN conversation_id % 3 = 0 THEN false ELSE is_resolved END AS is_resolved,
    CASE WHEN conversation_id % 3 = 0 THEN 0.0 ELSE round(resolution_confidence, 6) END AS resolution_confidence,
    CASE WHEN conversation_id % 3 = 0 THEN '' ELSE array_to_string(tags, ',') END AS tags,
    CASE WHEN conversation_id % 3 = 0 THEN '' ELSE nature_of_request END AS nature_of_request,
    urgency_level, 'hybrid' AS analysis_method FROM assessed""",
    ),
)
def s4_analysis_upsert(spark, sf_dir):
    stage, folder = staged(spark, sf_dir), scratch(spark, "tables")
    files.write_table(analysis.records(stage.assessed), folder, files.ANALYSIS)
    missing = {name: F.lit(None) for name in ("is_resolved", "resolution_confidence", "tags", "nature_of_request")}
    kinds = dict(stage.assessed.dtypes)
    partial = stage.assessed.where(F.col("conversation_id") % 3 == 0).withColumns(
        {name: value.cast(kinds[name]) for name, value in missing.items()}
    )
    return files.upsert_analysis(analysis.with_defaults(partial), folder).select(
        "conversation_id", *missing, "urgency_level", "analysis_method"
    )


@query("s5_full_refresh", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def s5_full_refresh(spark, sf_dir):
    stage, folder = staged(spark, sf_dir), scratch(spark, "tables")
    rows = analysis.records(stage.assessed)
    files.write_table(rows, folder, files.ANALYSIS)
    made, members = stage.cohort_tables
    names = [rows, made, members]
    schemas = [", ".join(f"{name} {kind}" for name, kind in each.dtypes) for each in names]
    files.clear_analysis(spark, folder, *schemas)
    emptied = files.read_table(spark, folder, files.ANALYSIS)
    return emptied.unionByName(files.write_table(rows, folder, "again")).select("conversation_id", *RECORD_COLUMNS)


@query(
    "s6_cohort_sink",
    upto("members", "SELECT cohort_name, conversation_id FROM members JOIN cohorts USING (cohort_id)"),
)
def s6_cohort_sink(spark, sf_dir):
    made, members = files.store_cohorts(*staged(spark, sf_dir).cohort_tables, scratch(spark, "tables"))
    return members.join(F.broadcast(made), "cohort_id").select("cohort_name", "conversation_id")


EXPORT_SQL = """SELECT customer_id, conversation_id, channel, send_time, message, reasoning, issue_status,
    replace(replace(replace(chat_history, ' ### ', ' | '), chr(10), ' | '), chr(13), '') AS chat_history"""


@query("s7_recommendation_csv", upto("ruled", f"{EXPORT_SQL} FROM ruled"))
def s7_recommendation_csv(spark, sf_dir):
    stage, path = staged(spark, sf_dir), scratch(spark, "export")
    chosen = recommend.rule_recommendations(stage.context, AS_OF)
    files.write_recommendations_csv(context.with_history(chosen, stage.grouped), path)
    return files.read_recommendations_csv(spark, path)


@query(
    "s8_table_scan",
    upto("assessed", "SELECT conversation_id, customer_sentiment, urgency_level FROM assessed WHERE NOT is_resolved"),
)
def s8_table_scan(spark, sf_dir):
    stored = files.write_table(analysis.records(staged(spark, sf_dir).assessed), scratch(spark, "tables"), files.ANALYSIS)
    return stored.where(~F.col("is_resolved")).select("conversation_id", "customer_sentiment", "urgency_level")


# Cleaning

_DOCUMENT_MESSAGES_SQL = """SELECT CAST(doc_id AS VARCHAR) || '.0' AS tweet_id, source AS author_id, quality, text, lang
    FROM documents LEFT JOIN labels USING (doc_id)"""


def document_messages(spark, sf_dir):
    """Documents in raw message form: ids with a decimal point, flags and texts missing in places."""
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.concat(F.col("doc_id").cast("string"), F.lit(".0")).alias("tweet_id"),
            F.col("source").alias("author_id"),
            F.when(F.col("quality") == 0, "False").when(F.col("quality") == 1, "True").alias("inbound"),
            F.lit("Tue Oct 31 22:10:47 +0000 2017").alias("created_at"),
            F.when(F.col("lang") != "fr", F.col("text")).alias("text"),
            F.concat_ws(",", F.col("doc_id"), F.col("doc_id") + 1).alias("response_tweet_id"),
            F.concat(F.col("doc_id").cast("string"), F.lit("e1")).alias("in_response_to_tweet_id"),
        )
    )


@query(
    "c1_normalise_types",
    f"""SELECT {clean_id('tweet_id')} AS tweet_id, author_id, coalesce(quality = 1, true) AS inbound,
    '2017-10-31 22:10:47' AS created_at, coalesce(CASE WHEN lang <> 'fr' THEN text END, '') AS text,
    {clean_id('tweet_id')} || ',' || CAST(CAST({clean_id('tweet_id')} AS BIGINT) + 1 AS VARCHAR) AS response_tweet_id,
    CAST(CAST({clean_id('tweet_id')} AS BIGINT) * 10 AS VARCHAR) AS in_response_to_tweet_id
    FROM ({_DOCUMENT_MESSAGES_SQL})""",
)
def c1_normalise_types(spark, sf_dir):
    return cleaning.normalise_types(document_messages(spark, sf_dir))


@query(
    "c2_clean_ids",
    "SELECT event_id, " + clean_id("shown") + """ AS cleaned FROM (SELECT event_id, CASE event_id % 9
    WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN CAST(event_id AS VARCHAR) || '.0'
    WHEN 2 THEN '  ' || CAST(event_id AS VARCHAR) || ' ' WHEN 3 THEN CAST(event_id AS VARCHAR) || ',7'
    WHEN 4 THEN CAST(event_id AS VARCHAR) || 'e2' WHEN 5 THEN 'nan' WHEN 6 THEN '-' || CAST(event_id AS VARCHAR) || '.9'
    WHEN 7 THEN CAST(event_id AS VARCHAR) || 'f' END AS shown FROM events)""",
)
def c2_clean_ids(spark, sf_dir):
    number = F.col("event_id").cast("string")
    shown = (
        F.when(F.col("event_id") % 9 == 0, number)
        .when(F.col("event_id") % 9 == 1, F.concat(number, F.lit(".0")))
        .when(F.col("event_id") % 9 == 2, F.concat(F.lit("  "), number, F.lit(" ")))
        .when(F.col("event_id") % 9 == 3, F.concat(number, F.lit(",7")))
        .when(F.col("event_id") % 9 == 4, F.concat(number, F.lit("e2")))
        .when(F.col("event_id") % 9 == 5, F.lit("nan"))
        .when(F.col("event_id") % 9 == 6, F.concat(F.lit("-"), number, F.lit(".9")))
        .when(F.col("event_id") % 9 == 7, F.concat(number, F.lit("f")))
    )
    return table(spark, sf_dir, "events").select("event_id", text.clean_id(shown).alias("cleaned"))


@query("c3_clean_text", f"SELECT doc_id, {clean_text('text')} AS cleaned FROM documents")
def c3_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("c3_clean_page_text", f"SELECT page_id, {clean_text('html')} AS cleaned FROM pages")
def c3_clean_page_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_text(F.col("html")).alias("cleaned"))


@query(
    "c4_null_text",
    f"SELECT {clean_id('tweet_id')} AS tweet_id, coalesce(CASE WHEN lang <> 'fr' THEN text END, '') AS text"
    f" FROM ({_DOCUMENT_MESSAGES_SQL})",
)
def c4_null_text(spark, sf_dir):
    return cleaning.normalise_types(document_messages(spark, sf_dir)).select("tweet_id", "text")


@query(
    "c5_drop_duplicates",
    upto(
        "raw",
        f"""SELECT {MESSAGE_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY created_at, author_id,
    inbound, text) AS place FROM (SELECT tweet_id, author_id, inbound = 'True' AS inbound, created_at, text,
    '' AS response_tweet_id, {clean_id('in_response_to_tweet_id')} AS in_response_to_tweet_id FROM raw UNION ALL
    SELECT tweet_id, author_id, inbound = 'True', created_at + INTERVAL 1 HOUR, 'again: ' || text, '',
    {clean_id('in_response_to_tweet_id')} FROM raw)) WHERE place = 1""",
    ),
)
def c5_drop_duplicates(spark, sf_dir):
    once = cleaning.normalise_types(staged(spark, sf_dir).raw)
    again = once.withColumns(
        {"created_at": F.timestamp_add("HOUR", F.lit(1), "created_at"), "text": F.concat(F.lit("again: "), "text")}
    )
    return cleaning.drop_duplicates(again.unionByName(once))


@query("c6_drop_empty", upto("raw", f"SELECT tweet_id FROM raw WHERE length({clean_text('text')}) > 0"))
def c6_drop_empty(spark, sf_dir):
    typed = cleaning.normalise_types(staged(spark, sf_dir).raw)
    return cleaning.drop_empty(cleaning.clean_texts(typed)).select("tweet_id")


@query("c7_time_order", upto("clean", f"SELECT tweet_id, {clock('created_at')} AS created_at FROM clean ORDER BY created_at"))
def c7_time_order(spark, sf_dir):
    return cleaning.in_time_order(staged(spark, sf_dir).messages).select("tweet_id", "created_at")


@query(
    "c8_cleaning_report",
    upto(
        "clean",
        """SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS clean_rows,
    count(*) FILTER (WHERE in_response_to_tweet_id <> '') AS messages_with_parent,
    count(DISTINCT CASE WHEN in_response_to_tweet_id <> '' THEN in_response_to_tweet_id END) AS parents_referenced,
    (SELECT count(*) FROM raw) - count(*) AS removed_rows FROM clean""",
    ),
)
def c8_cleaning_report(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return cleaning.cleaning_report(stage.raw, stage.messages)


@query(
    "c8_link_sample",
    upto(
        "clean",
        """SELECT tweet_id, in_response_to_tweet_id FROM clean WHERE in_response_to_tweet_id <> ''
    ORDER BY created_at, tweet_id LIMIT 5""",
    ),
)
def c8_link_sample(spark, sf_dir):
    return cleaning.link_sample(staged(spark, sf_dir).messages)


@query("c9_clean_messages", upto("clean", f"SELECT {MESSAGE_SQL} FROM clean"))
def c9_clean_messages(spark, sf_dir):
    return cleaning.clean_messages(staged(spark, sf_dir).raw)


@query("c10_unresolved", upto("assessed", "SELECT conversation_id, urgency_level FROM assessed WHERE NOT is_resolved"))
def c10_unresolved(spark, sf_dir):
    return analysis.unresolved(staged(spark, sf_dir).assessed).select("conversation_id", "urgency_level")


@query(
    "c11_replies",
    upto("clean", "SELECT tweet_id, in_response_to_tweet_id FROM clean WHERE in_response_to_tweet_id <> ''"),
)
def c11_replies(spark, sf_dir):
    return cleaning.replies(staged(spark, sf_dir).messages).select("tweet_id", "in_response_to_tweet_id")


@query(
    "c11_orphans",
    upto(
        "clean",
        """SELECT tweet_id, in_response_to_tweet_id FROM clean c WHERE in_response_to_tweet_id <> ''
    AND NOT EXISTS (SELECT 1 FROM clean p WHERE p.tweet_id = c.in_response_to_tweet_id)""",
    ),
)
def c11_orphans(spark, sf_dir):
    return threads.orphans(staged(spark, sf_dir).messages).select("tweet_id", "in_response_to_tweet_id")


@query(
    "c12_role_labels",
    upto("grouped", "SELECT tweet_id, CASE WHEN is_customer THEN 'CUSTOMER: ' ELSE 'AGENT: ' END AS role FROM grouped"),
)
def c12_role_labels(spark, sf_dir):
    return staged(spark, sf_dir).grouped.select("tweet_id", transcripts.role_label().alias("role"))


# Threads


@query("r1_thread_roots", upto("reach", "SELECT tweet_id, root_id FROM reach"))
def r1_thread_roots(spark, sf_dir):
    return threads.thread_roots(staged(spark, sf_dir).messages).select("tweet_id", "root_id")


@query(
    "r2_threads",
    upto(
        "reach",
        f"SELECT root_id, count(*) AS size, {clock('min(created_at)')} AS started_at FROM reach GROUP BY root_id",
    ),
)
def r2_threads(spark, sf_dir):
    return threads.thread_sizes(staged(spark, sf_dir).roots)


@query(
    "r3_conversation_records",
    upto(
        "grouped",
        """SELECT conversation_id, count(*) AS messages, string_agg(tweet_id, ',' ORDER BY sequence_number) AS ids,
    string_agg(message_text, '/' ORDER BY sequence_number) AS texts FROM grouped GROUP BY conversation_id""",
    ),
)
def r3_conversation_records(spark, sf_dir):
    nested = threads.nested_conversations(staged(spark, sf_dir).grouped)
    return nested.select(
        "conversation_id",
        F.size("messages").alias("messages"),
        F.array_join("messages.tweet_id", ",").alias("ids"),
        F.array_join("messages.message_text", "/").alias("texts"),
    )


@query("r4_multi_message_threads", upto("numbered", "SELECT root_id, size FROM numbered"))
def r4_multi_message_threads(spark, sf_dir):
    return threads.thread_sizes(staged(spark, sf_dir).roots).where(F.col("size") > 1).select("root_id", "size")


@query(
    "r5_conversation_ids",
    upto("numbered", f"SELECT root_id, conversation_id, size, {clock('started_at')} AS started_at FROM numbered"),
)
def r5_conversation_ids(spark, sf_dir):
    return threads.conversation_ids(threads.thread_sizes(staged(spark, sf_dir).roots))


@query("r6_sequence_numbers", upto("grouped", "SELECT tweet_id, conversation_id, sequence_number FROM grouped"))
def r6_sequence_numbers(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return threads.sequence_numbers(stage.roots, stage.conversations)


@query("r1_roots_with_popular_parents", upto("reach", "SELECT tweet_id, root_id FROM reach"))
def r1_roots_with_popular_parents(spark, sf_dir):
    """The same threads when every message with two replies counts as popular."""
    return threads.thread_roots(staged(spark, sf_dir).messages, hot_rows=1).select("tweet_id", "root_id")


@query("r6_positions_across_ranges", upto("grouped", "SELECT tweet_id, conversation_id, sequence_number FROM grouped"))
def r6_positions_across_ranges(spark, sf_dir):
    """The same positions when every conversation of five or more messages is ranked across range partitions."""
    stage = staged(spark, sf_dir)
    return threads.sequence_numbers(stage.roots, stage.conversations, hot_rows=4)


@query("r6_grouped_messages", upto("grouped", f"SELECT {GROUPED_SQL} FROM grouped"))
def r6_grouped_messages(spark, sf_dir):
    return threads.group_messages(staged(spark, sf_dir).messages).select(*GROUPED_COLUMNS)


# Joins


@query(
    "j1_analysed_messages",
    upto(
        "assessed",
        """SELECT tweet_id, conversation_id, nature_of_request, customer_sentiment, urgency_level
    FROM grouped JOIN assessed USING (conversation_id)""",
    ),
)
def j1_analysed_messages(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return context.analysed_messages(stage.assessed, stage.grouped).select(
        "tweet_id", "conversation_id", "nature_of_request", "customer_sentiment", "urgency_level"
    )


@query(
    "j2_cohort_names",
    upto(
        "members",
        """SELECT a.conversation_id, string_agg(cohort_name, '; ' ORDER BY cohort_id) AS customer_cohorts,
    count(cohort_id) AS cohort_count FROM assessed a LEFT JOIN members m USING (conversation_id)
    LEFT JOIN cohorts USING (cohort_id) WHERE NOT is_resolved GROUP BY a.conversation_id""",
    ),
)
def j2_cohort_names(spark, sf_dir):
    return staged(spark, sf_dir).context.select("conversation_id", "customer_cohorts", "cohort_count")


@query(
    "j3_messages_of_selection",
    upto(
        "grouped",
        f"""SELECT {GROUPED_SQL} FROM grouped WHERE conversation_id IN (SELECT conversation_id FROM grouped
    GROUP BY conversation_id ORDER BY count(*) DESC, conversation_id LIMIT 25)""",
    ),
)
def j3_messages_of_selection(spark, sf_dir):
    grouped = staged(spark, sf_dir).grouped
    return stats.messages_of(grouped, F.broadcast(stats.select_conversations(grouped, 25, "size")))


COHORT_SUMMARY_SQL = """SELECT c.cohort_id, cohort_name, conversation_count, count(m.conversation_id) AS actual_count
    FROM cohorts c LEFT JOIN members m ON m.cohort_id = c.cohort_id GROUP BY ALL"""


@query("j4_cohort_summary", upto("members", COHORT_SUMMARY_SQL))
def j4_cohort_summary(spark, sf_dir):
    made, members = staged(spark, sf_dir).cohort_tables
    return cohorts.cohort_summary(made, members).select(
        "cohort_id", "cohort_name", "conversation_count", "actual_count"
    )


SAMPLE_SQL = """SELECT cohort_id, conversation_id, customer_sentiment, nature_of_request FROM (SELECT *,
    row_number() OVER (PARTITION BY cohort_id ORDER BY conversation_id) AS place FROM members)
    JOIN assessed USING (conversation_id) WHERE place <= 3"""


@query("j5_cohort_samples", upto("members", SAMPLE_SQL))
def j5_cohort_samples(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return cohorts.cohort_samples(stage.assessed, stage.cohort_tables[1])


@query(
    "j6_parent_lookup",
    upto(
        "clean",
        f"""SELECT c.tweet_id, c.in_response_to_tweet_id, p.author_id AS parent_author_id,
    {clock('p.created_at')} AS parent_created_at FROM clean c LEFT JOIN clean p ON p.tweet_id = c.in_response_to_tweet_id
    WHERE c.in_response_to_tweet_id <> ''""",
    ),
)
def j6_parent_lookup(spark, sf_dir):
    return threads.parents(staged(spark, sf_dir).messages).select(
        "tweet_id", "in_response_to_tweet_id", "parent_author_id", "parent_created_at"
    )


@query(
    "j6_popular_parents",
    upto(
        "clean",
        """SELECT c.tweet_id, p.author_id AS parent_author_id FROM clean c
    LEFT JOIN clean p ON p.tweet_id = c.in_response_to_tweet_id WHERE c.in_response_to_tweet_id <> ''""",
    ),
)
def j6_popular_parents(spark, sf_dir):
    """The same lookup when every parent with two replies is answered by the broadcast."""
    return threads.parents(staged(spark, sf_dir).messages, hot_rows=1).select("tweet_id", "parent_author_id")


# Aggregations

TRANSCRIPT_SQL = f"""SELECT conversation_id, full_conversation, message_count, {clock('start_time')} AS start_time,
    {clock('end_time')} AS end_time FROM transcripts"""


@query("a1_transcripts", upto("transcripts", TRANSCRIPT_SQL))
def a1_transcripts(spark, sf_dir):
    return transcripts.transcripts(staged(spark, sf_dir).grouped)


@query(
    "a1_transcripts_in_parts",
    upto(
        "grouped",
        f"""SELECT conversation_id, sequence_number // 2 AS part, string_agg(CASE WHEN is_customer THEN 'CUSTOMER: '
        ELSE 'AGENT: ' END || author_id || ': ' || message_text, ' | ' ORDER BY sequence_number) AS full_conversation,
    count(*) AS message_count, {clock('min(created_at)')} AS start_time, {clock('max(created_at)')} AS end_time
    FROM grouped GROUP BY conversation_id, sequence_number // 2""",
    ),
)
def a1_transcripts_in_parts(spark, sf_dir):
    return transcripts.transcript_parts(staged(spark, sf_dir).grouped, 2)


@query("a1_turn_transcripts", turns("transcripts", TRANSCRIPT_SQL))
def a1_turn_transcripts(spark, sf_dir):
    return transcripts.transcripts(staged(spark, sf_dir).turns)


@query("a2_conversation_stats", upto("grouped", f"SELECT {STATS_SQL} FROM grouped GROUP BY conversation_id"))
def a2_conversation_stats(spark, sf_dir):
    return stats.conversation_stats(staged(spark, sf_dir).grouped)


HISTOGRAM_SQL = """SELECT messages, count(*) AS conversations FROM (SELECT conversation_id, count(*) AS messages
    FROM grouped GROUP BY conversation_id) GROUP BY messages ORDER BY messages"""


@query("a3_size_histogram", upto("grouped", HISTOGRAM_SQL))
def a3_size_histogram(spark, sf_dir):
    return stats.size_histogram(staged(spark, sf_dir).grouped)


@query(
    "a4_basic_stats",
    upto(
        "grouped",
        """SELECT (SELECT count(*) FROM clean) AS total_tweets, count(DISTINCT conversation_id) AS total_conversations,
    count(*) FILTER (WHERE is_customer) AS customer_messages, count(*) FILTER (WHERE NOT is_customer) AS agent_messages,
    round(CAST(count(*) AS DOUBLE) / count(DISTINCT conversation_id), 2) AS avg_messages_per_conversation FROM grouped""",
    ),
)
def a4_basic_stats(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return stats.basic_stats(stage.messages, stage.grouped)


COUNTS_SQL = """SELECT count(*) AS total_analyzed, count(*) FILTER (WHERE is_resolved) AS resolved_count,
    count(*) FILTER (WHERE NOT is_resolved) AS open_count FROM assessed"""


@query("a5_resolution_counts", upto("assessed", COUNTS_SQL))
def a5_resolution_counts(spark, sf_dir):
    return analysis.resolution_counts(staged(spark, sf_dir).assessed)


@query("a6_unique_tags", upto("assessed", "SELECT DISTINCT unnest(tags) AS tag FROM assessed"))
def a6_unique_tags(spark, sf_dir):
    return analysis.unique_tags(staged(spark, sf_dir).assessed)


@query(
    "a6_tags_from_json",
    upto("assessed", "SELECT DISTINCT unnest(tags) AS tag FROM assessed WHERE conversation_id % 5 <> 0"),
)
def a6_tags_from_json(spark, sf_dir):
    broken = F.when(F.col("conversation_id") % 5 == 0, F.lit('["cut off')).otherwise(F.to_json("tags"))
    return analysis.tags_from_json(staged(spark, sf_dir).assessed.select(broken.alias("tags")))


@query(
    "a7_tag_counts",
    upto("assessed", "SELECT tag, count(*) AS uses FROM (SELECT unnest(tags) AS tag FROM assessed) GROUP BY tag"),
)
def a7_tag_counts(spark, sf_dir):
    return analysis.tag_counts(staged(spark, sf_dir).assessed)


@query("a8_cohort_sizes", upto("cohorts", "SELECT cohort_name, conversation_count FROM cohorts"))
def a8_cohort_sizes(spark, sf_dir):
    return cohorts.build_cohorts(staged(spark, sf_dir).assessed)[0].select("cohort_name", "conversation_count")


CONTEXT_SQL = f"""SELECT conversation_id, is_resolved, array_to_string(tags, ',') AS tags, nature_of_request,
    customer_sentiment, urgency_level, conversation_type, customer_behavior, customer_id, latest_message,
    {clock('latest_interaction')} AS latest_interaction, customer_cohorts, total_messages, chat_history FROM context"""


@query("a9_customer_context", upto("context", CONTEXT_SQL))
def a9_customer_context(spark, sf_dir):
    stage = staged(spark, sf_dir)
    made = context.customer_context(stage.assessed, stage.grouped, *stage.cohort_tables)
    return context.with_history(made, stage.grouped).drop("cohort_count")


@query(
    "a9_context_fanout",
    upto(
        "members",
        f"""SELECT a.conversation_id, string_agg(cohort_name, '; ' ORDER BY sequence_number, cohort_id) AS customer_cohorts,
    count(DISTINCT tweet_id) AS total_messages, string_agg({clock('created_at')} || ' | ' || author_id || ': '
        || message_text, ' ### ' ORDER BY sequence_number) AS chat_history
    FROM assessed a JOIN grouped g USING (conversation_id) LEFT JOIN members m USING (conversation_id)
    LEFT JOIN cohorts c USING (cohort_id) WHERE NOT is_resolved GROUP BY a.conversation_id""",
    ),
)
def a9_context_fanout(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return context.with_history(stage.context, stage.grouped, fanout=True).select(
        "conversation_id", "customer_cohorts", "total_messages", "chat_history"
    )


CHANNELS_SQL = "SELECT channel, count(*) AS recommendations FROM ruled GROUP BY channel"


@query(
    "a9_history_in_blocks",
    upto("context", "SELECT conversation_id, chat_history FROM context"),
)
def a9_history_in_blocks(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return context.with_history(stage.context, stage.grouped, block_messages=2).select("conversation_id", "chat_history")


@query("a1_transcripts_in_blocks", upto("transcripts", TRANSCRIPT_SQL))
def a1_transcripts_in_blocks(spark, sf_dir):
    return transcripts.transcripts(staged(spark, sf_dir).grouped, block_messages=2)


@query("a10_channel_distribution", upto("ruled", CHANNELS_SQL))
def a10_channel_distribution(spark, sf_dir):
    return recommend.channel_distribution(recommend.rule_recommendations(staged(spark, sf_dir).context, AS_OF))


@query(
    "a11_conversation_overview",
    upto(
        "grouped",
        f"""SELECT {STATS_SQL} FROM grouped WHERE conversation_id IN (SELECT DISTINCT conversation_id FROM grouped
    ORDER BY conversation_id LIMIT 10) GROUP BY conversation_id""",
    ),
)
def a11_conversation_overview(spark, sf_dir):
    return stats.conversation_overview(staged(spark, sf_dir).grouped)


BEHAVIOUR_SQL = """SELECT count(*) AS total_analyzed, count(*) FILTER (WHERE is_resolved) AS resolved_count,
    count(*) FILTER (WHERE NOT is_resolved) AS open_count,
    (SELECT count(DISTINCT tag) FROM (SELECT unnest(tags) AS tag FROM assessed)) AS unique_tags,
    (SELECT count(*) FROM cohorts) AS cohorts_created FROM assessed"""
INGEST_SQL = """SELECT (SELECT count(*) FROM clean) AS records_processed,
    count(DISTINCT conversation_id) AS conversations_created FROM grouped"""


@query("a12_ingest_summary", upto("grouped", INGEST_SQL))
def a12_ingest_summary(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return stats.ingest_summary(stage.messages, stage.grouped)


@query("a12_behaviour_summary", upto("cohorts", BEHAVIOUR_SQL))
def a12_behaviour_summary(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return stages.behaviour_summary(stage.assessed, stage.cohort_tables[0])


@query("a12_action_summary", upto("ruled", "SELECT count(*) AS recommendations_generated FROM ruled"))
def a12_action_summary(spark, sf_dir):
    return stages.action_summary(recommend.rule_recommendations(staged(spark, sf_dir).context, AS_OF))


# Rankings and selections


@query(
    "w1_first_conversations",
    upto(
        "grouped",
        f"""SELECT {GROUPED_SQL} FROM grouped WHERE conversation_id IN (SELECT DISTINCT conversation_id FROM grouped
    ORDER BY conversation_id LIMIT 10)""",
    ),
)
def w1_first_conversations(spark, sf_dir):
    return stats.conversations_with_messages(staged(spark, sf_dir).grouped, 10, "row")


@query(
    "w2_largest_conversations",
    upto(
        "grouped",
        f"""SELECT {GROUPED_SQL} FROM grouped WHERE conversation_id IN (SELECT conversation_id FROM grouped
    GROUP BY conversation_id ORDER BY count(*) DESC, conversation_id LIMIT 10)""",
    ),
)
def w2_largest_conversations(spark, sf_dir):
    return stats.conversations_with_messages(staged(spark, sf_dir).grouped, 10, "size")


@query(
    "w3_unknown_order",
    upto(
        "grouped",
        f"""SELECT {GROUPED_SQL} FROM grouped WHERE conversation_id IN (SELECT DISTINCT conversation_id FROM grouped
    ORDER BY conversation_id LIMIT 7)""",
    ),
)
def w3_unknown_order(spark, sf_dir):
    return stats.conversations_with_messages(staged(spark, sf_dir).grouped, 7, "anything")


@query(
    "w4_size_report",
    upto(
        "grouped",
        """SELECT conversation_id, count(*) AS message_count, count(DISTINCT author_id) AS participants FROM grouped
    GROUP BY conversation_id ORDER BY message_count DESC, conversation_id LIMIT 10""",
    ),
)
def w4_size_report(spark, sf_dir):
    return stats.largest_conversations(staged(spark, sf_dir).grouped)


@query("w5_common_tags", upto("found", "SELECT tag, uses, position FROM top_tags WHERE uses >= 3"))
def w5_common_tags(spark, sf_dir):
    return cohorts.common_tags(staged(spark, sf_dir).assessed)


@query(
    "w6_sample_per_cohort",
    upto(
        "members",
        f"SELECT cohort_name, string_agg(conversation_id, ',' ORDER BY conversation_id) AS sample FROM ({SAMPLE_SQL})"
        " JOIN cohorts USING (cohort_id) GROUP BY cohort_name",
    ),
)
def w6_sample_per_cohort(spark, sf_dir):
    stage = staged(spark, sf_dir)
    report = cohorts.cohort_report(*stage.cohort_tables)
    return report.select("cohort_name", F.col("sample_conversations").alias("sample"))


@query(
    "w7_first_in_text_order",
    upto(
        "transcripts",
        TRANSCRIPT_SQL
        + " WHERE conversation_id IN (SELECT conversation_id FROM transcripts"
        + " ORDER BY CAST(conversation_id AS VARCHAR) LIMIT 100)",
    ),
)
def w7_first_in_text_order(spark, sf_dir):
    return transcripts.first_transcripts(staged(spark, sf_dir).grouped, 100, "text")


@query(
    "w8_analysis_details",
    upto(
        "assessed",
        """SELECT conversation_id, CASE WHEN is_resolved THEN 'resolved' ELSE 'open' END AS status,
    array_to_string(tags, ',') AS tags, nature_of_request, customer_sentiment, urgency_level, conversation_type,
    customer_behavior FROM assessed ORDER BY conversation_id""",
    ),
)
def w8_analysis_details(spark, sf_dir):
    return analysis.analysis_details(staged(spark, sf_dir).assessed)


@query(
    "w9_first_and_latest",
    upto(
        "grouped",
        f"""SELECT conversation_id, arg_min(author_id, sequence_number) FILTER (WHERE is_customer) AS customer_id,
    arg_max(message_text, sequence_number) AS latest_message, {clock('max(created_at)')} AS latest_interaction,
    count(*) AS total_messages FROM grouped GROUP BY conversation_id""",
    ),
)
def w9_first_and_latest(spark, sf_dir):
    return context.conversation_edges(staged(spark, sf_dir).grouped)


# Cohorts

COHORT_SQL = "SELECT cohort_id, cohort_name, cohort_description, cohort_criteria, conversation_count FROM cohorts"


@query("u1_all_cohorts", upto("cohorts", COHORT_SQL))
def u1_all_cohorts(spark, sf_dir):
    return cohorts.build_cohorts(staged(spark, sf_dir).assessed)[0]


@query(
    "k1_criteria",
    upto(
        "assessed",
        """SELECT conversation_id FROM assessed WHERE urgency_level IN ('high', 'critical') AND is_resolved = true
    AND conversation_type = 'follow_up'""",
    ),
)
def k1_criteria(spark, sf_dir):
    wanted = {"urgency_level": ["high", "critical"], "is_resolved": True, "conversation_type": "follow_up"}
    return cohorts.matching_conversations(staged(spark, sf_dir).assessed, wanted)


@query("k2_rule_cohorts", upto("found", "SELECT conversation_id, position FROM found WHERE kind = 0"))
def k2_rule_cohorts(spark, sf_dir):
    return cohorts.rule_members(staged(spark, sf_dir).assessed)


@query("k3_tag_cohorts", upto("found", "SELECT conversation_id, tag, position FROM found WHERE kind = 1"))
def k3_tag_cohorts(spark, sf_dir):
    return cohorts.tag_members(staged(spark, sf_dir).assessed)


@query("k4_cohort_members", upto("members", "SELECT conversation_id, cohort_id FROM members"))
def k4_cohort_members(spark, sf_dir):
    return cohorts.build_cohorts(staged(spark, sf_dir).assessed)[1]


@query(
    "k5_cohort_report",
    upto(
        "members",
        f"""SELECT s.*, sample_conversations FROM ({COHORT_SUMMARY_SQL}) s LEFT JOIN (SELECT cohort_id,
    string_agg(conversation_id, ',' ORDER BY conversation_id) AS sample_conversations FROM ({SAMPLE_SQL})
    GROUP BY cohort_id) USING (cohort_id)""",
    ),
)
def k5_cohort_report(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return cohorts.cohort_report(*stage.cohort_tables).select(
        "cohort_id", "cohort_name", "conversation_count", "actual_count", "sample_conversations"
    )


@query(
    "k6_analysis_report",
    upto(
        "cohorts",
        """SELECT 'status' AS section, CASE WHEN is_resolved THEN 'resolved' ELSE 'open' END AS name, count(*) AS size
    FROM assessed GROUP BY ALL UNION ALL SELECT 'cohort', cohort_name, conversation_count FROM cohorts
    UNION ALL SELECT 'tag', tag, uses FROM tag_uses""",
    ),
)
def k6_analysis_report(spark, sf_dir):
    stage = staged(spark, sf_dir)
    return cohorts.analysis_report(stage.assessed, stage.cohort_tables[0])


# Text analytics


def _assessed_fields(*names: str) -> Query:
    """The analysis restricted to one operator's columns; Spark prunes the features the others need."""
    return lambda spark, sf_dir: analysis.analyse(staged(spark, sf_dir).grouped).select("conversation_id", *names)


@query(
    "n1_customer_messages",
    upto("heard", "SELECT conversation_id, m AS customer_message FROM heard, unnest(customer_list) AS u(m)"),
)
def n1_customer_messages(spark, sf_dir):
    rows = transcripts.customer_messages(transcripts.lines(staged(spark, sf_dir).grouped))
    return rows.select("conversation_id", "customer_message")


for _name, _fields, _sql in [
    (
        "n2_resolution",
        ["is_resolved", "resolution_confidence", "resolved_score", "unresolved_score"],
        "is_resolved, round(resolution_confidence, 6) AS resolution_confidence,"
        " round(resolved_score, 6) AS resolved_score, unresolved_score",
    ),
    (
        "n3_urgency",
        ["urgency_level", "critical_score", "high_score", "medium_score", "low_score"],
        "urgency_level, urgency_critical AS critical_score, urgency_high AS high_score,"
        " urgency_medium AS medium_score, urgency_low AS low_score",
    ),
    (
        "n4_nature_rules",
        ["nature_of_request", "nature_confidence"],
        "nature_of_request, round(nature_confidence, 6) AS nature_confidence",
    ),
    (
        "n5_behaviour_rules",
        ["customer_behavior", "behavior_confidence"],
        "customer_behavior, round(behavior_confidence, 6) AS behavior_confidence",
    ),
    ("n8_sentiment_score", ["compound"], "compound"),
    (
        "n9_sentiment_bucket",
        ["customer_sentiment", "sentiment_confidence"],
        "customer_sentiment, round(sentiment_confidence, 6) AS sentiment_confidence",
    ),
    ("n10_tags", ["tags"], "array_to_string(tags, ',') AS tags"),
    ("n11_llm_routing", ["needs_llm"], "needs_llm"),
    ("n12_conversation_type", ["conversation_type", "piece_count"], "conversation_type, piece_count"),
    ("n13_resolution_summary", ["resolution_summary"], "resolution_summary"),
    ("n14_key_issues", ["key_issues"], "array_to_string(key_issues, ',') AS key_issues"),
    ("n15_agent_performance", ["agent_performance"], "agent_performance"),
]:
    query(_name, upto("assessed", f"SELECT conversation_id, {_sql} FROM assessed"))(_assessed_fields(*_fields))


@query(
    "n6_nature_classifier",
    naive_bayes(
        "SELECT conversation_id, nature_of_request, round(nature_confidence, 6) AS nature_confidence FROM predicted"
    ),
)
def n6_nature_classifier(spark, sf_dir):
    model = classifiers.fit_naive_bayes(classifiers.examples(spark, classifiers.NATURE_EXAMPLES))
    texts = classifiers.customer_texts(transcripts.lines(staged(spark, sf_dir).grouped))
    return classifiers.predict(texts, (model, "nature_of_request", "nature_confidence"))


# An iterative fit: the two solvers agree to about 1e-7, so the confidence is shown to five decimals.
@query(
    "n7_behaviour_classifier",
    logistic(
        "SELECT conversation_id, customer_behavior, round(behavior_confidence, 5) AS behavior_confidence FROM predicted"
    ),
)
def n7_behaviour_classifier(spark, sf_dir):
    model = classifiers.fit_logistic(classifiers.examples(spark, classifiers.BEHAVIOUR_EXAMPLES))
    texts = classifiers.customer_texts(transcripts.lines(staged(spark, sf_dir).grouped))
    predicted = classifiers.predict(texts, (model, "customer_behavior", "behavior_confidence"))
    return predicted.withColumn("behavior_confidence", F.round("behavior_confidence", 5))


@query(
    "n8_turn_valence",
    turns(
        "valence",
        """SELECT conversation_id, round(sum(coalesce(valence, 0)), 4) AS valence FROM (SELECT DISTINCT conversation_id
    FROM turns) LEFT JOIN valued USING (conversation_id) GROUP BY conversation_id""",
    ),
)
def n8_turn_valence(spark, sf_dir):
    customer = F.when(F.col("is_customer"), F.col("message_text"))
    turns = staged(spark, sf_dir).turns.withColumn("customer", customer)
    return (
        sentiment.with_valence(turns, "customer")
        .groupBy("conversation_id")
        .agg(F.round(F.sum("valence"), 4).alias("valence"))
    )


# N8 with emphasis of every kind; which kind a message has is told by its place.
@query(
    "n8_emphasis",
    upto(
        "grouped",
        """SELECT conversation_id, round(sum(coalesce(valence, 0)), 4) AS valence FROM (SELECT DISTINCT conversation_id
    FROM grouped) LEFT JOIN valued USING (conversation_id) GROUP BY conversation_id""",
        """loud AS (SELECT conversation_id, sequence_number, is_customer,
    CASE (conversation_id + sequence_number) % 6 WHEN 0 THEN upper(message_text)
        WHEN 1 THEN message_text || ' but ' || upper(message_text) WHEN 2 THEN message_text || ' not VERY good!!!!!'
        WHEN 3 THEN 'Yeah right :( so Bad?? ' || message_text WHEN 4 THEN '???? awful \U0001f621 ' || message_text
        ELSE message_text END AS message_text FROM grouped)""",
        valences("loud"),
    ),
)
def n8_emphasis(spark, sf_dir):
    said, kind = F.col("message_text"), (F.col("conversation_id") + F.col("sequence_number")) % 6
    loud = (
        F.when(kind == 0, F.upper(said))
        .when(kind == 1, F.concat(said, F.lit(" but "), F.upper(said)))
        .when(kind == 2, F.concat(said, F.lit(" not VERY good!!!!!")))
        .when(kind == 3, F.concat(F.lit("Yeah right :( so Bad?? "), said))
        .when(kind == 4, F.concat(F.lit("???? awful \U0001f621 "), said))
        .otherwise(said)
    )
    messages = staged(spark, sf_dir).grouped.withColumn("customer", F.when(F.col("is_customer"), loud))
    return (
        sentiment.with_valence(messages, "customer")
        .groupBy("conversation_id")
        .agg(F.round(F.sum("valence"), 4).alias("valence"))
    )


# Model replies for N16, by conversation: readable, fenced, incomplete, null fields, cut off, trailing text, none.
def analysis_replies(stage: Staged) -> DataFrame:
    number = F.col("conversation_id").cast("string")
    whole = F.concat(
        F.lit('{"is_resolved": true, "resolution_confidence": 0.9, "tags": ["model_tag", "c'),
        number,
        F.lit('"], "nature_of_request": "billing", "customer_sentiment": "neutral", "resolution_summary": "Summary '),
        number,
        F.lit('", "key_issues": ["issue '),
        number,
        F.lit('"], "agent_performance": "excellent"}'),
    )
    kind = F.col("conversation_id") % 7
    reply = (
        F.when(kind == 0, whole)
        .when(kind == 1, F.concat(F.lit(" ```json\n"), whole, F.lit("\n```\n")))
        .when(kind == 2, F.lit('{"is_resolved": false}'))
        .when(kind == 3, F.lit('```{"is_resolved": null, "tags": null, "agent_performance": "poor"}```'))
        .when(kind == 4, F.concat(F.lit('{"is_resolved": tr'), number))
        .when(kind == 5, F.concat(whole, F.lit(" done")))
    )
    return stage.assessed.select("conversation_id", reply.alias("response_text")).where("response_text IS NOT NULL")


_KIND = "conversation_id % 7"
_PARSED_SQL = f"""replies AS (SELECT conversation_id, {_KIND} IN (0, 1) AS whole, {_KIND} IN (4, 5) AS failed,
    {_KIND} = 3 AS rated, CAST(conversation_id AS VARCHAR) AS number FROM assessed WHERE {_KIND} <> 6),
parsed AS (SELECT conversation_id, whole AS is_resolved,
    CASE WHEN whole THEN CAST(0.9 AS DOUBLE) WHEN failed THEN CAST(0 AS DOUBLE) END AS resolution_confidence,
    CASE WHEN whole THEN ['model_tag', 'c' || number] WHEN failed THEN ['gemini_analysis_failed']
        ELSE ['unanalyzed'] END AS tags,
    CASE WHEN whole THEN 'billing' WHEN failed THEN 'unknown' ELSE 'general' END AS nature_of_request,
    'neutral' AS customer_sentiment, CASE WHEN failed THEN 'medium' END AS urgency_level,
    CASE WHEN failed THEN 'unknown' END AS conversation_type, CASE WHEN failed THEN 'unknown' END AS customer_behavior,
    CASE WHEN whole THEN 'Summary ' || number WHEN failed THEN 'Analysis failed' END AS resolution_summary,
    CASE WHEN whole THEN ['issue ' || number] WHEN failed THEN ['analysis_error'] END AS key_issues,
    CASE WHEN whole THEN 'excellent' WHEN failed THEN 'unknown' WHEN rated THEN 'poor' END AS agent_performance
    FROM replies)"""
_MERGED_SQL = f"""{_PARSED_SQL},
merged AS (SELECT a.* REPLACE (
    CASE WHEN taken THEN p.tags ELSE a.tags END AS tags,
    CASE WHEN taken THEN coalesce(p.resolution_summary, a.resolution_summary) ELSE a.resolution_summary END
        AS resolution_summary,
    CASE WHEN taken THEN coalesce(p.key_issues, []) ELSE a.key_issues END AS key_issues,
    CASE WHEN taken THEN coalesce(p.agent_performance, 'fair') ELSE a.agent_performance END AS agent_performance)
    FROM (SELECT a.*, needs_llm AND q.conversation_id IS NOT NULL AS taken FROM assessed a
        LEFT JOIN parsed q USING (conversation_id)) a LEFT JOIN parsed p USING (conversation_id))"""


@query("n16_merge_replies", upto("assessed", f"SELECT {RECORD_SQL} FROM merged", _MERGED_SQL))
def n16_merge_replies(spark, sf_dir):
    stage = staged(spark, sf_dir)
    parsed = model_exchange.parse_analysis_replies(analysis_replies(stage))
    return model_exchange.merge_replies(stage.assessed, parsed).select("conversation_id", *RECORD_COLUMNS)


@query(
    "n17_fallback_records",
    turns(
        "assessed",
        f"SELECT {RECORD_SQL} FROM assessed",
    ).replace("role = 'user' AS is_customer", "role = 'user' AND conv_id % 2 = 0 AS is_customer"),
)
def n17_fallback_records(spark, sf_dir):
    agents_only = (F.col("conversation_id") % 2 == 0) & F.col("is_customer")
    rows = staged(spark, sf_dir).turns.withColumn("is_customer", agents_only)
    return analysis.analyse(rows).select("conversation_id", *RECORD_COLUMNS)


@query("n18_analysis", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def n18_analysis(spark, sf_dir):
    return analysis.analyse(staged(spark, sf_dir).grouped).select("conversation_id", *RECORD_COLUMNS)


@query("n18_turn_analysis", turns("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def n18_turn_analysis(spark, sf_dir):
    return analysis.analyse(staged(spark, sf_dir).turns).select("conversation_id", *RECORD_COLUMNS)


@query("n18_transcript_analysis", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def n18_transcript_analysis(spark, sf_dir):
    given = transcripts.transcripts(staged(spark, sf_dir).grouped).select("conversation_id", "full_conversation")
    return analysis.analyse_transcripts(given).select("conversation_id", *RECORD_COLUMNS)


@query("n18_structured_analysis", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def n18_structured_analysis(spark, sf_dir):
    made = analysis.analyse(staged(spark, sf_dir).grouped, structured=True)
    return made.select("conversation_id", *RECORD_COLUMNS)


@query("n18_transcript_part_analysis", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def n18_transcript_part_analysis(spark, sf_dir):
    parts = transcripts.transcript_parts(staged(spark, sf_dir).grouped, 2)
    return analysis.analyse_transcripts(parts).select("conversation_id", *RECORD_COLUMNS)


@query("n16_repeated_replies", upto("assessed", f"SELECT {RECORD_SQL} FROM merged", _MERGED_SQL))
def n16_repeated_replies(spark, sf_dir):
    """Every reply twice, and an unreadable one beside each readable one."""
    stage = staged(spark, sf_dir)
    rows = analysis_replies(stage)
    cut_off = rows.where("conversation_id % 7 IN (0, 1, 2, 3)").withColumn("response_text", F.lit('{"tags": ['))
    parsed = model_exchange.parse_analysis_replies(rows.unionByName(cut_off).unionByName(rows))
    return model_exchange.merge_replies(stage.assessed, parsed).select("conversation_id", *RECORD_COLUMNS)


@query("n19_batch_analysis", upto("cohorts", BEHAVIOUR_SQL))
def n19_batch_analysis(spark, sf_dir):
    folder = scratch(spark, "tables")
    files.store_grouped(staged(spark, sf_dir).grouped, folder)
    return jobs.behaviour(spark, folder, classifier="rules")


# Model exchange


@query(
    "l1_analysis_requests",
    upto(
        "assessed",
        "SELECT conversation_id, true AS has_text, full_conversation AS conversation FROM assessed"
        " JOIN transcripts USING (conversation_id) WHERE needs_llm",
    ),
)
def l1_analysis_requests(spark, sf_dir):
    stage = staged(spark, sf_dir)
    prompts = model_exchange.analysis_requests(stage.assessed, stage.grouped)
    before, _, after = model_exchange.ANALYSIS_INSTRUCTIONS.partition("{conversation}")
    framed = F.startswith("prompt", F.lit(before)) & F.endswith("prompt", F.lit(after))
    return prompts.select(
        "conversation_id",
        framed.alias("has_text"),
        F.expr(f"substr(prompt, {len(before) + 1}, length(prompt) - {len(before) + len(after)})").alias("conversation"),
    )


@query(
    "l2_unfence",
    """SELECT doc_id, regexp_replace(regexp_replace(text, '^[\\t-\\r\\x1c-\\x1f\\x{85}\\p{Z}]+', ''),
    '[\\t-\\r\\x1c-\\x1f\\x{85}\\p{Z}]+$', '') AS text FROM documents""",
)
def l2_unfence(spark, sf_dir):
    fenced = F.concat(
        F.lit("\n"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("```json\n")).when(F.col("doc_id") % 3 == 1, F.lit("```")).otherwise(""),
        F.col("text"),
        F.when(F.col("doc_id") % 3 != 2, F.lit("\n```")).otherwise(F.lit("")),
        F.lit("  "),
    )
    return table(spark, sf_dir, "documents").select("doc_id", model_exchange.unfence(fenced).alias("text"))


@query("l3_parse_analysis_replies", upto("assessed", f"SELECT {RECORD_SQL} FROM parsed", _PARSED_SQL))
def l3_parse_analysis_replies(spark, sf_dir):
    return model_exchange.parse_analysis_replies(analysis_replies(staged(spark, sf_dir)))


@query(
    "l4_recommendation_requests",
    upto(
        "context",
        f"""SELECT conversation_id, replace(chat_history, ' ### ', chr(10) || '---' || chr(10)) AS history,
    concat_ws(chr(10), 'Customer: ' || customer_id, 'Conversation: ' || conversation_id, 'Nature of request: '
        || nature_of_request, 'Sentiment: ' || customer_sentiment, 'Urgency: ' || urgency_level, 'Conversation type: '
        || conversation_type, 'Behavior: ' || customer_behavior, 'Cohorts: ' || coalesce(customer_cohorts, 'none'),
        'Tags: ' || array_to_string(tags, ', '), 'Latest message: ' || latest_message, 'Messages: ' || total_messages,
        'Last interaction: ' || {clock('latest_interaction')}) AS facts FROM context""",
    ),
)
def l4_recommendation_requests(spark, sf_dir):
    stage = staged(spark, sf_dir)
    prompts = model_exchange.recommendation_requests(context.with_history(stage.context, stage.grouped))
    start, _, rest = model_exchange.RECOMMENDATION_INSTRUCTIONS.partition("{facts}")
    middle, _, end = rest.partition("{history}")
    facts = F.split_part("prompt", F.lit(middle), F.lit(1))
    history = F.split_part(F.split_part("prompt", F.lit(middle), F.lit(2)), F.lit(end), F.lit(1))
    return prompts.select(
        "conversation_id",
        history.alias("history"),
        F.replace(facts, F.lit(start), F.lit("")).alias("facts"),
    )


# Model recommendations, by conversation: readable, fenced, incomplete, bad channel, bad status, cut off, none.
def recommendation_replies(stage: Staged) -> DataFrame:
    def reply(channel: str, status: str, end: str = '"}') -> Column:
        return F.concat(
            F.lit(f'{{"channel": "{channel}", "send_time": "2024-02-03T20:15:07Z", "message": "About '),
            F.col("nature_of_request"),
            F.lit(f'", "reasoning": "seen", "issue_status": "{status}'),
            F.lit(end),
        )

    kind = F.col("conversation_id") % 7
    text_column = (
        F.when(kind == 0, reply("email_reply", "resolved"))
        .when(kind == 1, F.concat(F.lit("```json\n"), reply("twitter_dm_reply", "resolved"), F.lit("\n```")))
        .when(kind == 2, F.lit('{"channel": "email_reply", "message": "Hello"}'))
        .when(kind == 3, reply("carrier_pigeon", "resolved"))
        .when(kind == 4, reply("scheduling_phone_call", "unsure"))
        .when(kind == 5, reply("email_reply", "resolved", ""))
    )
    return stage.context.select("conversation_id", text_column.alias("response_text")).where(
        "response_text IS NOT NULL"
    )


_REPLIES_SQL = f"""read_replies AS (SELECT conversation_id, nature_of_request, customer_id, urgency_level, chat_history,
    CASE {_KIND} WHEN 2 THEN 'missing_send_time' WHEN 3 THEN 'bad_channel' WHEN 5 THEN 'malformed' END AS reject_reason,
    CASE {_KIND} WHEN 1 THEN 'twitter_dm_reply' WHEN 3 THEN 'carrier_pigeon' WHEN 4 THEN 'scheduling_phone_call'
        WHEN 5 THEN NULL ELSE 'email_reply' END AS channel,
    CASE WHEN {_KIND} IN (2, 5) THEN NULL ELSE '2024-02-03T20:15:07Z' END AS send_time,
    CASE {_KIND} WHEN 2 THEN 'Hello' WHEN 5 THEN NULL ELSE 'About ' || nature_of_request END AS message,
    CASE WHEN {_KIND} IN (2, 5) THEN NULL ELSE 'seen' END AS reasoning,
    CASE WHEN {_KIND} IN (2, 4) THEN 'pending_customer_reply' WHEN {_KIND} = 5 THEN NULL ELSE 'resolved' END AS issue_status
    FROM context WHERE {_KIND} <> 6)"""


@query(
    "l5_parse_recommendations",
    upto(
        "context",
        "SELECT conversation_id, reject_reason, channel, send_time, message, reasoning, issue_status FROM read_replies",
        _REPLIES_SQL,
    ),
)
def l5_parse_recommendations(spark, sf_dir):
    return model_exchange.read_recommendation_replies(recommendation_replies(staged(spark, sf_dir)))


@query(
    "l6_attach_context",
    upto(
        "context",
        """SELECT conversation_id, channel, send_time, message, reasoning, issue_status, customer_id, chat_history
    FROM read_replies WHERE reject_reason IS NULL""",
        _REPLIES_SQL,
    ),
)
def l6_attach_context(spark, sf_dir):
    stage = staged(spark, sf_dir)
    read = model_exchange.read_recommendation_replies(recommendation_replies(stage))
    with_text = context.with_history(stage.context, stage.grouped)
    return model_exchange.attach_context(model_exchange.usable_replies(read), with_text)


def repeated_replies(stage: Staged) -> DataFrame:
    """The replies, each twice, and a malformed and a channel-less one beside it."""
    rows = recommendation_replies(stage)
    bad = [rows.withColumn("response_text", F.lit(text)) for text in ("{", '{"message": "Hello"}')]
    return rows.unionByName(bad[0]).unionByName(rows).unionByName(bad[1])


@query(
    "l6_repeated_replies",
    upto(
        "context",
        """SELECT conversation_id, channel, send_time, message, reasoning, issue_status, customer_id, chat_history
    FROM read_replies WHERE reject_reason IS NULL""",
        _REPLIES_SQL,
    ),
)
def l6_repeated_replies(spark, sf_dir):
    stage = staged(spark, sf_dir)
    read = model_exchange.read_recommendation_replies(repeated_replies(stage))
    usable = read.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return model_exchange.attach_context(usable, context.with_history(stage.context, stage.grouped, block_messages=2))


# Next best action

RULED_SQL = "conversation_id, customer_id, channel, send_time, message, reasoning, issue_status"


@query("b1_rule_recommendations", upto("ruled", f"SELECT {RULED_SQL} FROM ruled"))
def b1_rule_recommendations(spark, sf_dir):
    return recommend.rule_recommendations(staged(spark, sf_dir).context, AS_OF).select(*RULED_SQL.split(", "))


def varied(rows: DataFrame) -> DataFrame:
    """Rows with labels set by conversation id, so that combinations occur which the texts do not produce."""

    def one_of(step: int, *values: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), ((F.col("conversation_id") / step).cast("int") % len(values) + 1).cast("int"))

    return rows.withColumns(
        {
            "urgency_level": one_of(1, "critical", "high", "medium", "low"),
            "customer_sentiment": one_of(4, "frustrated", "angry", "neutral", "technical", "positive"),
            "customer_behavior": one_of(3, "technical", "polite", "impatient", "cooperative", "angry"),
            "nature_of_request": one_of(2, "billing", "technical", "account", "general"),
            "conversation_type": one_of(5, "escalation", "follow_up"),
            "is_resolved": F.col("conversation_id") % 3 == 0,
        }
    )


_VARIED_SQL = """(SELECT * REPLACE (
    ['critical', 'high', 'medium', 'low'][conversation_id % 4 + 1] AS urgency_level,
    ['frustrated', 'angry', 'neutral', 'technical', 'positive'][conversation_id // 4 % 5 + 1] AS customer_sentiment,
    ['technical', 'polite', 'impatient', 'cooperative', 'angry'][conversation_id // 3 % 5 + 1] AS customer_behavior,
    ['billing', 'technical', 'account', 'general'][conversation_id // 2 % 4 + 1] AS nature_of_request,
    ['escalation', 'follow_up'][conversation_id // 5 % 2 + 1] AS conversation_type,
    conversation_id % 3 = 0 AS is_resolved) FROM {})"""


@query(
    "b1_every_branch",
    upto(
        "context",
        f"""SELECT conversation_id, CASE WHEN urgency_level IN ('critical', 'high') OR customer_sentiment IN ('frustrated', 'angry')
        THEN 'scheduling_phone_call' WHEN customer_sentiment = 'technical' OR customer_behavior = 'technical'
        THEN 'email_reply' ELSE 'twitter_dm_reply' END AS channel,
    CASE WHEN urgency_level IN ('critical', 'high') OR customer_sentiment IN ('frustrated', 'angry') THEN
        'Phone call recommended due to ' || urgency_level || ' urgency and ' || customer_sentiment
        || ' sentiment requiring immediate personal attention.'
    WHEN customer_sentiment = 'technical' OR customer_behavior = 'technical' THEN
        'Email selected for technical customer requiring detailed written solution and documentation.'
    ELSE 'Twitter DM chosen for quick acknowledgment of ' || urgency_level || ' priority ' || nature_of_request
        || ' issue.' END AS reasoning FROM {_VARIED_SQL.format("context")}""",
    ),
)
def b1_every_branch(spark, sf_dir):
    chosen = recommend.rule_recommendations(varied(staged(spark, sf_dir).context), AS_OF)
    return chosen.select("conversation_id", "channel", "reasoning")


@query(
    "k2_every_rule_cohort",
    upto(
        "assessed",
        f"""SELECT conversation_id, unnest(list_filter([
        CASE WHEN nature_of_request = 'billing' AND customer_sentiment IN ('negative', 'frustrated') THEN 0 END,
        CASE WHEN nature_of_request = 'technical' AND customer_behavior = 'technical' THEN 1 END,
        CASE WHEN urgency_level IN ('high', 'critical') AND NOT is_resolved THEN 2 END,
        CASE WHEN customer_sentiment IN ('positive', 'satisfied') AND is_resolved THEN 3 END,
        CASE WHEN customer_behavior IN ('impatient', 'angry') THEN 4 END,
        CASE WHEN nature_of_request = 'account' THEN 5 END,
        CASE WHEN conversation_type = 'escalation' AND urgency_level IN ('high', 'critical') THEN 6 END,
        CASE WHEN customer_behavior IN ('polite', 'cooperative') AND nature_of_request = 'general' THEN 7 END
    ], lambda x: x IS NOT NULL))::BIGINT AS position FROM {_VARIED_SQL.format("assessed")}""",
    ),
)
def k2_every_rule_cohort(spark, sf_dir):
    return cohorts.rule_members(varied(staged(spark, sf_dir).assessed))


@query(
    "b2_decide",
    upto(
        "ruled",
        """SELECT r.conversation_id, r.customer_id, coalesce(p.channel, r.channel) AS channel,
    coalesce(p.send_time, r.send_time) AS send_time, coalesce(p.message, r.message) AS message,
    coalesce(p.reasoning, r.reasoning) AS reasoning, coalesce(p.issue_status, r.issue_status) AS issue_status
    FROM ruled r LEFT JOIN (SELECT * FROM read_replies WHERE reject_reason IS NULL) p USING (conversation_id)""",
        _REPLIES_SQL,
    ),
)
def b2_decide(spark, sf_dir):
    stage = staged(spark, sf_dir)
    read = model_exchange.read_recommendation_replies(recommendation_replies(stage))
    chosen = recommend.decide(stage.context, AS_OF, model_exchange.usable_replies(read))
    return chosen.select(*RULED_SQL.split(", "))


@query(
    "b2_repeated_replies",
    upto(
        "ruled",
        """SELECT r.conversation_id, r.customer_id, coalesce(p.channel, r.channel) AS channel,
    coalesce(p.send_time, r.send_time) AS send_time, coalesce(p.message, r.message) AS message,
    coalesce(p.reasoning, r.reasoning) AS reasoning, coalesce(p.issue_status, r.issue_status) AS issue_status
    FROM ruled r LEFT JOIN (SELECT * FROM read_replies WHERE reject_reason IS NULL) p USING (conversation_id)""",
        _REPLIES_SQL,
    ),
)
def b2_repeated_replies(spark, sf_dir):
    stage = staged(spark, sf_dir)
    read = model_exchange.read_recommendation_replies(repeated_replies(stage))
    every = read.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return recommend.decide(stage.context, AS_OF, every).select(*RULED_SQL.split(", "))


@query(
    "b3_channel_limits",
    upto(
        "ruled",
        """SELECT conversation_id, channel, CASE channel WHEN 'email_reply' THEN 1000 ELSE 500 END AS max_length,
    9 AS from_hour, CASE channel WHEN 'twitter_dm_reply' THEN 20 WHEN 'email_reply' THEN 18 ELSE 17 END AS to_hour
    FROM ruled""",
    ),
)
def b3_channel_limits(spark, sf_dir):
    chosen = recommend.rule_recommendations(staged(spark, sf_dir).context, AS_OF)
    return recommend.channel_limits(chosen).select("conversation_id", "channel", "max_length", "from_hour", "to_hour")


def asked(stage: Staged) -> DataFrame:
    """Recommendations with every kind of channel, time, text and defect, one per open conversation."""
    number, latest = F.col("conversation_id"), F.col("latest_message")
    return stage.context.select(
        "conversation_id",
        "urgency_level",
        "customer_id",
        F.when(number % 19 == 0, "fax")
        .when(number % 3 == 0, "twitter_dm_reply")
        .when(number % 3 == 1, "email_reply")
        .otherwise("scheduling_phone_call")
        .alias("channel"),
        F.when(number % 11 == 0, "tomorrow")
        .when(number % 13 == 0, F.lit(None))
        .otherwise(F.date_format("latest_interaction", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("send_time"),
        F.when(number % 5 == 0, F.repeat(F.concat(latest, F.lit(" ")), F.lit(30)))
        .when(number % 5 == 1, F.concat(F.lit("Hi there. "), latest))
        .when(number % 5 == 2, F.concat(F.lit("Dear customer, "), latest))
        .when(number % 5 == 3, F.concat(F.lit("Please Call us. "), latest))
        .otherwise(latest)
        .alias("message"),
        F.when(number % 17 == 0, "").otherwise("because").alias("reasoning"),
        F.when(number % 23 == 0, "odd").otherwise("resolved").alias("issue_status"),
    )


_ASKED_STEPS = optimised("asked", "asked_at")


@query("b4_send_time", upto("asked", "SELECT conversation_id, channel, send_time FROM optimised", _ASKED_STEPS))
def b4_send_time(spark, sf_dir):
    timed = recommend.with_send_time(asked(staged(spark, sf_dir)), AS_OF)
    return timed.select("conversation_id", "channel", "send_time")


# The clock, the time for urgent cases, and that for urgent e-mails (which never go out on a weekend).
_URGENT = {
    "before_opening": ("2024-02-02 06:10:11", "2024-02-02T09:00:00Z", "2024-02-02T09:00:00Z"),
    "in_office_hours": ("2024-02-01 11:20:33", "2024-02-01T12:20:33Z", "2024-02-01T12:20:33Z"),
    "after_closing": ("2024-01-31 19:45:11", "2024-02-01T09:00:00Z", "2024-02-01T09:00:00Z"),
    "on_friday_evening": ("2024-02-02 18:00:00", "2024-02-03T09:00:00Z", "2024-02-05T09:00:00Z"),
    "on_a_weekend": ("2024-02-03 10:00:07", "2024-02-03T11:00:07Z", "2024-02-05T09:00:07Z"),
}
for _case, (_clock, _soon, _mail) in _URGENT.items():

    @query(
        f"b4_urgent_{_case}",
        upto(
            "assessed",
            f"""SELECT conversation_id, CASE WHEN conversation_id % 3 = 0 THEN '{_mail}' ELSE '{_soon}' END AS send_time
    FROM assessed""",
        ),
    )
    def b4_urgent(spark, sf_dir, as_of=_clock):
        number = F.col("conversation_id")
        rows = staged(spark, sf_dir).assessed.select(
            "conversation_id",
            F.when(number % 2 == 0, "critical").otherwise("high").alias("urgency_level"),
            F.when(number % 3 == 0, "email_reply")
            .when(number % 3 == 1, "scheduling_phone_call")
            .otherwise("twitter_dm_reply")
            .alias("channel"),
            F.lit("2024-02-02T12:00:00Z").alias("send_time"),
        )
        return recommend.with_send_time(rows, as_of).select("conversation_id", "send_time")


@query("b5_message", upto("asked", "SELECT conversation_id, channel, message FROM optimised", _ASKED_STEPS))
def b5_message(spark, sf_dir):
    return recommend.with_message(asked(staged(spark, sf_dir))).select("conversation_id", "channel", "message")


@query(
    "b5_fitted_message",
    upto(
        "asked",
        "SELECT conversation_id, true AS fits FROM asked WHERE channel <> 'fax'",
    ),
)
def b5_fitted_message(spark, sf_dir):
    fitted = recommend.with_message(asked(staged(spark, sf_dir)), fit=True)
    limited = recommend.channel_limits(fitted).where(F.col("max_length").isNotNull())
    return limited.select("conversation_id", (F.length("message") <= F.col("max_length")).alias("fits"))


@query("b6_validation", upto("asked", "SELECT conversation_id, reject_reason FROM validated", _ASKED_STEPS))
def b6_validation(spark, sf_dir):
    return recommend.optimise(asked(staged(spark, sf_dir)), AS_OF).select("conversation_id", "reject_reason")


@query(
    "b7_optimise",
    upto(
        "asked",
        f"SELECT {RULED_SQL} FROM validated WHERE reject_reason IS NULL",
        _ASKED_STEPS,
    ),
)
def b7_optimise(spark, sf_dir):
    done, _ = scale.checkpointed(recommend.optimise(asked(staged(spark, sf_dir)), AS_OF))
    return recommend.accepted(done).select(*RULED_SQL.split(", "))


_RULED_STEPS = optimised("ruled", f"TIMESTAMP '{AS_OF}' + INTERVAL 2 HOUR")
_ACTIONS_SQL = upto("ruled", f"{EXPORT_SQL} FROM validated WHERE reject_reason IS NULL", _RULED_STEPS)


@query("b8_next_actions", _ACTIONS_SQL)
def b8_next_actions(spark, sf_dir):
    stage = staged(spark, sf_dir)
    actions = stages.next_actions(stage.assessed, stage.grouped, *stage.cohort_tables, AS_OF)
    shown = stages.with_chat_history(actions.recommendations, stage.grouped)
    return files.export_columns(shown)


@query(
    "b9_export_history",
    "SELECT doc_id, replace(replace(replace(text, ' ### ', ' | '), chr(10), ' | '), chr(13), '') AS history FROM documents",
)
def b9_export_history(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", recommend.export_history(F.col("text")).alias("history")
    )


@query(
    "b10_recommendation_sample",
    upto(
        "ruled",
        """SELECT conversation_id, customer_id, channel, send_time, message[1:100] || '...' AS message,
    reasoning[1:150] || '...' AS reasoning FROM ruled ORDER BY conversation_id LIMIT 3""",
    ),
)
def b10_recommendation_sample(spark, sf_dir):
    return recommend.recommendation_sample(recommend.rule_recommendations(staged(spark, sf_dir).context, AS_OF))


# Stages, each from its input tables, without the staged frames


def _feed(spark, sf_dir) -> str:
    path = scratch(spark, "feed")
    adapter.raw_messages(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return path


@query("e1_ingest", upto("grouped", INGEST_SQL))
def e1_ingest(spark, sf_dir):
    return jobs.ingest(spark, _feed(spark, sf_dir), scratch(spark, "tables"))


@query("e1_ingested_messages", upto("grouped", f"SELECT {GROUPED_SQL} FROM grouped"))
def e1_ingested_messages(spark, sf_dir):
    folder = scratch(spark, "tables")
    jobs.ingest(spark, _feed(spark, sf_dir), folder)
    return files.read_table(spark, folder, files.GROUPED)


@query(
    "e1_rejected_rows",
    upto(
        "raw",
        """SELECT text, CASE WHEN e % 2 = 0 THEN 'missing_message_id' ELSE 'bad_created_at' END AS reject_reason,
    CASE WHEN e % 2 = 0 THEN NULL ELSE 'some day' END AS day
    FROM (SELECT *, CAST(CAST(tweet_id AS DOUBLE) AS BIGINT) AS e FROM raw) WHERE e % 7 = 0""",
    ),
)
def e1_rejected_rows(spark, sf_dir):
    """Every seventh row of the feed loses its id or its time; ingesting the others still gives the rejects as they came."""
    path, folder = scratch(spark, "feed"), scratch(spark, "tables")
    raw = adapter.raw_messages(spark, sf_dir)
    number = F.col("tweet_id").cast("double").cast("bigint")
    spoiled = raw.withColumn(
        "created_at", F.when((number % 7 == 0) & (number % 2 == 1), F.lit("some day")).otherwise(F.col("created_at").cast("string"))
    ).withColumn("tweet_id", F.when((number % 14 == 0), F.lit(" ")).otherwise(F.col("tweet_id")))
    spoiled.write.option("header", True).option("escape", '"').csv(path)
    jobs.ingest(spark, path, folder)
    return files.read_table(spark, folder, files.REJECTS).select(
        "text", "reject_reason", F.when(F.col("created_at") == "some day", F.col("created_at")).alias("day")
    )


@query("e2_behaviour", upto("assessed", f"SELECT {RECORD_SQL} FROM assessed"))
def e2_behaviour(spark, sf_dir):
    folder = scratch(spark, "tables")
    files.store_grouped(staged(spark, sf_dir).grouped, folder)
    jobs.behaviour(spark, folder, classifier="rules")
    return files.read_table(spark, folder, files.ANALYSIS).select("conversation_id", *RECORD_COLUMNS)


@query(
    "e2_behaviour_with_classifiers",
    f"""SELECT a.conversation_id, is_resolved, round(resolution_confidence, 6) AS resolution_confidence,
    array_to_string([n.nature_of_request || '_issue'] || a.tags[2:], ',') AS tags, n.nature_of_request,
    customer_sentiment, urgency_level, conversation_type, b.customer_behavior, 'Customer''s ' || n.nature_of_request
        || CASE WHEN is_resolved THEN ' issue was successfully resolved' ELSE ' issue remains unresolved' END
        AS resolution_summary, array_to_string(key_issues, ',') AS key_issues, agent_performance
    FROM ({upto('assessed', 'SELECT * FROM assessed')}) a
    JOIN ({naive_bayes('SELECT * FROM predicted')}) n ON n.conversation_id = a.conversation_id
    JOIN ({logistic('SELECT * FROM predicted')}) b ON b.conversation_id = a.conversation_id""",
)
def e2_behaviour_with_classifiers(spark, sf_dir):
    assessed = stages.assess_conversations(staged(spark, sf_dir).grouped, classifier="ml")
    return assessed.select("conversation_id", *RECORD_COLUMNS)


@query("e2_behaviour_by_default", ORACLES["e2_behaviour_with_classifiers"])
def e2_behaviour_by_default(spark, sf_dir):
    """The job as it runs without any setting, from the stored messages to the stored analysis."""
    folder = scratch(spark, "tables")
    files.store_grouped(staged(spark, sf_dir).grouped, folder)
    jobs.behaviour(spark, folder)
    return files.read_table(spark, folder, files.ANALYSIS).select("conversation_id", *RECORD_COLUMNS)


@query("e2_behaviour_with_replies", upto("assessed", f"SELECT {RECORD_SQL} FROM merged", _MERGED_SQL))
def e2_behaviour_with_replies(spark, sf_dir):
    stage = staged(spark, sf_dir)
    assessed = stages.assess_conversations(stage.grouped, classifier="rules", replies=analysis_replies(stage))
    return assessed.select("conversation_id", *RECORD_COLUMNS)


@query("e3_next_best_actions", upto("ruled", CHANNELS_SQL))
def e3_next_best_actions(spark, sf_dir):
    stage, folder = staged(spark, sf_dir), scratch(spark, "tables")
    files.store_grouped(stage.grouped, folder)
    files.write_table(analysis.records(stage.assessed), folder, files.ANALYSIS)
    files.store_cohorts(*stage.cohort_tables, folder)
    return jobs.next_best_actions(spark, folder, scratch(spark, "export"), AS_OF)


@query("e3_exported_actions", _ACTIONS_SQL)
def e3_exported_actions(spark, sf_dir):
    stage, folder, out = staged(spark, sf_dir), scratch(spark, "tables"), scratch(spark, "export")
    files.store_grouped(stage.grouped, folder)
    files.write_table(analysis.records(stage.assessed), folder, files.ANALYSIS)
    files.store_cohorts(*stage.cohort_tables, folder)
    jobs.next_best_actions(spark, folder, out, AS_OF)
    return files.read_recommendations_csv(spark, out).select(*RECOMMENDATION_COLUMNS)


@query("e4_full_run", _ACTIONS_SQL)
def e4_full_run(spark, sf_dir):
    """From message CSV to recommendation CSV."""
    folder, out = scratch(spark, "tables"), scratch(spark, "export")
    jobs.run_all(spark, _feed(spark, sf_dir), folder, out, AS_OF, classifier="rules")
    return files.read_recommendations_csv(spark, out).select(*RECOMMENDATION_COLUMNS)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to recommendations in one go, over frames."""
    messages, _ = scale.checkpointed(cleaning.clean_messages(adapter.raw_messages(spark, sf_dir)))
    grouped, _ = scale.checkpointed(threads.group_messages(messages))
    assessed, _ = scale.checkpointed(stages.assess_conversations(grouped, classifier="rules"))
    made, members = cohorts.build_cohorts(assessed)
    actions = stages.next_actions(assessed, grouped, made, members, AS_OF)
    return files.export_columns(stages.with_chat_history(actions.recommendations, grouped))
