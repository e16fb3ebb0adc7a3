"""The stages as jobs over stored tables, each reading what the one before published.

A job publishes all its tables at once. With ``resume`` a job that was published from the same inputs and parameters, and whose
tables are still the current ones, does nothing but report again; so a rerun goes on at the stage that failed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import analysis as analysing
from threadloom.operators import cleaning, recommend, stats, threads
from threadloom.operators.scale import checkpointed
from threadloom.plans import stages
from threadloom.sources import files
from threadloom.sources.store import Store, feed_fingerprint


def ingest(
    spark: SparkSession, csv_path: str, folder: str, *, multiline: bool | None = None, keep: str = "earliest", resume: bool = False
) -> DataFrame:
    """Read, clean and store messages, rebuild and store conversations; returns the run summary.

    Of messages with one id, the earliest is kept, or the ``first`` in the order of the feed. The figures are observed on the
    rows as they are written.
    """
    store = Store(spark, folder)
    inputs = store.fingerprint(feed=feed_fingerprint(spark, csv_path), multiline=multiline, keep=keep)
    found = store.done("ingest", inputs) if resume else None
    if found is None:
        first = keep == "first"
        # The feed is parsed once; messages and rejects both come from the stored rows.
        raw = files.read_messages_csv(spark, csv_path, multiline, position=first)
        rows, _ = checkpointed(cleaning.sorted_out(raw))
        typed = rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw")
        cleaned, grouping, refused = Observation(), Observation(), Observation()
        with store.transaction() as work:
            work.write(files.REJECTS, cleaning.rejected(rows).observe(refused, F.count(F.lit(1)).alias("rejected")))
            messages = files.with_load_time(cleaning.cleaned(typed, keep)).observe(cleaned, *cleaning.observed_figures())
            messages = work.write(files.RAW, messages)
            grouped = files.clustered(threads.group_messages(messages.drop("created_timestamp")))
            # Conversations are numbered from 1 without gaps.
            work.write(files.GROUPED, grouped.observe(grouping, F.max("conversation_id").alias("conversations")))
            found = {**cleaned.get, "rejected_rows": refused.get["rejected"], "conversations": grouping.get["conversations"] or 0}
            work.finish("ingest", inputs, [files.REJECTS, files.RAW, files.GROUPED], **found)
    return stats.ingest_figures(spark, found["clean_rows"], found["conversations"])


def behaviour(
    spark: SparkSession,
    folder: str,
    *,
    classifier: str = "ml",
    models=None,
    replies: DataFrame | None = None,
    limit: int | None = None,
    id_order: str = "number",
    resume: bool = False,
) -> DataFrame:
    """Analyse stored conversations, all or the first ``limit``, and build cohorts; returns the run summary.

    Runs with models or replies of their own are never taken for done.
    """
    store = Store(spark, folder)
    inputs = store.fingerprint(files.GROUPED, classifier=classifier, limit=limit, id_order=id_order)
    known = models is None and replies is None
    if not (resume and known and store.done("behaviour", inputs) is not None):
        grouped = store.read(files.GROUPED)
        if limit is not None:
            key = F.col("conversation_id")
            chosen = grouped.select("conversation_id").distinct()
            chosen = chosen.orderBy(key.cast("string") if id_order == "text" else key).limit(limit)
            grouped = stats.messages_of(grouped, chosen)
        assessed = stages.assess_conversations(grouped, classifier=classifier, models=models, replies=replies)
        with store.transaction() as work:
            analysis = work.write(files.ANALYSIS, analysing.records(assessed), key="conversation_id")
            cohorts, members = stages.cohort_tables(analysis)
            work.write(files.COHORTS, cohorts)
            work.write(files.MEMBERS, members)
            if known:
                work.finish("behaviour", inputs, [files.ANALYSIS, files.COHORTS, files.MEMBERS])
            else:
                work.commit.stages.pop("behaviour", None)
    return stages.behaviour_summary(store.read(files.ANALYSIS), store.read(files.COHORTS))


def next_best_actions(
    spark: SparkSession,
    folder: str,
    csv_path: str,
    as_of: dt.datetime | str,
    *,
    replies: DataFrame | None = None,
    rules: bool = True,
    fit: bool = False,
    fanout: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Recommend, store and export; returns the number of recommendations per channel.

    The export is written before its tables are published, so a stage that is done has its export. Runs with
    replies of their own are never taken for done.
    """
    store = Store(spark, folder)
    tables = [files.ANALYSIS, files.GROUPED, files.COHORTS, files.MEMBERS]
    inputs = store.fingerprint(*tables, as_of=as_of, rules=rules, fit=fit, fanout=fanout, export=csv_path)
    if not (resume and replies is None and store.done("next_best_actions", inputs) is not None):
        analysis, grouped, cohorts, members = map(store.read, tables)
        actions = stages.next_actions(analysis, grouped, cohorts, members, as_of, replies=replies, rules=rules, fit=fit)
        with store.transaction() as work:
            stored = work.write(files.RECOMMENDATIONS, actions.recommendations)
            work.write(files.RECOMMENDATION_REJECTS, actions.rejects)
            exported = stages.with_chat_history(stored, grouped, fanout=fanout).orderBy("conversation_id")
            files.write_recommendations_csv(exported, csv_path)
            if replies is None:
                work.finish("next_best_actions", inputs, [files.RECOMMENDATIONS, files.RECOMMENDATION_REJECTS])
            else:
                work.commit.stages.pop("next_best_actions", None)
    return recommend.channel_distribution(store.read(files.RECOMMENDATIONS))


def run_all(
    spark: SparkSession,
    csv_path: str,
    folder: str,
    out_csv: str,
    as_of: dt.datetime | str,
    *,
    classifier: str = "ml",
    resume: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All three jobs in order; a failing job stops the run, and ``resume`` goes on there. Returns the three summaries."""
    first = ingest(spark, csv_path, folder, resume=resume)
    second = behaviour(spark, folder, classifier=classifier, resume=resume)
    third = next_best_actions(spark, folder, out_csv, as_of, resume=resume)
    return first, second, third
