"""Text classifiers over TF-IDF weights: multinomial naive Bayes and logistic regression.

A fitted model is a small stored table of term weights plus one intercept per label. Scoring never builds a vector per
conversation: term counts, norms and label scores are sums, so they combine before each shuffle.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import WORD
from threadloom.operators.scale import checkpointed
from threadloom.operators.transcripts import customer_pieces

TOKEN = WORD + "{2,}"
SMOOTHING = 1.0
INVERSE_REGULARISATION = 1.0

# The built-in training sentences.
NATURE_EXAMPLES = [
    ("I can't login to my account", "account"),
    ("My bill seems incorrect", "billing"),
    ("The API is returning errors", "technical"),
    ("How do I use this feature", "product_info"),
    ("Your service is terrible", "complaint"),
    ("Password reset not working", "account"),
    ("Charged twice for subscription", "billing"),
    ("Server timeout errors", "technical"),
    ("What does this button do", "product_info"),
    ("Very disappointed with support", "complaint"),
]
BEHAVIOUR_EXAMPLES = [
    ("Please help me with this issue", "polite"),
    ("I need this fixed RIGHT NOW", "impatient"),
    ("The REST API endpoint is failing", "technical"),
    ("I don't understand what you mean", "confused"),
    ("This is absolutely terrible service", "angry"),
    ("I understand, I'll try that solution", "cooperative"),
    ("Could you please assist me", "polite"),
    ("How much longer will this take", "impatient"),
    ("JSON response format is invalid", "technical"),
    ("What exactly should I do", "confused"),
]
# Function words of English that do not become terms. Only words that occur in training texts matter.
STOP_WORDS = [
    "about", "again", "all", "am", "an", "and", "any", "are", "as", "at", "be", "been", "before", "being", "bill",
    "but", "by", "call", "can", "cannot", "cant", "could", "do", "done", "down", "each", "every", "few", "for",
    "from", "get", "give", "go", "had", "has", "have", "he", "her", "here", "him", "his", "how", "if", "in", "into",
    "is", "it", "its", "me", "more", "most", "much", "must", "my", "no", "nor", "not", "now", "of", "off", "on",
    "once", "only", "or", "other", "our", "out", "over", "own", "please", "see", "seem", "seemed", "seems", "she",
    "should", "show", "since", "so", "some", "still", "such", "system", "take", "than", "that", "the", "their",
    "them", "then", "there", "these", "they", "this", "those", "through", "to", "too", "under", "until", "up", "us",
    "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "why", "will", "with", "would",
    "yet", "you", "your",
]
# End of fixed values.


@dataclass(frozen=True)
class Model:
    """``terms``: (term, idf, weights per label in ``labels`` order), at most ``max_features`` rows."""

    labels: tuple[str, ...]
    intercepts: tuple[float, ...]
    terms: DataFrame


def examples(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    numbered = [(number, text, label) for number, (text, label) in enumerate(rows)]
    return spark.createDataFrame(numbered, "doc_id BIGINT, text STRING, label STRING")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def training_weights(
    training: DataFrame, documents: int, max_features: int, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``(doc_id, label, term, idf, weight)``: L2-normalised TF-IDF with idf = ln((1 + n) / (1 + df)) + 1.

    The vocabulary is the ``max_features`` most frequent terms, a bounded table.
    """
    counts = (
        training.select("doc_id", "label", F.explode(_tokens(F.col("text"))).alias("term"))
        .where(~F.col("term").isin(*stop_words))
        .groupBy("doc_id", "label", "term")
        .agg(F.count("*").alias("uses"))
    )
    vocabulary = (
        counts.groupBy("term")
        .agg(F.sum("uses").alias("total"), F.count("*").alias("documents_with"))
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
        .select("term", (F.log(F.lit(1.0 + documents) / (1 + F.col("documents_with"))) + 1).alias("idf"))
    )
    raw = counts.join(F.broadcast(vocabulary), "term").withColumn("weight", F.col("uses") * F.col("idf"))
    norms = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return raw.join(norms, "doc_id").select(
        "doc_id", "label", "term", "idf", (F.col("weight") / F.col("norm")).alias("weight")
    )


def _label_counts(training: DataFrame) -> list[tuple[str, int]]:
    """Labels in alphabetical order with their training rows; a model has few labels."""
    counted = training.groupBy("label").agg(F.count("*").alias("rows")).orderBy("label")
    return [(row["label"], row["rows"]) for row in counted.collect()]


def fit_naive_bayes(
    training: DataFrame, max_features: int = 1000, stop_words: Sequence[str] = STOP_WORDS
) -> Model:
    """Multinomial naive Bayes in closed form: smoothed log share of each term's weight within a label."""
    counted = _label_counts(training)
    labels = [label for label, _ in counted]
    rows = sum(count for _, count in counted)
    weighted = training_weights(training, rows, max_features, stop_words)
    per_term = weighted.groupBy("term", "idf").agg(
        *[F.sum(F.when(F.col("label") == label, F.col("weight")).otherwise(0.0)).alias(f"w{n}")
          for n, label in enumerate(labels)]
    )
    totals = per_term.agg(
        F.count("*").alias("terms"), *[F.sum(f"w{n}").alias(f"t{n}") for n in range(len(labels))]
    ).first()
    shares = [
        F.log((F.col(f"w{n}") + SMOOTHING) / F.lit(totals[f"t{n}"] + SMOOTHING * totals["terms"]))
        for n in range(len(labels))
    ]
    priors = tuple(math.log(count / rows) for _, count in counted)
    terms, _ = checkpointed(per_term.select("term", "idf", F.array(*shares).alias("weights")))
    return Model(tuple(labels), priors, terms)


def fit_logistic(
    training: DataFrame, max_features: int = 500, stop_words: Sequence[str] = STOP_WORDS
) -> Model:
    """Multinomial logistic regression, fitted by Spark ML; the L2 strength is 1 / (C * rows)."""
    spark = training.sparkSession
    counted = _label_counts(training)
    labels = [label for label, _ in counted]
    rows = sum(count for _, count in counted)
    weighted = training_weights(training, rows, max_features, stop_words).cache()
    try:
        vocabulary = [tuple(row) for row in weighted.select("term", "idf").distinct().orderBy("term").collect()]
        width = len(vocabulary)
        position = F.array_position(F.array(*[F.lit(term) for term, _ in vocabulary]), F.col("term"))
        sparse = weighted.groupBy("doc_id", "label").agg(
            F.map_from_entries(F.collect_list(F.struct(position.alias("at"), F.col("weight")))).alias("values")
        )
        # Training rows without any term still count, as all-zero vectors.
        dense = (
            training.select("doc_id", "label")
            .join(sparse, ["doc_id", "label"], "left")
            .select(
                F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("double").alias("code"),
                array_to_vector(
                    F.transform(
                        F.sequence(F.lit(1), F.lit(width)),
                        lambda at: F.coalesce(F.try_element_at("values", at.cast("bigint")), F.lit(0.0)),
                    )
                ).alias("features"),
            )
            .withColumn("code", F.col("code") - 1)
        )
        fitted = LogisticRegression(
            featuresCol="features",
            labelCol="code",
            family="multinomial",
            regParam=1.0 / (INVERSE_REGULARISATION * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=200,
            tol=1e-7,
        ).fit(dense)
        matrix = fitted.coefficientMatrix.toArray()
        entries = [
            (term, float(idf), [float(value) for value in matrix[:, n]]) for n, (term, idf) in enumerate(vocabulary)
        ]
        terms = spark.createDataFrame(entries, "term STRING, idf DOUBLE, weights ARRAY<DOUBLE>")
        return Model(tuple(labels), tuple(float(value) for value in fitted.interceptVector), terms)
    finally:
        weighted.unpersist()


def _weights(models: Sequence[Model]) -> DataFrame:
    """All terms of the models with each model's idf and weights, and an empty term that marks every text."""
    spark = models[0].terms.sparkSession
    table = spark.range(1).select(F.lit("").alias("term"))
    for model in models:
        table = table.unionByName(model.terms.select("term"))
    table = table.distinct()
    for number, model in enumerate(models):
        entry = F.struct("idf", "weights").alias(f"model{number}")
        table = table.join(model.terms.select("term", entry), "term", "left")
    return checkpointed(table)[0]


def predict(texts: DataFrame, *wanted: tuple[Model, str, str]) -> DataFrame:
    """Predictions of ``wanted`` models, given as (model, label column, confidence column), per conversation.

    ``texts`` has (conversation_id, text) rows, several per conversation; all models share one pass over them. The best
    label is taken from scores rounded to six decimals, which neither the order of additions nor the last steps of
    an iterative fit can change; equal scores give the alphabetically first label.
    """
    models = [model for model, _, _ in wanted]
    table = _weights(models)  # at most the sum of the models' max_features, plus one row
    # Joined twice: first only to keep known terms, so that the count runs over plain numbers, then for the weights.
    marked = F.concat(F.array(F.lit("")), _tokens(F.col("text")))
    counts = (
        texts.select("conversation_id", F.explode(marked).alias("term"))
        .join(F.broadcast(table.select("term")), "term", "left_semi")
        .groupBy("conversation_id", "term")
        .agg(F.count("*").alias("uses"))
        .join(F.broadcast(table), "term")
    )
    totals = []
    for number, model in enumerate(models):
        weight = F.col("uses") * F.col(f"model{number}.idf")
        totals.append(F.sum(weight * weight).alias(f"squares{number}"))
        for n in range(len(model.labels)):
            share = F.get(F.col(f"model{number}.weights"), F.lit(n))
            totals.append(F.sum(weight * share).alias(f"dot{number}_{n}"))
    scored = counts.groupBy("conversation_id").agg(*totals)
    chosen = []
    for number, (model, label, confidence) in enumerate(wanted):
        norm = F.sqrt(f"squares{number}")
        names = [f"score{number}_{n}" for n in range(len(model.labels))]
        scored = scored.withColumns(
            {
                name: F.lit(model.intercepts[n]) + F.coalesce(F.col(f"dot{number}_{n}") / norm, F.lit(0.0))
                for n, name in enumerate(names)
            }
        )
        ranked = [
            F.struct(
                F.round(name, 6).alias("rounded"),
                F.lit(-n).alias("order"),
                F.lit(text).alias("label"),
                F.col(name).alias("score"),
            )
            for n, (name, text) in enumerate(zip(names, model.labels))
        ]
        scored = scored.withColumn(f"best{number}", F.array_max(F.array(*ranked)))
        best = F.col(f"best{number}")
        odds = functools.reduce(lambda total, each: total + each, [F.exp(F.col(name) - best["score"]) for name in names])
        chosen += [best["label"].alias(label), (1 / odds).alias(confidence)]
    return scored.select("conversation_id", *chosen)


def customer_texts(line_rows: DataFrame) -> DataFrame:
    """Customer text per message, the input of ``predict``; conversations without any are absent."""
    return line_rows.select(
        "conversation_id", F.concat_ws(" ", customer_pieces(F.col("line"))).alias("text")
    ).where(F.size(customer_pieces(F.col("line"))) > 0)


def classify(line_rows: DataFrame, nature: Model, behaviour: Model) -> DataFrame:
    """Both predictions per conversation, in the shape ``assess`` takes as labels."""
    return predict(
        customer_texts(line_rows),
        (nature, "nature_of_request", "nature_confidence"),
        (behaviour, "customer_behavior", "behavior_confidence"),
    )


def built_in_models(spark: SparkSession) -> tuple[Model, Model]:
    return (
        fit_naive_bayes(examples(spark, NATURE_EXAMPLES), max_features=1000),
        fit_logistic(examples(spark, BEHAVIOUR_EXAMPLES), max_features=500),
    )
