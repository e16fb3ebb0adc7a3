import collections
import math
import re

import numpy as np
import pytest

from threadloom.operators import classifiers


def tokens(text):
    return [w for w in re.findall(r"\w\w+", text.lower()) if w not in classifiers.STOP_WORDS]


def tfidf(rows):
    counted = [collections.Counter(tokens(text)) for text, _ in rows]
    vocabulary = sorted({word for counts in counted for word in counts})
    idf = {w: math.log((1 + len(rows)) / (1 + sum(w in c for c in counted))) + 1 for w in vocabulary}

    def vector(text):
        counts = collections.Counter(tokens(text))
        values = np.array([counts[w] * idf[w] for w in vocabulary])
        norm = math.sqrt((values * values).sum())
        return values / norm if norm else values

    return vocabulary, vector


TEXTS = {
    1: ["I can't login", "my account password"], 2: ["the server api errors errors"], 3: ["zzz"],
    4: ["terrible service, very disappointed"], 5: ["charged twice", "charged for a feature subscription"],
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(n, part) for n, parts in TEXTS.items() for part in parts]
    return spark.createDataFrame(rows, "conversation_id BIGINT, text STRING")


def softmax(scores):
    odds = np.exp(scores - scores.max())
    return odds / odds.sum()


def test_naive_bayes(spark, texts):
    rows = classifiers.NATURE_EXAMPLES
    _, vector = tfidf(rows)
    labels = sorted({label for _, label in rows})
    model = classifiers.fit_naive_bayes(classifiers.examples(spark, rows))
    assert list(model.labels) == labels
    masses = np.array([sum(vector(text) for text, y in rows if y == label) + 1 for label in labels])
    shares = np.log(masses / masses.sum(axis=1, keepdims=True))
    prior = np.log([sum(y == label for _, y in rows) / len(rows) for label in labels])
    got = {row.conversation_id: row for row in classifiers.predict(texts, (model, "label", "sure")).collect()}
    for number, parts in TEXTS.items():
        chances = softmax(prior + shares @ vector(" ".join(parts)))
        assert got[number].sure == pytest.approx(chances.max(), abs=1e-6)
        assert got[number].label == labels[int(np.argmax(np.round(chances, 9)))]
    assert got[3].label == "account" and got[3].sure == pytest.approx(0.2)


def test_logistic_reaches_the_optimum(spark, texts):
    rows = classifiers.BEHAVIOUR_EXAMPLES
    vocabulary, vector = tfidf(rows)
    model = classifiers.fit_logistic(classifiers.examples(spark, rows))
    weights = {row.term: row.weights for row in model.terms.collect()}
    assert sorted(weights) == vocabulary
    matrix = np.array([weights[w] for w in vocabulary]).T
    intercepts = np.array(model.intercepts)
    x = np.array([vector(text) for text, _ in rows])
    y = np.array([[label == name for name in model.labels] for _, label in rows], dtype=float)
    p = np.array([softmax(matrix @ row + intercepts) for row in x])
    # Gradient of (sum of log losses + half the squared weights) vanishes at the optimum.
    assert np.abs((p - y).T @ x + matrix).max() < 1e-4
    assert np.abs((p - y).sum(axis=0)).max() < 1e-4
    got = {row.conversation_id: row for row in classifiers.predict(texts, (model, "label", "sure")).collect()}
    for number, parts in TEXTS.items():
        chances = softmax(matrix @ vector(" ".join(parts)) + intercepts)
        assert got[number].sure == pytest.approx(chances.max(), abs=1e-6)


def test_vocabulary_is_limited(spark):
    model = classifiers.fit_naive_bayes(classifiers.examples(spark, classifiers.NATURE_EXAMPLES), max_features=5)
    assert model.terms.count() == 5 and "errors" in {row.term for row in model.terms.collect()}
