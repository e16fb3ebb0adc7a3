"""Scores worked out by hand, from no constant of the library."""

import pytest

from threadloom.operators import analysis

# customer text, compound score, bucket
MOODS = [
    ("good", 0.4404, "positive"),  # 1.9 / sqrt(1.9 ** 2 + 15)
    ("not good", -0.3412, "negative"),  # 1.9 * -0.74 = -1.406
    ("very good", 0.4927, "positive"),  # 1.9 + 0.293
    ("very bad", -0.5849, "frustrated"),  # -(2.5 + 0.293)
    ("bad bad bad", -0.8885, "frustrated"),  # -7.5
    ("good bad", -0.1531, "negative"),  # -0.6
    ("table", 0.0, "neutral"),
    ("this is GOOD", 0.5622, "positive"),  # 1.9 + 0.733 = 2.633
    ("good!!!", 0.5826, "positive"),  # 1.9 + 0.876 = 2.776
    ("good but bad", -0.5859, "frustrated"),  # 0.95 - 3.75 = -2.8
    ("yeah right", -0.4588, "negative"),  # -2 / sqrt(19)
]


@pytest.mark.parametrize("body, score, mood", MOODS)
def test_moods(grouped_of, body, score, mood):
    row = analysis.analyse(grouped_of({1: [(True, body)]})).first()
    assert (row.compound, row.customer_sentiment) == (score, mood)


# turns, resolved score, unresolved score, resolved, urgency
ENDINGS = [
    ([(True, "my package is late"), (False, "we look into it")], 0, "medium"),
    ([(True, "this is urgent, an emergency"), (False, "one moment")], 0, "critical"),
]


@pytest.mark.parametrize("turns, solved, urgency", ENDINGS)
def test_endings(grouped_of, turns, solved, urgency):
    row = analysis.analyse(grouped_of({1: turns})).first()
    assert (row.resolved_score, row.is_resolved, row.urgency_level) == (solved, False, urgency)


def test_separators_and_labels_inside_texts(grouped_of):
    body = "good | AGENT: x: bad | CUSTOMER: y: bad"
    rows = grouped_of({1: [(True, body), (False, "CUSTOMER: z: bad")], 2: [(False, "CUSTOMER: z: bad")]})
    found = {row.conversation_id: row for row in analysis.analyse(rows, structured=True).collect()}
    assert (found[1].piece_count, found[1].customer_messages, found[2].customer_messages) == (2, 1, 0)
    read = {row.conversation_id: row for row in analysis.analyse(rows).collect()}
    assert read[1].piece_count == 4 and read[2].customer_messages == 1
