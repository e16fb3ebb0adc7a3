import datetime as dt

import pytest

from threadloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def messages_of(spark):
    """Cleaned messages from (id, parent) pairs or (id, parent, text, inbound) rows, one second apart."""

    def build(rows):
        start = dt.datetime(2024, 1, 1, 9, 0, 0)
        full = []
        for number, row in enumerate(rows):
            message_id, parent, body, inbound = (*row, *("text", True)[len(row) - 2 :])[:4]
            full.append(
                (str(message_id), "c1" if inbound else "agent", inbound, start + dt.timedelta(seconds=number), body, "",
                 "" if parent is None else str(parent))
            )
        return spark.createDataFrame(
            full,
            "tweet_id STRING, author_id STRING, inbound BOOLEAN, created_at TIMESTAMP, text STRING, "
            "response_tweet_id STRING, in_response_to_tweet_id STRING",
        )

    return build


@pytest.fixture(scope="session")
def grouped_of(spark):
    """Grouped messages from {conversation_id: [(is_customer, text), ...]}."""

    def build(conversations):
        start = dt.datetime(2024, 1, 1, 9, 0, 0)
        rows = []
        for conversation_id, turns in conversations.items():
            for place, (is_customer, body) in enumerate(turns):
                rows.append(
                    (conversation_id, f"{conversation_id}-{place}", "c%d" % conversation_id if is_customer else "agent",
                     is_customer, body, start + dt.timedelta(minutes=place), "", "", place)
                )
        return spark.createDataFrame(
            rows,
            "conversation_id BIGINT, tweet_id STRING, author_id STRING, is_customer BOOLEAN, message_text STRING, "
            "created_at TIMESTAMP, response_tweet_id STRING, in_response_to_tweet_id STRING, sequence_number INT",
        )

    return build
