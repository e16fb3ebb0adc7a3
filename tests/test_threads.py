import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import scale, threads, transcripts


def groups(roots):
    found = {}
    for row in roots.collect():
        found.setdefault(row["root_id"], set()).add(row["tweet_id"])
    return sorted(map(sorted, found.values()))


def components(links):
    """Connected groups of (id, parent) pairs by union-find, parents outside the data ignored."""
    leader = {message: message for message, _ in links}

    def find(message):
        while leader[message] != message:
            leader[message] = leader[leader[message]]
            message = leader[message]
        return message

    for message, parent in links:
        if parent in leader:
            leader[find(message)] = find(parent)
    found = {}
    for message in leader:
        found.setdefault(find(message), set()).add(message)
    return sorted(map(sorted, found.values()))


def test_shapes(messages_of):
    rows = [
        ("a", None), ("b", "a"), ("c", "a"), ("d", "c"),  # branch
        ("m", "gone"), ("n", "m"),  # missing parent
        ("s", "s"), ("t", "s"),  # self-reply
        ("x", "z"), ("y", "x"), ("z", "y"), ("w", "x"), ("v", "w"),  # cycle of three with a tail
        ("alone", None), ("none", "None"),
    ]
    roots = threads.thread_roots(messages_of(rows))
    assert groups(roots) == [
        ["a", "b", "c", "d"], ["alone"], ["m", "n"], ["none"], ["s", "t"], ["v", "w", "x", "y", "z"],
    ]
    named = {row["tweet_id"]: row["root_id"] for row in roots.collect()}
    assert named["d"] == "a" and named["n"] == "m" and named["t"] == "s"


def test_long_chain(messages_of):
    rows = [(f"{n:05d}", None if n == 0 else f"{n - 1:05d}") for n in range(1000)]
    assert threads.thread_roots(messages_of(rows)).select("root_id").distinct().collect() == [("00000",)]


@pytest.mark.parametrize("seed, hot_rows", [(1, scale.HOT_ROWS), (2, 2), (3, 5), (4, scale.HOT_ROWS), (5, 1)])
def test_random_graphs(messages_of, seed, hot_rows):
    draw = random.Random(seed)
    rows = []
    for n in range(400):
        kind = draw.random()
        if kind < 0.2:
            parent = None
        elif kind < 0.55:
            parent = "7"  # one message answered by a third of all others
        elif kind < 0.7:
            parent = "missing"  # many replies to a message that is not there
        else:
            parent = str(draw.randrange(420))
        rows.append((str(n), parent))
    assert groups(threads.thread_roots(messages_of(rows), hot_rows)) == components(rows)


def test_grouping_is_dense_and_ordered(messages_of):
    rows = [("p1", None), ("q1", None), ("q2", "q1"), ("r1", None), ("q3", "q2"), ("s1", "gone"), ("s2", "s1")]
    grouped = threads.group_messages(messages_of(rows))
    shown = sorted((row.conversation_id, row.sequence_number, row.tweet_id) for row in grouped.collect())
    assert shown == [(1, 0, "q1"), (1, 1, "q2"), (1, 2, "q3"), (2, 0, "s1"), (2, 1, "s2")]


def test_hot_and_ordinary_paths_agree(messages_of):
    draw = random.Random(9)
    rows = [("r", None)] + [(f"h{n}", "r") for n in range(150)]
    rows += [(f"c{n}", None if n % 4 == 0 else f"c{n - 1}") for n in range(200)]
    draw.shuffle(rows)
    messages = messages_of(rows)
    plain = threads.group_messages(messages)
    for hot_rows in (3, 20):
        split = threads.group_messages(messages, hot_rows)
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_partitioning_does_not_matter(messages_of):
    rows = [(f"c{n}", None if n % 5 == 0 else f"c{n - 1 - n % 2}") for n in range(200)]
    messages = messages_of(rows)
    one = threads.group_messages(messages.coalesce(1))
    many = threads.group_messages(messages.repartition(16))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


@pytest.mark.parametrize("hot_rows", [scale.HOT_ROWS, 1])
def test_parent_lookup_and_orphans(messages_of, hot_rows):
    rows = [("a", None), ("b", "a"), ("c", "zz"), ("d", "a"), ("e", "a"), ("f", "zz"), ("g", "b")]
    messages = messages_of(rows)
    found = {row.tweet_id: row.parent_author_id for row in threads.parents(messages, hot_rows).collect()}
    assert found == {"b": "c1", "c": None, "d": "c1", "e": "c1", "f": None, "g": "c1"}
    assert sorted(row.tweet_id for row in threads.orphans(messages, hot_rows).collect()) == ["c", "f"]


def test_nested_blocks(grouped_of):
    grouped = grouped_of({1: [(True, f"m{n}") for n in range(7)], 2: [(True, "x"), (False, "y")]})
    nested = threads.nested_conversations(grouped, block_messages=3).orderBy("conversation_id").collect()
    assert [(row.conversation_id, [m.message_text for m in row.messages]) for row in nested] == [
        (1, [f"m{n}" for n in range(7)]), (2, ["x", "y"]),
    ]


def test_ordered_index(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.hash("id").alias("k"), "id")
    plain = scale.ordered_index(rows, ["k", "id"], "place")
    assert [row.place for row in plain.orderBy("k", "id").collect()] == list(range(1000))
    by_group = scale.ordered_index(rows, ["k", "id"], "place", ["g"])
    for group in range(3):
        places = [row.place for row in by_group.where(F.col("g") == group).orderBy("k", "id").collect()]
        assert places == list(range(len(places))) and len(places) in (333, 334)


def test_lookup_spreads_missing_and_hot_keys(spark):
    probe = spark.range(900).select(
        F.col("id").cast("string").alias("n"),
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.when(F.col("id") < 500, "hot").otherwise("gone")).otherwise(F.col("id").cast("string")).alias("key"),
    )
    build = spark.range(900).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("twice")).union(
        spark.createDataFrame([("hot", -1)], "key STRING, twice BIGINT")
    )
    hot = scale.hot_keys(probe, "key", 900, 100)
    assert sorted(row.key for row in hot.collect()) == ["gone", "hot"]
    for chosen in (None, hot):
        rows = scale.lookup(probe, build, "key", "n", chosen).collect()
        assert len(rows) == 900
        for row in rows:
            number = int(row.n)
            popular = -1 if number < 500 else None
            assert row.twice == (None if number % 3 == 0 else popular if number % 3 == 1 else number * 2)


@pytest.mark.parametrize("rows", [[], [("a", None)], [("a", None), ("b", "gone")]])
def test_nothing_to_group(messages_of, rows):
    messages = messages_of(rows)
    assert threads.thread_roots(messages).count() == len(rows)
    assert threads.group_messages(messages).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("build", [transcripts.transcripts, threads.nested_conversations])
def test_a_hot_conversation_is_put_together_by_many_tasks(spark, grouped_of, build):
    talk = {1: [(k % 2 == 0, f"m{k}") for k in range(900)]} | {c: [(True, "x"), (False, "y")] for c in range(2, 30)}
    grouped = grouped_of(talk).repartition(6, "tweet_id")
    built = build(grouped, block_messages=20)
    # the messages' exchange is by conversation and block; only blocks meet by conversation
    exchanges = [line for line in plan_of(built).splitlines() if "hashpartitioning(conversation_id" in line]
    assert len(exchanges) == 2 and "part#" not in exchanges[0] and "part#" in exchanges[1]
    rows = {row.conversation_id: row for row in built.collect()}
    assert len(rows) == 29
    if build is transcripts.transcripts:
        names = ["CUSTOMER: c1", "AGENT: agent"]
        assert rows[1].full_conversation == " | ".join(f"{names[k % 2]}: m{k}" for k in range(900)) and rows[1].message_count == 900
    else:
        assert [record.sequence_number for record in rows[1].messages] == list(range(900))
