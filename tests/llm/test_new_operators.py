"""Embedding whitening, the conversation trie and language identification, against brute force and on odd inputs."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import NASTY, prose
from threadloom.llm import common, conversation_trie, embedding_whitening, language_id

SF_DIR = "/root/testdata/sf0.001"

# --- embedding whitening


def exact_whitening(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1)
    centred = np.array(n * x - sums, float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return deviation, centred @ axes[:, order], values[order]


def embeddings_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")


def test_whitening_equals_that_of_all_rows(spark):
    table = common.table(spark, SF_DIR, "embeddings").withColumn("x", F.lit("clash")).withColumn("copies", F.lit("clash"))
    table = table.unionByName(table.where("vec_id < 100").withColumn("vec_id", F.col("vec_id") + 1_000_000))
    rows = table.orderBy("vec_id").collect()
    deviation, projected, values = exact_whitening([row.embedding for row in rows])
    found = collections.defaultdict(dict)
    for row in embedding_whitening.report(table).collect():
        found[row.vec_id][row.component] = row
    assert sorted(found) == [row.vec_id for row in rows] and all(sorted(x) == list(range(1, 33)) for x in found.values())
    signs = np.ones(32)
    for k, row in enumerate(rows):
        own = found[row.vec_id]
        whitened = np.array([own[c].whitened for c in range(1, 33)])
        expected = projected[k, :32] / np.sqrt(values[:32])
        signs = np.sign(whitened) * np.sign(expected) if k == 0 else signs
        assert np.allclose(whitened, expected * signs, atol=1e-8)
        assert {x.n for x in own.values()} == {len(rows)} and {x.deviation for x in own.values()} == {deviation[k]}
        assert np.allclose([own[c].explained for c in range(1, 33)], values[:32] / values.sum(), rtol=1e-8)
        assert own[1].identity_error < 1e-9


def test_copies_weigh_and_are_joined_in_parts(spark):
    rows = [(k, [float(k % 3), float(k % 5), float(k % 7)], 0) for k in range(60)] + [(100 + k, [1.0, 2.0, 3.0], 0) for k in range(40)]
    table = embeddings_of(spark, rows)
    whole = {row.vec_id: row.whitened for row in embedding_whitening.whitening(table).collect()}
    parts = {row.vec_id: row.whitened for row in embedding_whitening.whitening(table, part_rows=3).collect()}
    assert whole == parts and len(whole) == 100
    _, projected, values = exact_whitening([v for _, v, _ in rows])
    assert np.allclose(np.abs([whole[k] for k, _, _ in rows]), np.abs(projected / np.sqrt(values)), atol=1e-9)
    once = embedding_whitening.whitening(table, weights="one").first()
    assert once.n == len({tuple(v) for _, v, _ in rows})
    with pytest.raises(ValueError):
        embedding_whitening.whitening(table, weights="all")


def test_unusable_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [1.0, -inf], 0), (5, [], 0), (None, [1.0, 2.0], None),
            (6, [1.0, 2.0], 0), (6, [1.0, 2.0], 0), (7, [3.0, 2.0], 0), (8, [1e30, 0.0, 5.0], 0), (9, [0.0, 0.0, 5.0], 0)]
    found = embedding_whitening.report(embeddings_of(spark, rows)).collect()
    by_id = collections.Counter(row.vec_id for row in found)
    assert by_id == {None: 2, 6: 4, 7: 2, 8: 3, 9: 3}
    pairs = [row for row in found if row.vec_id in (None, 6, 7)]
    assert {row.n for row in pairs} == {4}
    assert all((row.whitened is None) == (row.component == 2) for row in pairs)  # the second entry never varies
    assert {row.explained for row in pairs if row.component == 2} == {0.0} and max(row.identity_error for row in pairs) < 1e-9
    assert {row.deviation for row in found if row.vec_id in (8, 9)} == {None}  # beyond a 64-bit integer
    alone = embedding_whitening.report(embeddings_of(spark, [(1, [0.5, 0.25], 0)])).collect()
    assert [(row.n, row.deviation, row.whitened, row.identity_error) for row in alone] == [(1, 0, None, None)] * 2
    assert embedding_whitening.report(embeddings_of(spark, [])).count() == 0


def test_deviations_are_exact_beyond_double_precision():
    x = np.array([[3], [5], [1_000_000_007]], np.int64)
    n = 3_000_017
    space = embedding_whitening.Space(n, np.array([4]), np.array([1]))
    assert space.deviations(x) == [v if v < 2**63 else None for v in ((n * (int(e) - 4) - 1) ** 2 for e in x[:, 0])]


# --- conversation trie


def brute_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {conv: [(role, text) for _, role, text in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = tuple(own.get(conv - int(math.fmod(conv, 100)), [])[:h] + turns[h:])
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    leaves, saved, found = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        if node:
            children[node[:-1]].append(node)
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if rebuilt[c] == node)
        found.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                      leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def conversations_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


def trie_rows(conversations, **more):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(row) for row in conversation_trie.trie(conversations, **more).select(*names).collect()], key=str)


def random_conversations(seed, conversations, words=3):
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(pick.choice([1, 1, 2, 3, 4, 7])):
            rows.append((conv * pick.choice([1, 1, 40]), turn, pick.choice(["user", "assistant"]), pick.choice(["a", "bb", "é€"][:words])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = random_conversations(seed, 160)
    table = conversations_of(spark, rows).withColumns({name: F.lit("x") for name in ("node", "weight", "block", "place", "leaf")})
    assert trie_rows(table) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "assistant", "z"), (2, 0, "user", None), (None, 0, "user", "lost"),
            (-7, 3, "user", "minus"), (-200, 1, "user", "base"), (-201, 1, "user", "own"), (300, 0, "u", "t" * 100_000), (305, 0, "u", "t" * 100_000)]
    assert trie_rows(conversations_of(spark, rows)) == brute_trie(rows)
    assert trie_rows(conversations_of(spark, [])) == []
    assert trie_rows(conversations_of(spark, [(None, 1, "user", "x")])) == []


def test_long_conversations_go_over_blocks_and_popular_parents_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", 4)
    monkeypatch.setattr(conversation_trie._block, "__defaults__", ("place", 4))
    monkeypatch.setattr(conversation_trie, "HOT_NODES", 1_000_000)
    monkeypatch.setattr(conversation_trie, "PIECE", 40)
    long = [(500, turn, "user", f"t{turn}") for turn in range(30)] + [(501, turn, "user", f"t{turn}") for turn in range(30)]
    rows = long + [(502, turn, "user", f"t{turn}") for turn in range(13)] + random_conversations(3, 120, words=2)
    assert trie_rows(conversations_of(spark, rows), hot_children=1) == brute_trie(rows)


# --- language identification

VOWELS = {"xa": "aeiou", "xb": "yåäöü", "xc": "αεηιο"}


def spoken(lang, seed, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("bcdfgklmnprst") + pick.choice(VOWELS[lang]) for _ in range(pick.choice([1, 2, 3]))) for _ in range(words))


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(k, spoken(lang, k, 3 + k % 30), lang, "s", 1) for k, lang in enumerate(["xa"] * 250 + ["xb"] * 120 + ["xc"] * 40)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")


def test_held_out_languages_are_found(languages):
    rows = {row.doc_id: row for row in language_id.report(languages).collect()}
    truth = {row.doc_id: row.lang for row in languages.collect()}
    assert rows.keys() == truth.keys()
    assert {row.held_out for row in rows.values()} == {True, False}
    assert all(row.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, row in rows.items())
    held = [k for k, row in rows.items() if row.held_out]
    assert sum(rows[k].lang_pred == truth[k] for k in held) >= 0.97 * len(held)
    assert all(1 / 3 <= row.score <= 1 for row in rows.values())


def test_documents_in_the_fold_teach_nothing(languages):
    held_out = common.fold(4, 2)
    changed = languages.withColumn("lang", F.when(held_out, F.lit("other")).otherwise(F.col("lang")))
    assert sorted(language_id.report(changed).collect()) == sorted(language_id.report(languages).collect())


def test_a_small_sample_still_follows_the_shares(languages):
    chosen = language_id.sample(languages, F.lit(False), fit_rows=30).collect()
    per = collections.Counter(row.lang for row in chosen)
    assert max(per.values()) <= 30 and set(per) == {"xa", "xb", "xc"}
    total = collections.defaultdict(float)
    for row in chosen:
        total[row.lang] += row.weight
    assert {lang: round(weight) for lang, weight in total.items()} == {"xa": 250, "xb": 120, "xc": 40}


def test_document_frequencies_are_those_of_all_texts(languages):
    found, texts = language_id.document_frequencies(languages)
    expected = sum((language_id.counts(row.text) > 0).astype(int) for row in languages.collect())
    assert texts == 410 and (found == expected).all()


def slow_counts(text):
    words = "".join(c if c.isalpha() else "\0" for c in text.lower())
    kept = "\0" + "\0".join(word for word in words.split("\0") if word) + "\0"
    return sum(len(kept) - n + 1 for n in language_id.ORDERS), kept


def test_ngrams_of_long_texts_are_counted_whole(monkeypatch):
    texts = ["a", "Ab, c!", "--Été 12 日本語--", prose(5, 300), "x" * 5000]
    whole = [language_id.counts(text) for text in texts]
    monkeypatch.setattr(language_id, "SLICE", 64)
    for text, found in zip(texts, whole):
        assert (language_id.counts(text) == found).all()
        assert found.sum() == slow_counts(text)[0]
    assert (language_id.counts("a  b") == language_id.counts("A-b.")).all()


def test_temperature_calibrates():
    pick = np.random.default_rng(1)
    logits = pick.normal(size=(4000, 3))
    drawn = np.array([pick.choice(3, p=p) for p in language_id.softmax(logits, 0.5)])
    heat = language_id.fitted_temperature(logits, drawn, np.ones(len(drawn)))
    assert abs(heat - 0.5) < 0.06
    assert language_id.fitted_temperature(logits[:0], drawn[:0], np.ones(0)) == 1.0


def test_odd_texts(spark, nasty, no_docs):
    clashing = nasty.withColumns({name: F.lit("x") for name in ("lang_pred", "lang_score", "weight", "numbers")})
    found = language_id.report(clashing).collect()
    assert sorted(str(row.doc_id) for row in found) == sorted(str(number) for number, _ in NASTY)
    for row in found:  # one language in the table
        text = dict(NASTY)[row.doc_id]
        known = any(c.isalpha() for c in text or "")
        assert (row.lang_pred, row.score) == (("en", 1.0) if known else ("und", 0.0))
    assert language_id.report(no_docs).count() == 0
    unlabelled = nasty.withColumn("lang", F.lit(None).cast("string"))
    assert {(row.lang_pred, row.score) for row in language_id.report(unlabelled).collect()} == {("und", 0.0)}
