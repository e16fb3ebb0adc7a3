"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from checks import compare
from tests.llm.conftest import prose
from threadloom.llm import (
    common,
    decontamination,
    html_text,
    lattice_lm,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    subwords,
    token_counts,
    token_ids,
    token_store,
    toxicity,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return common.table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_against_sql(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    assert compare.difference(result, compare.database(SF_DIR), queries.ORACLES[name]) is None


# --- token counts


def test_token_counts_are_those_of_the_best_segmentation(documents, texts):
    pieces, logs = subwords.load(subwords.default_vocabulary())
    weight = dict(zip(pieces, logs))

    def best(word: bytes) -> int:
        path, found = b" " + word, [(0.0, 0)]
        for end in range(1, len(path) + 1):
            ways = [(found[b][0] + weight[path[b:end]], -found[b][1] - 1) for b in range(end) if path[b:end] in weight]
            top = max(ways)
            found.append((top[0], -top[1]))
        return found[-1][1]

    memory = {}
    some = dict(sorted(texts.items())[:40])
    expected = {
        number: sum(memory.setdefault(word, best(word)) if word not in memory else memory[word] for word in text.encode().split())
        for number, text in some.items()
    }
    found = {row.doc_id: row.n_tokens for row in token_counts.report(documents.where(F.col("doc_id").isin(*some))).collect()}
    assert found == expected


# --- page text


def test_article_without_the_rest():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header>
    <nav><ul><li><a href=a>Home</a></li></ul></nav><!-- x --><div class="cookie-notice">We use cookies.</div>
    <article><h1>Head &amp; line</h1><p>First  long\nparagraph of this article, with many words.<p>Short.
    <div class="ad">Buy this.</div><aside>By the way</aside><p>Some <b>bold</b> words.<br>Next line.</p>
    <form><label>Mail</label><input name=m><button>Go</button></form>
    <article class=inner><p>A reader wrote this nested comment, which is long.</p></article></article>
    <section id="comments"><p>Another reader's comment, even longer than the paragraphs.</p></section>
    <script>var t = "</p><p>no";</script><footer>&copy; Someone</footer></body></html>"""
    assert html_text.main_text(page) == (
        "Head & line\n\nFirst long paragraph of this article, with many words.\n\nShort.\n\nSome bold words. Next line."
    )


def test_no_article_of_a_page_is_lost():
    def block(number, words=40):
        return f"<p>{prose(number, words)}</p>"

    def texts(*blocks):
        return "\n\n".join(prose(*x) for x in blocks)

    def found(body):
        return html_text.main_text(f"<body><nav><a href=a>Home</a></nav>{body}</body>")

    one, other, third = (1, 40), (2, 40), (3, 40)
    two = f"<article>{block(1)}</article><article>{block(2)}</article>"
    assert found(f"<main>{two}</main>") == texts(one, other)
    assert found(two) == texts(one, other)
    assert found(f"<article><h2>Latest</h2>{two}</article>").endswith(texts(one, other))
    assert found(f"<main><article>{block(1, 60)}</article><div>{block(2)}</div></main>") == texts((1, 60))
    assert found(f"<main>{block(3, 90)}<article>{block(1)}</article></main>") == texts((3, 90), one)
    assert found(f"<main><article>{block(1, 20)}<article>{block(2, 15)}</article></article></main>") == texts((1, 20))
    assert found(f"<article><div itemprop=articleBody>{block(1, 60)}</div>{block(2)}</article>") == texts((1, 60), other)
    assert found(f"<main><article>{block(1)}</article></main><div><article>{block(2, 9)}</article></div>") == texts(one)
    menu = "".join(f"<a href={k}>Read {k} of all</a> " for k in range(9))
    assert found(f"<article>{block(1)}</article><article><p>{menu}</p></article><article>{block(3)}</article>") == texts(one, third)


def test_deep_pages_take_time_in_proportion():
    began = time.monotonic()
    for opened in ("<div>", "<article><p>", "<ul><li>", "<div class=comments>", "<b>"):
        found = html_text.main_text("<body>" + f"{opened}some text here " * 40_000)
        assert found.startswith("some text here")
    assert time.monotonic() - began < 60


def test_each_article_judges_its_own_comments():
    short, reply = prose(1, 30), prose(2, 12)
    long = "".join(f"<p>{prose(k, 80)}</p>" for k in range(3, 9))
    page = f"<body><article>{long}</article><article><p>{short}</p><article><p>{reply}</p></article></article></body>"
    assert short in html_text.main_text(page) and reply not in html_text.main_text(page)


def test_classes_of_text_in_an_article():
    head = f"<h1>Title</h1><p>{prose(1, 60)}</p>"
    menu = "".join(f"<li><a href={k}>Go {k}</a></li>" for k in range(5))
    for kept in ("<p class='share-price'>The price fell.</p>", "<ul class=menu><li>Soup of the day</li></ul>",
                 "<table class='search-results'><tr><td>Nine found</td></tr></table>"):
        words = html_text.main_text(f"<body><article>{head}{kept}</article></body>").split("\n\n")
        assert len(words) == 3, kept
    for dropped in ("<p class=share>Tell others</p>", "<ul class='share-links'><li>Tell others</li></ul>", f"<ul class=menu>{menu}</ul>",
                    "<p class='ad-text'>Buy</p>", "<p class=notice>Mind this</p>", "<div class='share-price'>Tell others</div>",
                    "<p class='share-price ad'>Buy</p>", "<ul class='search-form'><li>Find</li></ul>"):
        words = html_text.main_text(f"<body><article>{head}{dropped}</article></body>").split("\n\n")
        assert len(words) == 2, dropped


def test_names_do_not_hide_the_article():
    text, rest = prose(1, 60), prose(2, 20)
    comments = f"<div id=comments class=comments-open><p>{prose(3, 30)}</p></div>"
    head = f"<h1>Title</h1><p>{text}</p>"
    want = f"Title\n\n{text}"
    for page in (
        f'<body class="post comments-open"><article>{head}</article>{comments}</body>',
        f'<html class="no-comments discussion"><body id="reply"><main class="comments">{head}</main>{comments}</body></html>',
        f'<body><article class="post comments-closed">{head}</article>{comments}</body>',
        f'<body><article class="discussion">{head}</article>{comments}</body>',
        f'<body><article class="with-sidebar widget">{head}</article>{comments}</body>',
        f'<body><div class="discussion"><article>{head}{comments}</article></div></body>',
        f'<body><div id="comments">{head}</div></body>',
    ):
        assert html_text.main_text(page) == want, page
    for name in ("discussion", "search", "reply"):
        body = f"<article>{head}<section id={name}><h2 id={name}>Part</h2><p>{rest}</p></section></article>{comments}"
        assert html_text.main_text(f"<body>{body}</body>") == f"{want}\n\nPart\n\n{rest}"
    spans = f"<article>{head}<h2 id=search>Search</h2><h2><span id=Discussion>Part</span></h2><p>{rest}</p></article>"
    assert html_text.main_text(f"<body>{spans}</body>") == f"{want}\n\nSearch\n\nPart\n\n{rest}"
    for mark in ("id=comments", 'class="discussion"', 'role="search"', 'id="related"'):
        body = f"<article>{head}<section {mark}><h2>Part</h2><p>{rest}</p></section></article>{comments}"
        assert html_text.main_text(f"<body>{body}</body>") == want


def test_pages_without_an_article_element():
    body = "".join(f"<div>{prose(k, 30)}</div>" for k in range(6))
    menu = "<div>" + "".join(f"<a href={k}>Menu {k}</a> " for k in range(8)) + "</div>"
    page = f"<body><div>{menu}</div><div class=content><h1>Title here</h1>{body}</div><div>{menu}</div></body>"
    assert html_text.main_text(page) == "\n\n".join(["Title here", *(prose(k, 30) for k in range(6))])


def test_pages_of_the_test_tables(spark):
    def expected(page):
        inner = re.search("<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>|<br>", " ", inner))
        import html

        return "\n\n".join(" ".join(html.unescape(block).split()) for block in blocks if block.strip())

    pages = common.table(spark, SF_DIR, "pages")
    want = {row.page_id: expected(row.html) for row in pages.collect()}
    assert {row.page_id: row.text for row in html_text.report(pages).collect()} == want


def test_smoothing_and_threshold():
    assert np.allclose(html_text.smoothed(np.ones(7)), 1)
    assert 1 < html_text.threshold(np.array([0.0, 1.0, 1.0, 90.0, 110.0])) < 90


# --- quality classifier, toxicity


def labelled_rows(seed, n, spoil):
    source = random.Random(seed)
    rows = [(k, prose(k + 1000 * seed, source.randint(30, 200)), k % 4 == 0) for k in range(n)]
    return [(k, spoil(text, source) if bad else text, bad) for k, text, bad in rows]


def test_quality_on_held_out_documents(docs_of, labels_of):
    rows = labelled_rows(1, 400, lambda text, source: " ".join(word.upper() + "!!" for word in text.split()))
    scored = quality_classifier.report(
        docs_of([row[:2] for row in rows]), labels_of([(k, 1 - int(bad), 0) for k, _, bad in rows])
    ).collect()
    truth = {k: 1 - int(bad) for k, _, bad in rows}
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in scored)
    assert all(row.predicted == int(row.score >= 0.5) for row in scored)
    assert np.mean([row.predicted == truth[row.doc_id] for row in scored if row.held_out]) > 0.97


def test_quality_learns_phrases(docs_of, labels_of):
    """Both classes hold the same words equally often; only their order tells them apart."""
    source, rows = random.Random(7), []
    for k in range(400):
        pairs = [("river", "stone"), ("market", "window"), ("garden", "letter")]
        bad = k % 3 == 0
        rows.append((k, " ".join(f"{b} {a}" if bad else f"{a} {b}" for a, b in source.choices(pairs, k=20)), bad))
    scored = quality_classifier.report(
        docs_of([row[:2] for row in rows]), labels_of([(k, 1 - int(bad), 0) for k, _, bad in rows])
    ).collect()
    assert all(row.predicted == 1 - int(rows[row.doc_id][2]) for row in scored if row.held_out)
    with_order = quality_classifier.grams("a b c")[0], quality_classifier.grams("c b a")[0]
    assert len(with_order[0]) == 1 + 3 + 2 + 1 + 3 and sorted(with_order[0]) != sorted(with_order[1])


def test_labels_of_held_out_documents_are_never_learnt(docs_of, labels_of):
    rows = labelled_rows(2, 200, lambda text, source: text + " #### ####" * 5)
    docs = docs_of([row[:2] for row in rows])
    honest = [(k, 1 - int(bad), int(bad)) for k, _, bad in rows]
    twisted = {divisor: [(k, 1 - q, 1 - t) if zlib.crc32(str(k).encode()) % divisor == rest else (k, q, t) for k, q, t in honest]
               for divisor, rest in ((3, 1), (4, 2))}
    for module, divisor in ((quality_classifier, 3), (toxicity, 4)):
        one = {row.doc_id: row.score for row in module.report(docs, labels_of(honest)).collect()}
        two = {row.doc_id: row.score for row in module.report(docs, labels_of(twisted[divisor])).collect()}
        assert one == two


def test_ftrl_is_the_published_update():
    rates = quality_classifier.Rates(alpha=0.3, beta=1.0, l1=0.01, l2=0.2)
    examples = [(np.array([0, 5]), np.array([1.0, 0.5]), 1), (np.array([0, 9]), np.array([1.0, 2.0]), 0)]
    weights = quality_classifier.train(examples, rates, rounds=2)
    z, n = collections.Counter(), collections.Counter()

    def w(i):
        if abs(z[i]) <= rates.l1:
            return 0.0
        return -(z[i] - math.copysign(rates.l1, z[i])) / ((rates.beta + math.sqrt(n[i])) / rates.alpha + rates.l2)

    for at, values, label in examples * 2:
        p = 1 / (1 + math.exp(-sum(w(i) * v for i, v in zip(at, values))))
        steps = []
        for i, v in zip(at, values):
            g = (p - label) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / rates.alpha
            steps.append((i, g - sigma * w(i), g * g))
        for i, dz, dn in steps:
            z[i] += dz
            n[i] += dn
    for i in (0, 5, 9):
        assert weights[i] == pytest.approx(w(i), abs=1e-12)


def test_toxicity_link_does_not_depend_on_the_sample(docs_of, labels_of, monkeypatch):
    docs = docs_of([(k, prose(k, 30) + (" vermin scoundrel" if k % 5 == 0 else "")) for k in range(200)])
    labels = labels_of([(k, 1, int(k % 5 == 0)) for k in range(200)] + [(0, 1, 0), (5, 1, 1)])
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: np.zeros(x.shape[1] + 1))
    held_out = F.col("doc_id") % 4 == 3
    toxic, clean = (sum((k % 5 == 0) == kind for k in range(200) if k % 4 != 3) for kind in (True, False))
    for rows, sampled in ((1000, clean / toxic), (60, 60 / toxic), (20, 1)):
        field = toxicity.fit(docs, labels, held_out, fit_rows=rows)
        # the odds in the sample times this factor are those among all labelled training documents
        assert math.isclose(math.exp(field.link[0]), (toxic / clean) * sampled, rel_tol=1e-9)


def test_toxicity_on_held_out_documents(docs_of, labels_of):
    def spoil(text, source):
        words = text.split()
        for _ in range(source.randint(2, 5)):
            words.insert(source.randrange(len(words)), source.choice(["scoundrel", "vermin", "blockhead"]))
        return " ".join(words)

    rows = labelled_rows(3, 400, spoil)
    docs = docs_of([row[:2] for row in rows])
    scored = toxicity.report(docs, labels_of([(k, 1, int(bad)) for k, _, bad in rows])).collect()
    truth, source = {k: int(bad) for k, _, bad in rows}, {k: text for k, text, _ in rows}
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in scored)
    assert np.mean([row.predicted == truth[row.doc_id] for row in scored if row.held_out]) > 0.97
    spans = {source[row.doc_id][span.begin : span.end] for row in scored for span in row.spans}
    assert {word for span in spans for word in span.split()} == {"scoundrel", "vermin", "blockhead"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.floats(-4, 4), min_size=0, max_size=7), min_size=1, max_size=5), st.integers(1, 6))
def test_marginals_are_those_of_all_tag_sequences(chains, block):
    import itertools

    field = toxicity.Field(np.zeros(1), np.array([[0.7, -1.0], [-0.4, 1.1]]), np.array([0.3, -0.5]), np.zeros(4))
    expected = []
    for chain in chains:
        total, sums = 0.0, np.zeros(len(chain))
        for tags in itertools.product((0, 1), repeat=len(chain)):
            weight = sum(e for e, tag in zip(chain, tags) if tag)
            weight += field.start[tags[0]] if tags else 0
            weight += sum(field.transitions[a, b] for a, b in zip(tags, tags[1:]))
            total += math.exp(weight)
            sums += math.exp(weight) * np.array(tags)
        expected.extend(sums / total)
    first = np.array([k == 0 for chain in chains for k in range(len(chain))], bool)
    old, toxicity.BLOCK = toxicity.BLOCK, block
    found = toxicity.marginals(np.array([e for chain in chains for e in chain]), first, field)
    toxicity.BLOCK = old
    assert np.allclose(found, expected)


def coded(texts, lexicon):
    for table, words, tags, lengths in toxicity.coded_chains(texts, lexicon):
        yield (
            np.frombuffer(table, np.int32).reshape(-1, 8), np.frombuffer(words, np.int32),
            np.frombuffer(tags, np.int8).astype(np.int64), np.frombuffer(lengths, np.int64),
        )


@pytest.mark.parametrize("chain, group", [(1000, 1), (1000, 10**6), (7, 50)])
def test_training_rows_hold_whole_texts(monkeypatch, chain, group):
    monkeypatch.setattr(toxicity, "CHAIN", chain)
    monkeypatch.setattr(toxicity, "GROUP", group)
    texts = [(prose(1, 2500) + " vermin", 1), (None, 1), ("", 0), ("one vermin two", 0), ("Verminous, three", 1)]
    expected = [
        (toxicity.features(word), int(label == 1 and word.startswith(b"vermin")))
        for text, label in texts for word in toxicity.tokens(text)
    ]
    rows = list(coded(texts, frozenset([b"^vermin"])))
    assert [(table[word].tolist(), tag) for table, words, tags, _ in rows for word, tag in zip(words, tags)] == expected
    lengths = [len(toxicity.tokens(text)) for text, _ in texts]
    cut = [min(chain, size - low) for size in lengths for low in range(0, size, chain)]
    assert [size for row in rows for size in row[3].tolist()] == cut


def test_slopes_are_those_of_the_likelihood_of_all_tag_sequences():
    import itertools

    texts = [("vermin and other vermin", 1), ("other", 0), ("and so vermin", 1)]
    chains = [([toxicity.features(word) for word in toxicity.tokens(text)],
               [int(word == b"vermin") for word in toxicity.tokens(text)]) for text, _ in texts]
    source = np.random.default_rng(5)
    field = toxicity.Field(source.normal(0, 0.3, 1 << toxicity.BITS), source.normal(0, 1, (2, 2)), source.normal(0, 1, 2), np.zeros(4))

    def likelihood():
        whole = 0.0
        for table, tags in chains:
            e = [sum(field.weights[f] for f in (row if k % 3 == 0 else row[1:])) for k, row in enumerate(table)]

            def log_weight(path):
                moves = sum(field.transitions[a, b] for a, b in zip(path, path[1:]))
                return field.start[path[0]] + moves + sum(x for x, tag in zip(e, path) if tag)

            whole += log_weight(tags) - np.logaddexp.reduce([log_weight(path) for path in itertools.product((0, 1), repeat=len(tags))])
        return whole

    found = sum(toxicity.expectations(field, *row) for row in coded(texts, frozenset([b"vermin"])))
    touched = sorted({f for table, _ in chains for row in table for f in row})
    assert set(np.flatnonzero(found[:-6])) <= set(touched)
    places = [(field.weights, f, found[f]) for f in touched]
    places += [(field.transitions.ravel(), k, found[-6 + k]) for k in range(4)] + [(field.start, k, found[-2 + k]) for k in range(2)]
    for values, place, slope in places:
        kept = values[place]
        values[place] = kept + 1e-5
        above = likelihood()
        values[place] = kept - 1e-5
        below = likelihood()
        values[place] = kept
        assert slope == pytest.approx((above - below) / 2e-5, abs=1e-5)


# --- quality rules


def test_repeated_words_by_brute_force(texts):
    for text in texts.values():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        inside = {k + step for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for step in range(8)}
        counts, _, failed, _ = quality_rules.measure(text)
        assert (counts["n_words"], counts["n_repeat_words"]) == (len(words), len(inside))
        assert failed == (len(words) < 20 or 100 * len(inside) > 30 * len(words))


# --- token ids


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_ids.default_vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" .,'\nabtsAÉéß́<|>　\x1c")), max_size=40))
def test_cut_texts_have_the_ids_of_whole_texts(text):
    encoder = token_ids.encoder(token_ids.default_vocabulary())
    for variant in (text, text + " <|endoftext|>" + text, text.upper() + "<|ENDOFTEXT|>"):
        assert encoder.ids([variant]) == [encoder.whole([variant])[0] + encoder.end]


def test_forgetting_changes_nothing(monkeypatch, texts):
    monkeypatch.setattr(token_ids, "REMEMBERED", 50)
    encoder = token_ids.Encoder(token_ids.default_vocabulary())
    some = list(texts.values())[:60]
    found = [ids for k in range(0, 60, 7) for ids in encoder.ids(some[k : k + 7])]
    assert found == [ids + encoder.end for ids in encoder.whole(some)]


def exact_ids(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_store_round_trip(spark, documents, texts, library, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 7)
    folder = common.shared_folder(spark)
    token_store.write(documents, folder)
    start, expected = 0, []
    for number in sorted(texts):
        ids = exact_ids(library, texts[number])
        expected.append((number, start, len(ids), ids.tobytes()))
        start += len(ids)
    found = token_store.read(spark, folder).collect()
    assert sorted((row.doc_id, row.start, row.n_tokens, bytes(row.ids)) for row in found) == expected
    blocks = spark.read.parquet(f"{folder}/blocks").collect()
    content = bytes(spark.read.parquet(f"{folder}/dictionary").first().content)
    assert content and {block.dictionary_sha256 for block in blocks} == {hashlib.sha256(content).hexdigest()}
    assert max(len(block.doc_ids) for block in blocks) == 7
    wanted = sorted(texts)[3::50]
    some = token_store.lookup(spark, folder, wanted).collect()
    assert sorted((row.doc_id, bytes(row.ids)) for row in some) == [(n, exact_ids(library, texts[n]).tobytes()) for n in wanted]
    assert token_store.lookup(spark, folder, []).count() == 0


# --- decontamination


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, found = set(), set()
    for item, item_text in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item_text or "").translate({c: c + 32 for c in range(65, 91)}))
        for k in range(max(1, len(own) - 9) if own else 0):
            window = own[k : k + 10]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=30), max_size=4), st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4))
def test_search_by_brute_force(items, texts):
    named = [(str(k), " ".join(words)) for k, words in enumerate(items)]
    matcher = decontamination.Matcher([(name, decontamination.words_of(text)) for name, text in named])
    found = list(matcher.search([" ".join(words) for words in texts]))
    assert found == [brute_hits(" ".join(words), named) for words in texts]


def test_benchmark_in_blocks_gives_the_same(spark, docs_of):
    long_item = prose(77, 400)
    items = [(k, prose(k, 15 + k)) for k in range(1, 12)] + [(50, long_item), (60, "Solo")]
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows = [(k, prose(100 + k, 30) + " " + text.upper() + " " + prose(200 + k, 30)) for k, text in items]
    rows += [(900, prose(900, 50)), (901, None), (902, long_item[200:1500] + " solo")]
    docs = docs_of(rows)
    whole = {row.doc_id: row for row in decontamination.report(docs, benchmark).collect()}
    parts = {row.doc_id: row for row in decontamination.report(docs, benchmark, block_words=120).collect()}
    assert whole == parts
    for number, text in rows:
        n_words, n_hit, found = brute_hits(text, [(str(k), item) for k, item in items])
        assert (whole[number].n_words, whole[number].n_hit, whole[number].n_items) == (n_words, n_hit, len(found))
        assert whole[number].items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    clean = sorted(number for number, row in whole.items() if not row.contaminated)
    for words in (1_000_000, 120):
        assert sorted(row.doc_id for row in decontamination.clean(docs, benchmark, words).collect()) == clean


def test_blocks_of_the_benchmark_do_not_change_results(spark, docs_of):
    passages = [prose(seed, 40) for seed in range(60, 72)]
    rows = [(None, f"start {passages[0]} end"), (7, f"start {passages[1]} end"), (7, prose(90, 50)), (None, prose(91, 50)),
            (8, f"a {passages[2]} b"), (9, f"{passages[3]} {passages[4]}"), (9, f"{passages[3]} {passages[4]}"), (10, None)]
    items = [(k, text) for k, text in enumerate(passages[:10])] + [(None, passages[10]), (None, passages[2])]
    benchmark = spark.createDataFrame([(None if k is None else str(k), text) for k, text in items], "item_id STRING, text STRING")
    docs = docs_of(rows + [(11, f"x {passages[10]}")])
    whole = decontamination.report(docs, benchmark)
    blocks = decontamination.report(docs, benchmark, block_words=120)
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect()))
    found = sorted((row.doc_id or 0, row.n_hit, row.n_items) for row in whole.collect())
    assert found == [(0, 0, 0), (0, 40, 1), (7, 0, 0), (7, 40, 1), (8, 40, 1), (9, 80, 2), (9, 80, 2), (10, 0, 0), (11, 40, 0)]
    for size in (120, 1_000_000):
        left = decontamination.clean(docs, benchmark, block_words=size)
        assert left.columns == docs.columns
        assert sorted(str(row.text) for row in left.collect()) == sorted(map(str, (None, prose(90, 50), prose(91, 50))))


def test_rows_of_one_id_are_dealt_to_many_shards(spark, docs_of, library, tmp_path):
    texts = [prose(seed, 20) for seed in range(400)]
    docs = docs_of([(5, text) for text in texts] + [(None, texts[0]), (6, "last")]).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write(docs, f"{tmp_path}/store")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    blocks = spark.read.parquet(f"{tmp_path}/store/blocks")
    assert blocks.select("shard").distinct().count() > 2
    rows = sorted(token_store.read(spark, f"{tmp_path}/store").collect(), key=lambda row: row.start)
    assert [row.doc_id for row in rows] == [None] + [5] * 400 + [6]
    assert sorted(bytes(row.ids) for row in rows[1:-1]) == sorted(exact_ids(library, text).tobytes() for text in texts)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("text", ["word*** of,!! (in) a<b> É--Été! ÀÉ... x's don't,' «à» ß. ÿþ~ a`b` c}{ d|e| n°5 1,000.5%", "a.\u0338 e\u0301! Ù= <=\u0338"])
def test_pieces_of_letters_and_symbols_are_encoded_as_the_library_does(library, text):
    assert token_ids.Encoder(token_ids.default_vocabulary()).ids([text]) == [exact_ids(library, text).tobytes()]



# --- language model


def test_classes_are_learnt_from_all_training_documents(docs_of, monkeypatch):
    kinds = ["river stone water bridge", "loaf flour oven crust", "brass valve piston gauge"]
    texts = [
        (k, " ".join(kinds[k % 2 if k % 10 else 2].split()[(k * j + j * j) % 4] for j in range(30))) for k in range(1, 121)
    ]
    docs, held_out = docs_of([*texts, (None, "sail mast anchor"), (400, None), (401, "")]), F.lit(False)
    monkeypatch.setattr(lattice_lm, "SAMPLE_DOCS", 6)
    monkeypatch.setattr(lattice_lm, "CLASS_GAIN", -1.0, raising=False)
    monkeypatch.setattr(lattice_lm, "CLASS_ROUNDS", 4, raising=False)
    found = lattice_lm._classes(docs, held_out, 2)
    counts = np.array([
        np.bincount(lattice_lm._buckets(lattice_lm.words_of(text)), minlength=lattice_lm.BUCKETS)
        for _, text in [*texts, (None, "sail mast anchor")]
    ])
    unseen = found[:, np.flatnonzero(counts.sum(0) == 0)].max()
    assert (found[:, np.flatnonzero(counts.sum(0))].max(0) > unseen + 0.5).all()  # a word of any document counts
    want = lattice_lm._start(lattice_lm._hashed(docs, held_out), 2)
    for _ in range(4):
        weight = counts @ want[:, :-1].T + want[:, -1]
        share = np.exp(weight - np.logaddexp.reduce(weight, 1)[:, None])
        words = share.T @ counts + 0.1
        want = np.column_stack([np.log(words / words.sum(1, keepdims=True)), np.log((share.sum(0) + 1) / (len(counts) + 2))])
    assert np.allclose(found, want)
    assert np.isfinite(lattice_lm._classes(docs, F.lit(True), 2)).all()


def test_word_marginals_are_sums_over_all_segmentations():
    pieces, logs = subwords.load(subwords.default_vocabulary())
    weight = dict(zip(pieces, np.exp(logs)))

    def ways(path):
        return 1.0 if not path else sum(weight[path[:n]] * ways(path[n:]) for n in range(1, len(path) + 1) if path[:n] in weight)

    lattice = lattice_lm.Lattice(pieces, logs)
    words = [b"a", b"there.", "ñandú".encode(), b"rivers", b"<0x00>", "日本".encode()]
    assert np.allclose(lattice.scores(words)[:, 0], [math.log(ways(b" " + word)) for word in words])
    # each word is used as often as it counts: its bytes are spread over the expected pieces
    uses = lattice.expected(words, np.array([1.0, 2, 3, 1, 1, 5]))
    length = np.array(list(map(len, pieces)))
    assert (uses * length).sum() == pytest.approx(sum(n * (len(word) + 1) for n, word in zip([1, 2, 3, 1, 1, 5], words)))


def test_language_model_counts_and_base(documents, texts):
    for hot in (50, 300_000):
        held_out = common.fold(5, 1)
        found = {row.doc_id: row for row in lattice_lm.scored(documents, held_out, hot=hot).collect()}
        words = {number: lattice_lm.words_of(text) for number, text in texts.items()}
        out = {number for number in texts if zlib.crc32(str(number).encode()) % 5 == 1}
        counts = collections.Counter(word for number in texts if number not in out for word in words[number])
        ends = len(texts) - len(out)
        total, distinct = sum(counts.values()) + ends, len(counts) + 1
        below = total + 0.5 * (distinct + 1)
        for number, row in found.items():
            assert (row.held_out, row.n_tokens) == (number in out, len(words[number]) + 1)
            assert row.n_known == sum(word in counts for word in words[number]) + 1
            assert row.train_tokens == total
            base = sum(math.log10((counts[word] + 0.5) / below) for word in words[number]) + math.log10((ends + 0.5) / below)
            assert row.base_score == pytest.approx(base, rel=1e-9)
            assert -60 * row.n_tokens < row.score < 0
        if hot == 50:
            first = {number: row.score for number, row in found.items()}
    assert all(found[number].score == pytest.approx(score, rel=1e-9) for number, score in first.items())


# --- near duplicates


def exact_components(rows):
    sets = {}
    for number, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[number] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    parent = {number: number for number in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    order = sorted(sets)
    for a in order:
        for b in order:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {number: (len(found), root(number)) for number, found in sets.items()}


def near_groups(seed=5):
    source, rows = random.Random(seed), []
    for group in range(6):
        base = prose(group + 300, 120).split()
        for _ in range((1, 2, 5, 40, 120, 3)[group]):
            words = list(base)
            for _ in range(source.randint(0, 4)):
                words[source.randrange(len(words))] = f"w{source.randrange(1000)}"
            rows.append((len(rows), " ".join(words)))
    shared = prose(999, 60)
    rows += [(len(rows) + k, shared + " " + prose(2000 + k, 60)) for k in range(30)]
    return rows + [(5000, "a b c"), (5001, "A b\nc"), (5002, "a b d"), (5003, None), (5004, "")]


def test_components_by_brute_force(docs_of):
    rows = near_groups()
    found = {row.doc_id: row for row in near_duplicates.report(docs_of(rows)).collect()}
    for number, (size, root) in exact_components(rows).items():
        assert (found[number].n_shingles, found[number].component_id) == (size, root)
        assert found[number].kept == (number == root)


def test_hubs_in_split_regions_are_found(docs_of, monkeypatch):
    """Members that are links of one hub only: the order's neighbours do not find them, the comparison of the rest does."""
    monkeypatch.setattr(near_duplicates, "ORDER_ROWS", 200)
    source = random.Random(8)
    base = [f"b{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for k in range(1, 120):  # each far enough from the others, and near the hub
        words = list(base)
        for at in source.sample(range(0, 100, 6), 2):
            words[at] = f"x{k}-{at}"
        rows.append((k, " ".join(words)))
    expected = exact_components(rows)
    found = {row.doc_id: row.component_id for row in near_duplicates.report(docs_of(rows)).collect()}
    assert found == {number: root for number, (_, root) in expected.items()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40), st.sampled_from([4, 15, 100]))
def test_labels_are_components(spark, edges, per_task):
    links = spark.createDataFrame(edges or [(0, 0)], "a BIGINT, b BIGINT")
    found = {row.node: row.root for row in near_duplicates.components(links, per_task=per_task).collect()}
    parent = list(range(26))
    for _ in range(26):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {k: parent[k] for k in range(26) if parent[k] != k}


# --- packing


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 300), max_size=12))
def test_plan_meets_the_demand(demand):
    chosen = packing.plan(demand, 32)
    met = collections.Counter()
    for pattern, uses in chosen:
        assert uses > 0 and sum(size * copies for size, copies in pattern) <= 32
        for size, copies in pattern:
            met[size] += uses * copies
    assert dict(met) == {size: count for size, count in demand.items() if count}
    least = math.ceil(sum(size * count for size, count in demand.items()) / 32)
    assert sum(uses for _, uses in chosen) >= least


def test_column_generation_is_optimal():
    # sizes 10, 7 and 4 in 20: at prices 1/2, 2/5 and 1/5 no pattern is worth more than 1, so the best solution takes 110
    chosen = packing.column_generation({10: 100, 7: 100, 4: 100}, 20)
    assert sum(amount for _, amount in chosen) == pytest.approx(110, rel=0.01)
    for size in (10, 7, 4):
        assert sum(dict(pattern).get(size, 0) * amount for pattern, amount in chosen) == pytest.approx(100)


def test_a_plan_of_many_sizes_is_made_in_a_task(spark):
    demand = {size: 1000 + 37 * size % 101 for size in range(1, 251)}
    start = time.time()
    chosen = common.in_task(spark, packing.plan, demand, 256)
    assert time.time() - start < 60
    met = collections.Counter()
    for pattern, uses in chosen:
        assert sum(size * copies for size, copies in pattern) <= 256
        met.update({size: copies * uses for size, copies in pattern})
    assert met == demand
    assert sum(uses for _, uses in chosen) <= 1.01 * -(-sum(size * count for size, count in demand.items()) // 256)


def test_copies_under_one_id_are_dealt_to_groups(docs_of, library):
    packed = packing.pack(docs_of([(7, "the same short text")] * 700 + [(None, prose(1, 30))] * 5)).collect()
    assert len(packed) == 705 and len({(row.sequence_id, row.offset) for row in packed}) == 705


def test_pieces_hold_every_token_once(spark, documents, texts, library):
    packed = packing.pack(documents).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for row in packed:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_doc) == set(texts)
    for number, rows in by_doc.items():
        ids, at = exact_ids(library, texts[number]), 0
        for row in sorted(rows, key=lambda row: row.start):
            assert row.start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for rows in by_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        assert at <= packing.SEQUENCE
    tokens = sum(row.length for row in packed)
    assert len(by_sequence) <= math.ceil(tokens / packing.SEQUENCE) * 1.08


# --- pipeline


def test_pipeline_by_brute_force(spark, docs_of, labels_of, tmp_path, library):
    """Clean documents stay, planted ones go, and the tokens of what stays are packed."""
    rows = [(k, prose(k, 80)) for k in range(120)]
    rows += [(200, rows[3][1]), (201, rows[4][1] + " tail"), (202, "JUNK!! " * 50), (203, "too short")]
    passage = prose(5555, 30)
    rows += [(204, prose(300, 40) + " " + passage + " " + prose(301, 40))]
    toxic = [(300 + k, prose(400 + k, 60) + " vermin scoundrel " + prose(500 + k, 20) + " vermin") for k in range(60)]
    docs = docs_of(rows + toxic)
    labels = labels_of([(k, 1, 0) for k in range(120)] + [(k, 1, 1) for k, _ in toxic])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {row.doc_id for row in found} == set(range(120))
    tokens = {k: len(exact_ids(library, text)) for k, text in rows}
    assert all(row.doc_tokens == tokens[row.doc_id] for row in found)
    assert sum(row.length for row in found) == sum(tokens[k] for k in range(120))


def changed(text, every, mark):
    words = text.split()
    return " ".join(mark + word if k % every == 0 else word for k, word in enumerate(words))


def test_texts_under_one_id_are_classes_of_their_own(spark, docs_of):
    a, b, c = prose(201, 200), prose(202, 200), prose(203, 200)
    near = b + " and a few more words"
    docs = docs_of([(11, a), (11, b), (3, "something else entirely of its own"), (20, near), (5, c), (5, a + " x"), (30, ""), (30, "")])
    found = sorted((row.doc_id, row.n_shingles > 5, row.component_id) for row in near_duplicates.report(docs).collect())
    # the copy of b joins id 11, and so does a's copy under id 5, whose smallest id is 5
    assert [x for x in found if x[0] == 20] == [(20, True, 11)]
    assert sorted(x[2] for x in found if x[0] == 11) == [5, 11] and sorted(x[2] for x in found if x[0] == 5) == [5, 5]
    left = near_duplicates.distinct_documents(docs)
    assert left.columns == docs.columns
    # of a and its copy the one under id 5 stays, of b and its copy b; c has no twin
    assert sorted((row.doc_id, row.text) for row in left.collect()) == sorted(
        [(5, a + " x"), (5, c), (11, b), (3, "something else entirely of its own"), (30, ""), (30, "")])


def test_a_text_without_a_twin_stays_beside_a_copied_namesake(docs_of):
    text = prose(210, 100)
    docs = docs_of([(3, text), (5, text + " end"), (5, prose(211, 100)), (6, text), (6, text), (None, text), (8, prose(212, 90)), (8, prose(212, 90))])
    left = sorted((row.doc_id or 0, row.text) for row in near_duplicates.distinct_documents(docs).collect())
    assert left == sorted([(3, text), (5, prose(211, 100)), (0, text), (8, prose(212, 90))])


@pytest.mark.parametrize("seed", [1, 2])
def test_rare_shingles_keep_every_member_of_a_link(spark, seed):
    pick = np.random.default_rng(seed)
    template = pick.integers(1, 1 << 60, 60)
    sets = []
    for _ in range(70):  # near the threshold on both sides, of different sizes, some equal
        kept = template[pick.random(60) < pick.choice([0.7, 0.85, 0.95])]
        sets.append(np.unique(np.concatenate([kept, pick.integers(1, 1 << 60, int(pick.integers(0, 14)))])).astype(np.uint64))
    rows = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(sets)], "rep BIGINT, hashes BINARY")
    components = pick.integers(0, 12, 70).tolist()
    roots = spark.createDataFrame(list(enumerate(components)), "rep BIGINT, root BIGINT")
    found = {row.rep for row in near_duplicates.sharing(rows, roots).collect()}
    links = [(y, x) for x in range(70) for y in range(x) if components[x] != components[y] and near_duplicates.similar(sets[x], sets[y])]
    assert links and {k for link in links for k in link} <= found


def test_a_common_template_makes_no_work(spark):
    pick = np.random.default_rng(5)
    template = pick.integers(1, 1 << 60, 160)
    made = {}
    for n in (100, 400):
        sets = [np.unique(np.concatenate([template, pick.integers(1, 1 << 60, 40)])).astype(np.uint64) for _ in range(n)]
        rows = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(sets)], "rep BIGINT, hashes BINARY")
        roots = spark.createDataFrame([(k, k) for k in range(n)], "rep BIGINT, root BIGINT")
        made[n] = near_duplicates.sharing(rows, roots).count()
    assert made == {100: 0, 400: 0}
