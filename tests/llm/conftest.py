import pytest

DOCUMENT_COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"

WORDS = "the of and river stone market window garden letter winter summer engine harbour castle morning evening".split()


def prose(seed: int, words: int) -> str:
    """Text without repetition beyond chance."""
    state, out = seed * 7919 + 1, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 16) % len(WORDS)] + ("" if state % 3 else str(state % 97)))
    return " ".join(out)


NASTY = [
    (0, None),
    (1, ""),
    (2, " \n\t "),
    (3, "word"),
    (4, prose(1, 60)),
    (5, prose(1, 60)),
    (6, prose(2, 4000)),
    (7, "x" * 30_000),
    (8, "É ñ ß — ‘quoted’ 日本   \x00 <|endoftext|> <|ENDOFTEXT|> don't."),
    (9, "a line\n" * 40),
    (9, "a line\n" * 40),
    (None, "without an id"),
    (10, prose(3, 40) + " " + "#*% " * 30),
]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) pairs."""

    def build(rows, **more):
        full = [(number, text, "en", "s", len(text or "")) for number, text in rows]
        return spark.createDataFrame(full, DOCUMENT_COLUMNS)

    return build


@pytest.fixture(scope="session")
def nasty(docs_of):
    return docs_of(NASTY)


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def labels_of(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")

    return build
