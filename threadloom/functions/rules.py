"""Pattern rules, evaluated message by message and combined per conversation.

The rules count pattern hits in a whole transcript. Counting does not need the transcript in one place:

* a plain pattern is a literal text that cannot reach across the separator between two messages: hits add up;
* a gap pattern ``A.*B`` matches a single-line text at most once (``.*`` is greedy), namely when some ``B`` starts after
  an ``A`` ends: when the first ``A`` of the conversation comes before its last ``B``.

So one scan per message extracts every literal that occurs in any pattern, and a conversation is described by the
number, first place and last place of each literal. Those add up in columns of fixed width, which combine before the
shuffle, so a conversation of any length is never gathered in one task.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Results depend on these exact patterns and on the order of the families and labels.
RESOLUTION_PATTERNS = {
    "resolved_positive": [
        r"thank(?:s| you)", r"resolved", r"fixed", r"solved", r"working now", r"perfect", r"great", r"awesome",
        r"excellent", r"appreciate", r"got it working", r"all set", r"no longer", r"issue.*closed",
    ],
    "resolved_confirmation": [
        r"that.*work(?:s|ed)", r"problem.*gone", r"issue.*resolved", r"everything.*fine", r"all.*good",
        r"sorted.*out",
    ],
    "unresolved_indicators": [
        r"still.*(?:not|broken|problem)", r"doesn't work", r"not working", r"same.*(?:issue|problem)",
        r"still.*(?:issue|problem)", r"need.*help", r"frustrated", r"angry",
    ],
}
URGENCY_PATTERNS = {
    "critical": [
        r"emergency", r"urgent", r"asap", r"immediately", r"critical", r"broken.*down", r"can't.*access",
        r"system.*down",
    ],
    "high": [
        r"need.*soon", r"important", r"priority", r"quickly", r"losing.*money", r"deadline", r"right.*now",
    ],
    "medium": [r"when.*possible", r"convenient", r"sometime", r"help.*when", r"get.*back"],
    "low": [r"no.*rush", r"whenever", r"eventually", r"curious", r"wondering", r"question"],
}
NATURE_PATTERNS = {
    "billing": [
        r"bill", r"charge", r"payment", r"invoice", r"refund", r"subscription", r"credit", r"cost", r"price", r"fee",
    ],
    "technical": [
        r"error", r"bug", r"api", r"code", r"server", r"database", r"integration", r"not.*work", r"broken", r"crash",
    ],
    "account": [
        r"login", r"password", r"access", r"account", r"profile", r"settings", r"permissions", r"username",
    ],
    "product_info": [
        r"how.*to", r"what.*is", r"feature", r"documentation", r"tutorial", r"guide", r"explain", r"understand",
    ],
    "complaint": [
        r"terrible", r"worst", r"awful", r"disappointed", r"frustrated", r"angry", r"complaint", r"unacceptable",
    ],
}
BEHAVIOUR_PATTERNS = {
    "polite": [
        r"please", r"thank", r"sorry", r"excuse", r"appreciate", r"kindly", r"could.*you", r"would.*you",
    ],
    "impatient": [
        r"how.*long", r"still.*waiting", r"hours.*ago", r"urgent", r"asap", r"immediately", r"right.*now",
    ],
    "technical": [
        r"api", r"code", r"server", r"database", r"endpoint", r"json", r"xml", r"sql", r"http", r"ssl",
    ],
    "confused": [
        r"don't.*understand", r"confused", r"not.*sure", r"what.*mean", r"explain", r"unclear",
    ],
    "angry": [
        r"terrible", r"worst", r"awful", r"furious", r"outraged", r"unacceptable", r"ridiculous", r"pathetic",
    ],
    "cooperative": [
        r"understand", r"makes.*sense", r"will.*try", r"happy.*to", r"of.*course", r"absolutely", r"certainly",
    ],
}
TRANSCRIPT_WORDS = [
    "escalat", "manager", "first", "new", "never", "again", "before", "previous", "thank", "appreciate",
    "resolved", "helped", "great", "excellent", "frustrated", "angry", "terrible", "awful", "disappointed",
]
GOOD_AGENT_WORDS = ["resolved", "helped", "thank", "great", "excellent"]
POOR_AGENT_WORDS = ["frustrated", "angry", "terrible", "awful", "disappointed"]
ISSUE_WORDS = [
    "error", "problem", "issue", "bug", "broken", "fail", "wrong", "charge", "bill", "payment", "login", "access",
    "slow", "down",
]
# End of fixed values.

FAMILIES = {
    **{("transcript", name): patterns for name, patterns in RESOLUTION_PATTERNS.items()},
    **{("customer", f"urgency_{name}"): patterns for name, patterns in URGENCY_PATTERNS.items()},
    **{("customer", f"nature_{name}"): patterns for name, patterns in NATURE_PATTERNS.items()},
    **{("customer", f"behaviour_{name}"): patterns for name, patterns in BEHAVIOUR_PATTERNS.items()},
}


def _alternatives(pattern: str) -> list[str]:
    """Texts a pattern without gaps can match: its one ``(?:a|b)`` group, if any, written out."""
    group = re.fullmatch(r"(.*)\(\?:(.*)\)", pattern)
    if not group:
        return [pattern]
    return [group[1] + choice for choice in group[2].split("|")]


def _quoted(literal: str) -> str:
    return "'" + literal.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values) -> str:
    return ", ".join(map(_quoted, values))


@dataclass(frozen=True)
class Gap:
    """``head.*tail`` over the lower-cased transcript or customer text."""

    scope: str
    head: str
    tails: tuple[str, ...]

    @property
    def touching(self) -> bool:
        """Head and tail can share characters, so that the order of their starts does not settle the matter."""
        return any(
            tail in self.head or any(self.head.endswith(tail[:n]) for n in range(1, len(tail))) for tail in self.tails
        )


def plain_patterns(patterns: list[str]) -> list[str]:
    return [pattern for pattern in patterns if ".*" not in pattern]


def _gaps(scope: str, patterns: list[str]) -> list[Gap]:
    split = [pattern.partition(".*") for pattern in patterns if ".*" in pattern]
    return [Gap(scope, head, tuple(_alternatives(tail))) for head, _, tail in split]


def _overlaps_itself(literal: str) -> bool:
    return any(literal.endswith(literal[:n]) for n in range(1, len(literal)))


@functools.cache
def vocabulary(scope: str) -> tuple[str, ...]:
    """Every literal the rules look for in a scope."""
    found = set(TRANSCRIPT_WORDS if scope == "transcript" else ISSUE_WORDS)
    for (where, _), patterns in FAMILIES.items():
        if where == scope:
            found.update(literal for pattern in plain_patterns(patterns) for literal in _alternatives(pattern))
            for gap in _gaps(scope, patterns):
                found.update([gap.head, *gap.tails])
    return tuple(sorted(found))


def _prefix_tree(words) -> str:
    """A regular expression for the longest of ``words`` that starts here."""
    branches: dict[str, list[str]] = {}
    for word in words:
        if word:
            branches.setdefault(word[0], []).append(word[1:])
    if not branches:
        return ""
    tree = _choice([(first, first + _prefix_tree(rest)) for first, rest in sorted(branches.items())])
    return f"(?:{tree})?" if "" in words else tree


def _choice(branches: list[tuple[str, str]]) -> str:
    """Alternatives by first letter, halved behind letter tests so that a miss costs a few steps, not one per letter."""
    if len(branches) == 1:
        return branches[0][1]
    if len(branches) <= 3:
        return f"(?:{'|'.join(tree for _, tree in branches)})"
    middle = len(branches) // 2
    halves = branches[:middle], branches[middle:]
    tests = ["".join(letter for letter, _ in half) for half in halves]
    return "(?:" + "|".join(f"(?=[{test}]){_choice(half)}" for test, half in zip(tests, halves)) + ")"


def _term(scope: str, literal: str) -> str:
    return f"{scope[0]}:{literal}"


_NO_MEASURES = ", 'pieces', CAST(NULL AS INT), 'heard', CAST(NULL AS INT)"


def _scan(scope: str) -> str:
    """Literals of one message in order of their start; of several with the same start, the longest."""
    pattern = _quoted(f"(?=({_prefix_tree(vocabulary(scope))}))")
    place = f"CAST(sequence_number AS BIGINT) * {1 << 32}L + place"
    return (
        f"transform(regexp_extract_all({scope}, {pattern}, 1), (literal, place) ->"
        f" named_struct('term', concat('{scope[0]}:', literal), 'n', 1D, 'at', {place}{_NO_MEASURES}))"
    )


def _separate_counts() -> dict[str, tuple[str, str]]:
    """Literals that can overlap themselves are counted apart, by how much shorter the text gets without them."""
    counted = {}
    for (scope, _), patterns in FAMILIES.items():
        for literal in {text for pattern in plain_patterns(patterns) for text in _alternatives(pattern)}:
            if _overlaps_itself(literal):
                cut = f"octet_length({scope}) - octet_length(replace({scope}, {_quoted(literal)}, ''))"
                counted[f"#{_term(scope, literal)}"] = (
                    f"contains({scope}, {_quoted(literal)})",
                    f"named_struct('term', {_quoted('#' + _term(scope, literal))},"
                    f" 'n', CAST(({cut}) div {len(literal.encode())} AS DOUBLE), 'at', CAST(NULL AS BIGINT){_NO_MEASURES})",
                )
    return counted


def _separate_gaps() -> dict[str, tuple[str, str]]:
    """Places for touching gaps: twice the message number, shifted so that first < last holds exactly on a match."""
    placed = {}
    for (scope, _), patterns in FAMILIES.items():
        for gap in _gaps(scope, patterns):
            if gap.touching:
                head = f"contains({scope}, {_quoted(gap.head)})"
                start = f"instr({scope}, {_quoted(gap.head)}) + {len(gap.head)}"
                tails = " OR ".join(f"contains({scope}, {_quoted(tail)})" for tail in gap.tails)
                within = " OR ".join(f"locate({_quoted(tail)}, {scope}, {start}) > 0" for tail in gap.tails)
                first, last = _separate_terms(gap)
                double = "CAST(sequence_number AS BIGINT) * 2"
                placed[first] = (head, f"named_struct('term', {_quoted(first)}, 'n', 0D, 'at', {double} + 1{_NO_MEASURES})")
                placed[last] = (
                    tails,
                    f"named_struct('term', {_quoted(last)}, 'n', 0D,"
                    f" 'at', {double} + CASE WHEN {head} AND ({within}) THEN 2 ELSE 0 END{_NO_MEASURES})",
                )
    return placed


def _separate_terms(gap: Gap) -> tuple[str, str]:
    key = f"{_term(gap.scope, gap.head)}~{'~'.join(gap.tails)}"
    return f"#first {key}", f"#last {key}"


MESSAGE = "#message"


def message_terms(valence: Column, pieces: Column, heard: Column) -> Column:
    """Terms of one message as structs (term, n, at, pieces, heard), of which the first holds the given measures; expects
    ``sequence_number`` and lower-cased ``transcript`` and ``customer`` text."""
    separate = {**_separate_counts(), **_separate_gaps()}
    extra = [F.expr(f"CASE WHEN {test} THEN {entry} END") for test, entry in separate.values()]
    measures = F.struct(
        F.lit(MESSAGE).alias("term"),
        valence.cast("double").alias("n"),
        F.lit(None).cast("bigint").alias("at"),
        pieces.cast("int").alias("pieces"),
        heard.cast("int").alias("heard"),
    )
    return F.concat(
        F.array_compact(F.array(measures, *extra)), F.expr(_scan("transcript")), F.expr(_scan("customer"))
    )


def _terms_with(scope: str, literal: str) -> list[str]:
    """Terms whose occurrence is an occurrence of the literal: the longest literal found has it as a prefix."""
    return [_term(scope, found) for found in vocabulary(scope) if found.startswith(literal)]


def _sides(gap: Gap) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Terms for the head of a gap and for its tails."""
    if gap.touching:
        first, last = _separate_terms(gap)
        return (first,), (last,)
    tails = [term for tail in gap.tails for term in _terms_with(gap.scope, tail)]
    return tuple(_terms_with(gap.scope, gap.head)), tuple(dict.fromkeys(tails))


@functools.cache
def _places() -> dict[tuple[str, tuple[str, ...]], str]:
    """Columns for the first place of any term of a list, and for the last, as the gaps of all families need them."""
    sides = [
        place
        for (scope, _), patterns in FAMILIES.items()
        for gap in _gaps(scope, patterns)
        for place in zip(("min", "max"), _sides(gap))
    ]
    return {place: f"_{place[0]}_{number}" for number, place in enumerate(dict.fromkeys(sides))}


def _hit(gap: Gap) -> str:
    first, last = _sides(gap)
    return f"CASE WHEN {_places()['min', first]} < {_places()['max', last]} THEN 1 ELSE 0 END"


def _family(name: str) -> tuple[str, list[str]]:
    return next((scope, patterns) for (scope, family), patterns in FAMILIES.items() if family == name)


def gap_hits(family: str) -> list[Column]:
    return [F.expr(_hit(gap)) for gap in _gaps(*_family(family))]


def _plain_weights(family: str) -> dict[str, int]:
    """How many hits of a family's plain patterns one occurrence of a term stands for."""
    scope, patterns = _family(family)
    weights: dict[str, int] = {}
    for pattern in plain_patterns(patterns):
        for literal in _alternatives(pattern):
            separate = _overlaps_itself(literal)
            for term in [f"#{_term(scope, literal)}"] if separate else _terms_with(scope, literal):
                weights[term] = weights.get(term, 0) + 1
    return weights


@functools.cache
def _word_bits() -> dict[tuple[str, str], int]:
    """The bit that says a word occurs in its scope."""
    words = [*(("transcript", word) for word in TRANSCRIPT_WORDS), *(("customer", word) for word in ISSUE_WORDS)]
    return {word: number for number, word in enumerate(dict.fromkeys(words))}


_MASK_BITS = 60


def _masks(terms_of_bits: dict[int, list[str]], name: str) -> dict[str, dict[str, int]]:
    """Columns of bits: for each, the bits of every term that has any."""
    masks: dict[str, dict[str, int]] = {}
    for bit, terms in terms_of_bits.items():
        mask = masks.setdefault(f"{name}_{bit // _MASK_BITS}", {})
        for term in terms:
            mask[term] = mask.get(term, 0) | 1 << bit % _MASK_BITS
    return masks


@functools.cache
def _answers() -> dict[str, dict[str, int]]:
    """What each term says, by column: hits of a family, bits of the places it is one of, bits of the words it holds."""
    hits = {f"_hits_{family}": _plain_weights(family) for _, family in FAMILIES}
    places = {number: list(terms) for number, (_, terms) in enumerate(_places())}
    words = {bit: _terms_with(scope, word) for (scope, word), bit in _word_bits().items()}
    return {**hits, **_masks(places, "_at"), **_masks(words, "_words")}


def term_table(spark: SparkSession) -> DataFrame:
    """``_term`` and its answers, a row for every literal of the rules: to be broadcast to the terms of messages."""
    terms = sorted({term for column in _answers().values() for term in column})
    rows = [(term, *[column.get(term, 0) for column in _answers().values()]) for term in terms]
    return spark.createDataFrame(rows, ", ".join(["_term STRING", *[f"{name} BIGINT" for name in _answers()]]))


def conversation_measures() -> list[Column]:
    """Aggregates over the terms of a conversation's messages for what these measure."""
    return [
        F.count("pieces").alias("message_count"),
        F.sum("pieces").alias("piece_count"),
        F.sum("heard").alias("customer_messages"),
        F.sum(F.when(F.col("term") == MESSAGE, F.col("n"))).alias("valence"),
    ]


def conversation_terms() -> list[Column]:
    """Aggregates over the terms of a conversation's messages, with their ``term_table``, that answer all rules.

    Sums of hits by family, first and last places for the gaps, and masks of the words that occur: columns of fixed width,
    where a map of terms would be built, and searched by every rule, for each conversation. The table says which of them
    a term concerns, so no column tests the term's text.
    """
    made = []
    for _, family in FAMILIES:
        made.append(F.expr(f"coalesce(sum(_hits_{family} * n), 0D)").alias(f"_plain_{family}"))
    for number, ((pick, _), name) in enumerate(_places().items()):
        bit = f"(_at_{number // _MASK_BITS} & {1 << number % _MASK_BITS}L) != 0L"
        made.append(F.expr(f"{pick}(CASE WHEN {bit} THEN at END)").alias(name))
    for name in _answers():
        if name.startswith("_words_"):
            made.append(F.expr(f"coalesce(bit_or({name}), 0L)").alias(name.replace("_words_", "_said_")))
    return made


def family_hits(family: str) -> Column:
    """Hits of all patterns of a family in a conversation, from its ``conversation_terms``."""
    hits = [_hit(gap) for gap in _gaps(*_family(family))]
    return F.expr(f"CAST({' + '.join([f'_plain_{family}', *hits])} AS BIGINT)")


def _occurs(scope: str, words) -> str:
    masks: dict[int, int] = {}
    for word in words:
        bit = _word_bits()[scope, word]
        masks[bit // _MASK_BITS] = masks.get(bit // _MASK_BITS, 0) | 1 << bit % _MASK_BITS
    return " OR ".join(f"(_said_{number} & {mask}L) != 0L" for number, mask in masks.items())


def said(*words: str) -> Column:
    """Any of the words occurs in the transcript, also inside longer words."""
    return F.expr(_occurs("transcript", words))


def words_said(words: list[str]) -> Column:
    """How many of the words occur in the transcript."""
    return F.expr(" + ".join(f"CAST({_occurs('transcript', [word])} AS INT)" for word in words))


def issues_named(limit: int) -> Column:
    """The first issue words, in list order, that the customer uses."""
    named = ", ".join(f"CASE WHEN {_occurs('customer', [word])} THEN {_quoted(word)} END" for word in ISSUE_WORDS)
    return F.expr(f"slice(array_compact(array({named})), 1, {limit})")


def best_label(prefix: str, labels: list[str]) -> tuple[Column, Column]:
    """Label with the highest ``{prefix}_{label}`` column (first declared wins a tie) and its share of all plus one."""
    scores = [f"{prefix}_{label}" for label in labels]
    ranked = ", ".join(
        f"named_struct('score', {score}, 'place', {-order}, 'label', {_quoted(label)})"
        for order, (score, label) in enumerate(zip(scores, labels))
    )
    best = f"array_max(array({ranked}))"
    return F.expr(f"{best}.label"), F.expr(f"{best}.score / ({' + '.join(scores)} + 1)")
