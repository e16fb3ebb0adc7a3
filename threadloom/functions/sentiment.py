"""Lexicon sentiment: word valences, negation and intensity, as column expressions.

The normalisation, negation and intensity factors are the published ones for rule-based social-media sentiment
(Hutto & Gilbert, 2014), and so is emphasis: words in capitals among others that are not, exclamation and question marks, and
"but", which takes weight from what comes before it. They are read off the text before it is lower-cased, message by message.
The valence list is a short selection of words of support talk; its values are of the size, and many of them the same, as in
the lexicon published with that paper. Idioms, emoticons and emoji are words with a valence of their own. Pass another
mapping to replace the list.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word lists and weights.
VALENCES = {
    # praise and relief
    "good": 1.9, "great": 3.1, "excellent": 2.7, "awesome": 3.1, "amazing": 2.8, "perfect": 2.7, "fantastic": 2.6,
    "wonderful": 2.7, "brilliant": 2.8, "best": 3.2, "better": 1.9, "nice": 1.8, "love": 3.2, "loved": 2.9,
    "like": 1.5, "liked": 1.8, "happy": 2.7, "glad": 2.0, "pleased": 1.9, "satisfied": 1.8, "delighted": 2.3,
    "thank": 1.5, "thanks": 1.9, "thankful": 2.7, "grateful": 2.0, "appreciate": 1.7, "appreciated": 2.3,
    "help": 1.7, "helped": 1.8, "helpful": 1.8, "helping": 1.2, "kind": 2.4, "kindly": 2.1, "please": 1.3,
    "welcome": 2.0, "friendly": 2.2, "fine": 0.8, "ok": 1.2, "okay": 0.9, "yes": 1.7, "sure": 1.3, "support": 1.7,
    "solved": 1.1, "resolved": 0.7, "easy": 1.9, "free": 2.3, "fair": 1.3, "fun": 2.3, "win": 2.8, "wow": 2.8,
    "worth": 0.9, "calm": 1.3, "clear": 1.6, "honest": 2.3, "hope": 1.9, "hopefully": 1.7, "impressed": 2.1,
    "improve": 1.9, "improved": 2.1, "safe": 1.9, "smooth": 0.9, "success": 2.7, "successfully": 2.2, "trust": 2.3,
    "useful": 1.9, "agree": 1.5, "accept": 1.6, "enjoy": 2.2, "favorite": 2.0, "cool": 1.3, "lol": 1.8,
    "interested": 1.7, "important": 0.8, "ready": 1.5, "respect": 2.1, "reward": 2.7, "care": 2.2, "careful": 0.6,
    # trouble and anger
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "terrible": -2.1, "awful": -2.0, "horrible": -2.5, "poor": -2.1,
    "pathetic": -2.7, "ridiculous": -1.5, "unacceptable": -2.0, "useless": -1.8, "hate": -2.7, "angry": -2.3,
    "anger": -2.7, "furious": -2.7, "outraged": -2.5, "mad": -2.2, "annoyed": -1.6, "annoying": -1.7, "upset": -1.6,
    "frustrated": -2.4, "frustrating": -1.9, "frustration": -2.1, "disappointed": -2.1, "disappointing": -2.2,
    "disappointment": -2.3, "sad": -2.1, "sorry": -0.3, "wrong": -2.1, "problem": -1.7, "problems": -1.7,
    "trouble": -1.7, "error": -1.7, "errors": -1.4, "fail": -2.5, "failed": -2.3, "fails": -1.8, "failing": -2.3,
    "failure": -2.3, "broken": -2.1, "broke": -1.8, "crash": -1.7, "crashed": -1.7, "lost": -1.3, "lose": -1.7,
    "losing": -1.6, "stuck": -1.0, "stupid": -2.4, "crap": -1.6, "damn": -1.7, "hell": -3.6, "scam": -2.7,
    "fraud": -2.8, "cheated": -2.3, "lied": -1.6, "lies": -1.8, "steal": -2.2, "stolen": -2.2, "rude": -2.0,
    "ignored": -1.3, "ignoring": -1.7, "waste": -1.8, "wasted": -2.2, "delay": -1.3, "delayed": -0.9,
    "confused": -1.3, "confusing": -0.9, "complaint": -1.2, "complain": -1.5, "cancel": -1.0, "cancelled": -1.0,
    "refused": -1.2, "reject": -1.7, "rejected": -2.3, "urgent": 0.8, "emergency": -1.6, "critical": -1.3,
    "unhappy": -1.8, "worried": -1.2, "worry": -1.9, "tired": -1.9, "sick": -2.3, "disgusting": -2.4,
    "disgusted": -2.4, "nightmare": -2.8, "shame": -2.1, "unfair": -2.1, "no": -1.2, "hard": -0.4, "difficult": -1.5,
    "pain": -2.3, "warning": -1.4, "blame": -1.4, "doubt": -1.5, "fault": -1.7, "unable": -1.4,
}
NEGATORS = [
    "not", "no", "never", "none", "nobody", "nothing", "nowhere", "neither", "nor", "without", "cannot", "can't",
    "cant", "don't", "dont", "doesn't", "doesnt", "didn't", "didnt", "isn't", "isnt", "wasn't", "wasnt", "aren't",
    "arent", "weren't", "werent", "won't", "wont", "wouldn't", "wouldnt", "couldn't", "couldnt", "shouldn't",
    "shouldnt", "hasn't", "hasnt", "haven't", "havent", "hadn't", "hadnt", "rarely", "seldom", "despite",
]
BOOSTERS = {
    **dict.fromkeys(
        [
            "absolutely", "amazingly", "completely", "deeply", "enormously", "entirely", "especially", "exceptionally",
            "extremely", "highly", "hugely", "incredibly", "more", "most", "particularly", "quite", "really",
            "remarkably", "so", "thoroughly", "totally", "truly", "unbelievably", "utterly", "very",
        ],
        0.293,
    ),
    **dict.fromkeys(
        ["almost", "barely", "hardly", "kinda", "less", "little", "marginally", "partly", "slightly", "somewhat"],
        -0.293,
    ),
}
# Turns of speech that count as one word, emoticons and emoji.
IDIOMS = {"yeah right": -2.0, "to die for": 3.0, "kiss of death": -1.5, "cut the mustard": 2.0, "hand to mouth": -2.0}
MARKS = {
    ":)": 2.0, ":-)": 1.3, ";)": 0.9, ":(": -1.9, ":-(": -1.5,
    "\U0001f44d": 1.9, "\U0001f600": 2.0, "\U0001f642": 1.5, "\U0001f60a": 2.0, "\U0001f60d": 2.5, "\u2764": 2.5, "\U0001f389": 2.0,
    "\U0001f44e": -1.9, "\U0001f641": -1.5, "\U0001f61e": -1.8, "\U0001f622": -1.8, "\U0001f62d": -1.5, "\U0001f620": -2.3,
    "\U0001f621": -2.5,
}
CAPITALS = 0.733
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
NEGATION = -0.74
DISTANCE_WEIGHTS = [1.0, 0.95, 0.9]
NORMALISATION = 15.0

# End of fixed values.

LEXICON = {**VALENCES, **IDIOMS, **MARKS}
TOKEN = "|".join([rf"(?i:\b(?:{'|'.join(IDIOMS)})\b)", *map(re.escape, MARKS), r"[\p{L}']+"])


def _mapping(entries: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(part) for part in itertools.chain.from_iterable(entries.items())])


def tokens(text: Column) -> Column:
    """Words, idioms and marks as they are written."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def lowered(words: Column) -> Column:
    """The words in lower case, each in its place."""
    return F.split(F.lower(F.array_join(words, "\n")), "\n")


def _loud(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def emphasis(text: Column) -> Column:
    """What the exclamation and question marks of a text add to the size of its valence."""
    cries, questions = F.regexp_count(text, F.lit("!")), F.regexp_count(text, F.lit(r"\?"))
    return F.least(cries, F.lit(MOST_EXCLAMATIONS)) * F.lit(EXCLAMATION) + (
        F.when(questions > MOST_QUESTIONS, F.lit(MANY_QUESTIONS)).when(questions > 1, questions * F.lit(QUESTION)).otherwise(F.lit(0.0))
    )


def valence_sum(text: Column, words: Column, plain: Column, valences: Mapping[str, float] = LEXICON) -> Column:
    """Valence of one message; boosters and negators act within three words before a valued word.

    ``words`` and ``plain`` must be stored columns holding ``tokens`` of the text and ``lowered`` of them: they are read for every
    valued word. Set tests come before the map lookups: most words carry no valence and go no further. A null text, and one
    without words, has valence 0.
    """
    valued, boosts = _mapping(valences), _mapping(BOOSTERS)
    mixed = F.exists(words, lambda word: ~_loud(word))
    turn = F.array_position(plain, "but") - 1  # -1 without

    def entry(word: Column, at: Column) -> Column:
        known = F.when(word.isin(list(valences)), F.try_element_at(valued, word))
        return F.struct(known.alias("base"), at.alias("at"))

    def capitals(at: Column) -> Column:
        return F.when(_loud(F.get(words, at)) & mixed, F.lit(CAPITALS)).otherwise(F.lit(0.0))

    def valence(found: Column) -> Column:
        push, negated = capitals(found["at"]), F.lit(False)
        for distance, weight in enumerate(DISTANCE_WEIGHTS, 1):
            word = F.get(plain, found["at"] - distance)
            boost = F.when(word.isin(list(BOOSTERS)), F.try_element_at(boosts, word) + capitals(found["at"] - distance))
            push = push + F.coalesce(boost, F.lit(0.0)) * weight
            negated = negated | F.coalesce(word.isin(NEGATORS), F.lit(False))
        factor = F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))
        side = F.when((turn < 0) | (found["at"] == turn), F.lit(1.0)).when(found["at"] < turn, F.lit(BEFORE_BUT)).otherwise(F.lit(AFTER_BUT))
        return (found["base"] + F.signum(found["base"]) * push) * factor * side

    found = F.filter(F.transform(plain, entry), lambda each: each["base"].isNotNull())
    # The sum is needed twice, for its size and its sign: an array of one holds it.
    totals = F.array(F.aggregate(found, F.lit(0.0), lambda total, each: total + valence(each)))
    emphasised = F.transform(totals, lambda total: total + F.signum(total) * F.when(total != 0, emphasis(text)).otherwise(F.lit(0.0)))
    return F.coalesce(F.get(emphasised, 0), F.lit(0.0))


def with_valence(rows: DataFrame, text: str, name: str = "valence", valences: Mapping[str, float] = LEXICON) -> DataFrame:
    """The rows with one more column, the valence of the text in column ``text``; ``valences`` are of words in lower case."""
    words, plain = f"__{name}_words", f"__{name}_plain"
    return (
        rows.withColumn(words, tokens(F.col(text)))
        .withColumn(plain, lowered(F.col(words)))
        .withColumn(name, valence_sum(F.col(text), F.col(words), F.col(plain), valences))
        .drop(words, plain)
    )


def compound(total: Column) -> Column:
    return F.round(total / F.sqrt(total * total + NORMALISATION), 4)


def bucket(score: Column) -> Column:
    return (
        F.when(score >= 0.05, F.lit("positive"))
        .when(score <= -0.5, F.lit("frustrated"))
        .when(score <= -0.05, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def bucket_confidence(score: Column) -> Column:
    return F.when(F.abs(score) >= 0.05, F.abs(score)).otherwise(1 - F.abs(score))
