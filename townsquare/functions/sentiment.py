"""Lexicon sentiment as array expressions.

Scores follow the published rule-based model of Hutto and Gilbert (2014), VADER, over a small
part of its public word list (MIT licence). Everything is computed inside the row, so posts are neither exploded nor shuffled.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.functions.text import LETTERS, bind
from townsquare.runtime import freeze

# Word scores as in the public VADER lexicon (MIT licence), from -4 (worst) to 4 (best).
LEXICON: Mapping[str, float] = {
    "amazing": 2.8,
    "awesome": 3.1,
    "beautiful": 2.9,
    "benefit": 2.0,
    "best": 3.2,
    "better": 1.9,
    "brilliant": 2.8,
    "clean": 1.7,
    "cool": 1.3,
    "correct": 1.6,
    "easy": 1.9,
    "efficient": 1.8,
    "enjoy": 2.2,
    "excellent": 2.7,
    "excited": 1.4,
    "fair": 1.3,
    "fantastic": 2.6,
    "favorite": 2.0,
    "fine": 0.8,
    "free": 2.3,
    "fresh": 1.3,
    "fun": 2.3,
    "glad": 2.0,
    "good": 1.9,
    "great": 3.1,
    "happy": 2.7,
    "helpful": 1.8,
    "honest": 2.3,
    "hope": 1.9,
    "impressive": 2.3,
    "improve": 1.9,
    "innovative": 1.9,
    "interesting": 1.7,
    "joy": 2.8,
    "kind": 2.4,
    "like": 1.5,
    "love": 3.2,
    "nice": 1.8,
    "perfect": 2.7,
    "pleased": 1.9,
    "powerful": 1.8,
    "promising": 1.7,
    "reliable": 1.8,
    "rocks": 1.5,
    "safe": 1.9,
    "smart": 1.7,
    "strong": 2.3,
    "success": 2.7,
    "support": 1.7,
    "thanks": 1.9,
    "useful": 1.9,
    "valuable": 2.1,
    "win": 2.8,
    "wonderful": 2.7,
    "abuse": -3.2,
    "angry": -2.3,
    "annoying": -1.7,
    "awful": -2.0,
    "bad": -2.5,
    "boring": -1.3,
    "broken": -2.1,
    "bug": -1.2,
    "cruel": -2.8,
    "crash": -1.7,
    "damage": -2.2,
    "danger": -2.4,
    "dead": -3.3,
    "difficult": -1.5,
    "disappointed": -1.9,
    "disaster": -3.1,
    "dirty": -1.9,
    "error": -1.7,
    "evil": -3.4,
    "expensive": -1.0,
    "fail": -2.5,
    "fake": -2.1,
    "fear": -2.2,
    "fraud": -2.8,
    "garbage": -2.2,
    "hate": -2.7,
    "horrible": -2.5,
    "hurt": -2.4,
    "idiot": -2.3,
    "loss": -1.3,
    "lost": -1.3,
    "mess": -1.5,
    "pain": -2.3,
    "poor": -2.1,
    "problem": -1.7,
    "risk": -1.1,
    "sad": -2.1,
    "scam": -2.7,
    "slow": -0.9,
    "stupid": -2.4,
    "terrible": -2.1,
    "threat": -2.4,
    "ugly": -2.3,
    "useless": -1.8,
    "victim": -1.1,
    "waste": -1.8,
    "weak": -1.9,
    "worse": -2.1,
    "worst": -3.1,
    "worthless": -1.9,
    "wrong": -2.1,
}

# Words that strengthen (+) or weaken (-) the scored word after them.
BOOST = 0.293
BOOSTERS: Mapping[str, float] = {
    "absolutely": BOOST,
    "completely": BOOST,
    "deeply": BOOST,
    "especially": BOOST,
    "extremely": BOOST,
    "highly": BOOST,
    "incredibly": BOOST,
    "more": BOOST,
    "most": BOOST,
    "really": BOOST,
    "so": BOOST,
    "totally": BOOST,
    "very": BOOST,
    "almost": -BOOST,
    "barely": -BOOST,
    "hardly": -BOOST,
    "less": -BOOST,
    "little": -BOOST,
    "partly": -BOOST,
    "slightly": -BOOST,
    "somewhat": -BOOST,
}

# Negators, in the form they have once apostrophes are gone.
NEGATORS = tuple(
    """
    aint arent cannot cant couldnt didnt doesnt dont hadnt hasnt havent isnt neither never no none
    nor not nothing nowhere shouldnt wasnt werent without wont wouldnt
    """.split()
)

# Constants of the published model.
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION = 0.292
MAX_EXCLAMATIONS = 4
QUESTION = 0.18
MANY_QUESTIONS = 0.96
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
ALPHA = 15.0
CUT = 0.05

WORD_BREAK = rf"[^{LETTERS}{string.digits}áéíóúñü]+"


def _literal_map(values: Mapping[str, float]) -> Column:
    return F.create_map(*(F.lit(part) for pair in values.items() for part in pair))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def sentiment_compound(
    cleaned: Column,
    lexicon: Mapping[str, float] = LEXICON,
    boosters: Mapping[str, float] = BOOSTERS,
    negators: tuple[str, ...] = NEGATORS,
) -> Column:
    """Compound score in [-1, 1] of cleaned text; text without scored words gives 0.

    Each scored word counts with its lexicon value, moved by boosters among the three words before
    it (damped with distance), times -0.74 per negator there, weighted by its side of the first
    "but". Exclamation and question marks add emphasis; the sum s becomes s / sqrt(s² + 15).
    """
    # The lexicon's order stays fixed so that the plan is the same in every run.
    scored = sorted(lexicon)
    values, boosts = _literal_map(lexicon), _literal_map(boosters)

    def word_score(words: Column, hit: Column, but: Column) -> Column:
        base = F.try_element_at(values, hit["word"])
        place = hit["place"]  # 0-based
        shift = F.lit(0.0)
        flips = F.lit(0)
        for distance, damping in enumerate(DAMPING, start=1):
            # Index 0 is not a legal array position, so step past the start with a null.
            before = F.when(place >= distance, F.get(words, place - distance))
            unscored = ~F.coalesce(before.isin(scored), F.lit(False))
            shift = shift + F.when(unscored, F.coalesce(F.try_element_at(boosts, before), F.lit(0.0))).otherwise(
                0.0
            ) * F.lit(damping)
            flips = flips + F.coalesce(before.isin(list(negators)), F.lit(False)).cast("int")
        side = F.when(but == 0, 1.0).when(place + 1 < but, BEFORE_BUT).when(place + 1 > but, AFTER_BUT).otherwise(1.0)
        return (base + F.signum(base) * shift) * F.pow(F.lit(NEGATION), flips) * side

    def total(words: Column) -> Column:
        placed = F.transform(words, lambda word, place: F.struct(place.alias("place"), word.alias("word")))
        hits = F.filter(placed, lambda hit: hit["word"].isin(scored))
        # Bound, so that the words are searched once a text and not once a hit.
        scores = bind(F.array_position(words, F.lit("but")), lambda but: F.transform(hits, lambda hit: word_score(words, hit, but)))
        return F.aggregate(scores, F.lit(0.0), lambda acc, score: acc + score)

    def compound(text: Column) -> Column:
        words = F.array_remove(F.split(text, WORD_BREAK), "")
        questions = _count(text, "?")
        emphasis = F.least(_count(text, "!"), F.lit(MAX_EXCLAMATIONS)) * F.lit(EXCLAMATION) + F.when(
            questions > 3, MANY_QUESTIONS
        ).when(questions > 1, questions * F.lit(QUESTION)).otherwise(0.0)
        return bind(
            bind(words, total),
            lambda s: bind(s + F.signum(s) * emphasis, lambda moved: moved / F.sqrt(moved * moved + F.lit(ALPHA))),
        )

    score = F.round(bind(F.coalesce(cleaned, F.lit("")), compound), 4)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))


def _scanned(words: Column, hits: Column, but: Column, boosters: Mapping[str, float], negators: tuple[str, ...]) -> Column:
    """Sum of the scores of ``hits`` (place, minus its number of words, value) in one pass over ``words``; the rules are those of ``sentiment_compound``.

    The pass carries the next hit's index, the end of the last entry and what the three words before do to a score.
    """
    boosts = _literal_map(boosters)
    back = range(1, len(DAMPING) + 1)
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(0.0).alias("sum"),
        *(F.lit(0.0).alias(f"boost{d}") for d in back), *(F.lit(0).alias(f"flip{d}") for d in back),
    )

    def step(acc: Column, word: Column) -> Column:
        hit = F.get(hits, acc["at"])
        here = F.coalesce(hit["place"] == word["place"], F.lit(False))
        covered = word["place"] < acc["end"]
        counts = here & ~covered
        shift = reduce(lambda x, y: x + y, (acc[f"boost{d}"] * F.lit(damping) for d, damping in zip(back, DAMPING, strict=True)))
        flips = reduce(lambda x, y: x + y, (acc[f"flip{d}"] for d in back))
        first = word["place"] + 1
        side = F.when(but == 0, 1.0).when(first < but, BEFORE_BUT).when(first > but, AFTER_BUT).otherwise(1.0)
        score = (hit["value"] + F.signum(hit["value"]) * shift) * F.pow(F.lit(NEGATION), flips) * side
        own = F.when(covered | here, 0.0).otherwise(F.coalesce(F.try_element_at(boosts, word["word"]), F.lit(0.0)))
        return F.struct(
            (acc["at"] + here.cast("int")).alias("at"),
            F.when(counts, word["place"] - hit["minus"]).otherwise(acc["end"]).alias("end"),
            (acc["sum"] + F.when(counts, score).otherwise(0.0)).alias("sum"),
            own.alias("boost1"), *(acc[f"boost{d - 1}"].alias(f"boost{d}") for d in back if d > 1),
            word["word"].isin(list(negators)).cast("int").alias("flip1"), *(acc[f"flip{d - 1}"].alias(f"flip{d}") for d in back if d > 1),
        )

    placed = F.transform(words, lambda word, place: F.struct(place.alias("place"), word.alias("word")))
    return F.aggregate(placed, start, step, lambda acc: acc["sum"])


def _compound_of_hits(text: Column, words: Column, hits: Column, boosters: Mapping[str, float], negators: tuple[str, ...]) -> Column:
    """The compound score from lexicon entries found at places of ``words``."""
    # By place, and the longest entry of a place stands first there.
    order = F.sort_array(hits)
    longest = bind(
        order, lambda found: F.filter(found, lambda hit, i: F.coalesce(F.get(found, i - 1)["place"] != hit["place"], F.lit(True)))
    )
    questions = _count(text, "?")
    emphasis = F.least(_count(text, "!"), F.lit(MAX_EXCLAMATIONS)) * F.lit(EXCLAMATION) + F.when(questions > 3, MANY_QUESTIONS).when(
        questions > 1, questions * F.lit(QUESTION)
    ).otherwise(0.0)
    raw = bind(
        # The place of "but" is bound too: inside the pass it would be searched for at every word.
        bind(longest, lambda found: bind(F.array_position(words, F.lit("but")), lambda but: _scanned(words, found, but, boosters, negators))),
        lambda s: bind(s + F.signum(s) * emphasis, lambda moved: moved / F.sqrt(moved * moved + F.lit(ALPHA))),
    )
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round(raw, 4)))


def with_table_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    text_column: str = "text_cleaned",
    inclusive: bool = True,
    boosters: Mapping[str, float] = BOOSTERS,
    negators: tuple[str, ...] = NEGATORS,
) -> DataFrame:
    """C13-C16 with a lexicon table (entry, value) of any size, entries of several words included.

    Entries are looked up by a join: every run of as many words as the longest entry has meets the table, which Spark
    broadcasts while it is small. Of overlapping entries the leftmost counts, and at one place the longest. Repeated
    entries have the mean of their values; entries without a word are ignored. Texts are written once and stay in their rows.
    """
    key, entry = "__text_row", F.array_join(F.array_remove(F.split(F.lower("entry"), WORD_BREAK), ""), " ")
    table = lexicon.select(entry.alias("gram"), F.col("value").cast("double").alias("value")).filter("gram != '' and value is not null")
    table = freeze(table.groupBy("gram").agg(F.avg("value").alias("value")))
    longest = table.agg(F.max(F.size(F.split("gram", " ")))).first()[0] or 0  # one number
    words = F.array_remove(F.split(F.coalesce(F.col(text_column), F.lit("")), WORD_BREAK), "")
    rows = freeze(df.withColumn(key, F.monotonically_increasing_id()).withColumn("__words", words))

    def grams(word: Column, place: Column) -> Column:
        longer = (
            F.struct(F.lit(n).alias("n"), F.when(place + n <= F.size("__words"), F.array_join(F.slice("__words", place + 1, n), " ")).alias("gram"))
            for n in range(2, longest + 1)
        )
        return F.array(F.struct(F.lit(1).alias("n"), word.alias("gram")), *longer)

    # Runs are made inside the row: an exploded row does not carry its text's words.
    runs = rows.select(key, F.posexplode("__words" if longest == 1 else F.transform("__words", grams)).alias("place", "at"))
    singles = runs.select(key, "place", F.lit(1).alias("n"), F.col("at").alias("gram")) if longest == 1 else runs.select(key, "place", F.inline("at"))
    found = (
        singles.filter("gram is not null").join(table, "gram")
        .groupBy(key).agg(F.collect_list(F.struct("place", (-F.col("n")).alias("minus"), "value")).alias("__hits"))
    ) if longest else None
    kind = "array<struct<place:int,minus:int,value:double>>"
    joined = rows.withColumn("__hits", F.lit(None).cast(kind)) if found is None else rows.join(found, key, "left")
    hits = F.coalesce(F.col("__hits"), F.array().cast(kind))
    score = _compound_of_hits(F.coalesce(F.col(text_column), F.lit("")), F.col("__words"), hits, boosters, negators)
    scored = joined.withColumn("sentiment_compound", score).drop(key, "__words", "__hits")
    label = label_inclusive(F.col("sentiment_compound")) if inclusive else label_strict(F.col("sentiment_compound"))
    return scored.withColumns({"sentiment_label": label, "sentiment_polarity": F.col("sentiment_compound")})


def label_strict(score: Column, cut: float = CUT) -> Column:
    """C14: strict cuts, as at load time."""
    return F.when(score > cut, "positive").when(score < -cut, "negative").otherwise("neutral")


def label_inclusive(score: Column, cut: float = CUT) -> Column:
    """Inclusive cuts; the job's final label."""
    return F.when(score >= cut, "positive").when(score <= -cut, "negative").otherwise("neutral")


def with_sentiment(
    df: DataFrame, text_column: str = "text_cleaned", inclusive: bool = True, **rules
) -> DataFrame:
    """Compound score, label and the ``sentiment_polarity`` alias."""
    if text_column not in df.columns:
        return df
    scored = df.withColumn("sentiment_compound", sentiment_compound(F.col(text_column), **rules))
    score = F.col("sentiment_compound")
    label = label_inclusive(score) if inclusive else label_strict(score)
    return scored.withColumns({"sentiment_label": label, "sentiment_polarity": score})
