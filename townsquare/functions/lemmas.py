"""Noun lemmas by suffix rules, an exception list and the corpus's own vocabulary (C5 without a caller's table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.functions.text import lemmatise
from townsquare.runtime import freeze

# Plural endings of English nouns and what stands in their place in the singular.
NOUN_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)

# Irregular nouns, then words that only look like a plural and stay as they are.
NOUN_EXCEPTIONS = {
    "children": "child", "feet": "foot", "teeth": "tooth", "geese": "goose", "mice": "mouse", "oxen": "ox",
    "lives": "life", "wives": "wife", "knives": "knife", "criteria": "criterion", "phenomena": "phenomenon",
    "analyses": "analysis", "crises": "crisis", "theses": "thesis", "hypotheses": "hypothesis", "indices": "index",
    "matrices": "matrix", "vertices": "vertex", "bacteria": "bacterium", "nuclei": "nucleus", "stimuli": "stimulus",
    "news": "news", "series": "series", "species": "species", "perhaps": "perhaps", "always": "always",
    "mathematics": "mathematics", "physics": "physics", "politics": "politics", "economics": "economics", "ethics": "ethics",
}


def singular_candidates(token: Column) -> Column:
    """The words that the rules make of a token, as an array; none of a token in ``ss``."""
    made = (
        F.when(
            token.endswith(suffix) & (F.length(token) > len(suffix)),
            F.concat(token.substr(F.lit(1), F.length(token) - len(suffix)), F.lit(ending)),
        )
        for suffix, ending in NOUN_RULES
    )
    return F.when(token.endswith("ss"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*made)))


def noun_lemmas(df: DataFrame, token_column: str, min_count: int = 2, exceptions: DataFrame | None = None) -> DataFrame:
    """Rows (token, lemma) of the tokens that differ from their lemma.

    The vocabulary of the whole table stands in for a dictionary: what a rule makes of a token is its lemma if it occurs
    ``min_count`` times itself; of several the shortest counts, then the smallest. ``exceptions(token, lemma)`` goes before the rules, by
    default the short list of this module; of several lemmas of a token the least counts, nulls are left out, and a token
    that is its own lemma is left alone. Null lists and null tokens do not count; an empty table gives no rows.

    Words are counted map-side before their shuffle, so a hot word is one row a task; the joins that follow are over
    distinct words, by key, of any number.
    """
    spark = df.sparkSession
    counted = df.select(F.explode(token_column).alias("token")).where("token is not null")
    words = freeze(counted.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    if exceptions is None:
        exceptions = spark.createDataFrame(list(NOUN_EXCEPTIONS.items()), "token string, lemma string")
    fixed = exceptions.select("token", "lemma").dropna().groupBy("token").agg(F.min("lemma").alias("fixed"))
    dictionary = words.where(F.col("n") >= min_count).select(F.col("token").alias("lemma"))
    made = words.select("token", F.explode(singular_candidates(F.col("token"))).alias("lemma")).join(dictionary, "lemma", "left_semi")
    ruled = made.groupBy("token").agg(F.min(F.struct(F.length("lemma").alias("size"), "lemma")).alias("best"))
    chosen = words.select("token").join(ruled, "token", "left").join(fixed, "token", "left")
    return chosen.select("token", F.coalesce("fixed", "best.lemma").alias("lemma")).where("lemma <> token")


def lemmatise_nouns(
    df: DataFrame, token_column: str, output: str = "text_tokens_clean", min_count: int = 2, exceptions: DataFrame | None = None
) -> DataFrame:
    """C5 by rules: each token of an array column replaced by its lemma in ``noun_lemmas``, re-joined with spaces.

    Reads ``df`` twice, for its vocabulary and for its rows.
    """
    return lemmatise(df, token_column, noun_lemmas(df, token_column, min_count, exceptions), output)
