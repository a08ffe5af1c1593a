"""Text expressions: cleaning, word counts, normalising, tokens, lemmas and tags."""

from __future__ import annotations

import json
import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.runtime import fits, freeze
from townsquare.schema import TECHNOLOGY_DOMAINS

# The characters counted as white space in Unicode text. Spelled out because the
# JVM's \s is ASCII only; the ones up to 255 stand apart because the regex engine tests a class of
# single such characters with one table look-up, which is what keeps the scans below fast.
LATIN_SPACE = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
OTHER_SPACE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = LATIN_SPACE + OTHER_SPACE

LETTERS = string.ascii_lowercase
# Characters that cleaned (lower-case) text keeps besides white space.
KEPT = LETTERS + string.digits + "áéíóúñü¿?¡!.,;:"

# English stop words, in the form they have once apostrophes are gone.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom this
    that these those am is are was were be been being have has had having do does did doing a an
    the and but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very s t can will just don should now d ll m o re ve y ain aren
    couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Fused words that the tokeniser splits in two, as (first part, second part).
FUSED_WORDS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)

MAX_LEMMA_ROWS_IN_PLAN = 20_000
_LEMMA_BUCKETS = 512
_LEMMA_SALTS = 16


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _drop_all_but(text: Column, kept: str) -> Column:
    """Drop every character that is neither in ``kept`` nor white space."""
    return F.regexp_replace(text, rf"[^{kept}{LATIN_SPACE}](?<![{OTHER_SPACE}])", "")


def _lower_without_urls(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"(?:http|www)[^{SPACE}]+", "")


def clean_text(text: Column) -> Column:
    """Lower-case text without URLs, tags and special characters; single spaces; null → ''."""
    t = F.regexp_replace(_lower_without_urls(text), r"<[^>\n]*>", "")
    t = _drop_all_but(t, KEPT)
    # Only white space is left besides the kept characters. Single blanks are passed over.
    return F.trim(F.regexp_replace(t, rf"[^{KEPT}](?:(?<! )[^{KEPT}]*|[^{KEPT}]+)", " "))


def word_count(cleaned: Column) -> Column:
    """Words of cleaned text, which single blanks separate; '' has none."""
    return F.size(F.array_remove(F.split(F.coalesce(cleaned, F.lit("")), " "), ""))


def normalise(text: Column) -> Column:
    """Lower-case letters and white space only; URLs and tokens naming a site are dropped.

    Few texts name a site, so the others skip that scan. Where it runs, the look-behind pins a
    match to the start of a token, so long runs without white space cost linear time.
    """
    site = rf"(?<![^{SPACE}])[^{SPACE}]*\.(?:com|org)[^{SPACE}]*"
    without_sites = bind(
        _lower_without_urls(text),
        lambda t: F.when(t.contains(".com") | t.contains(".org"), F.regexp_replace(t, site, "")).otherwise(t),
    )
    return _drop_all_but(without_sites, LETTERS)


def tokens(normalised: Column, stop_words: Iterable[str] = STOP_WORDS, min_length: int = 3) -> Column:
    """C4: tokens of normalised text, without stop words and short tokens."""
    stop = sorted(set(stop_words))
    initials = "".join(sorted({first[0] for first, _ in FUSED_WORDS}))
    fused = "|".join(rf"(?<={first[0]}){first[1:]}(?={second}(?![a-z]))" for first, second in FUSED_WORDS)
    t = F.regexp_replace(normalised, rf"[^{LETTERS} ]", " ")
    t = F.regexp_replace(t, rf"([{initials}](?<![a-z][a-z])(?:{fused}))", "$1 ")
    return F.filter(F.split(t, " "), lambda token: (F.length(token) >= min_length) & ~token.isin(stop))


def token_text(text: Column) -> Column:
    """C3 + C4 joined back with single spaces (no lemmas)."""
    return F.array_join(tokens(normalise(text)), " ")


def lemmatise(
    df: DataFrame,
    token_column: str,
    lemmas: DataFrame,
    output: str = "text_tokens_clean",
    max_rows_in_plan: int = MAX_LEMMA_ROWS_IN_PLAN,
) -> DataFrame:
    """Replace each token of an array column by its lemma and re-join with spaces.

    ``lemmas(token, lemma)`` is the caller's table, one row per token; a token it lacks stays.
    A table within ``max_rows_in_plan`` travels with the plan as hash-bucketed maps, so posts are
    not shuffled. A larger one is joined: the distinct token lists are exploded, looked up with a
    shuffle join over salted tokens and put back together. Both ways give the same rows: a null
    token is left out, and of several lemmas of a token the least counts.
    """
    pairs = freeze(lemmas.select("token", "lemma").dropna().groupBy("token").agg(F.min("lemma").alias("lemma")))
    if fits(pairs, max_rows_in_plan):
        return df.withColumn(output, F.array_join(_lookup_in_plan(F.col(token_column), pairs), " "))

    lists = df.select(F.col(token_column).alias("__list")).distinct()
    keyed = lists.withColumn("__key", _list_key("__list"))
    exploded = keyed.select("__key", F.posexplode("__list").alias("__pos", "token"))
    # A hot token is dealt over as many tasks as there are salts.
    salted = exploded.withColumn("__salt", F.pmod(F.hash("__key", "__pos"), F.lit(_LEMMA_SALTS)))
    dealt = pairs.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_LEMMA_SALTS - 1))))
    looked_up = salted.join(dealt, ["token", "__salt"], "left").select(
        "__key", F.struct("__pos", F.coalesce("lemma", "token").alias("word")).alias("__at")
    )
    texts = looked_up.groupBy("__key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("__at")), lambda at: at["word"]), " ").alias(output)
    )
    keys = df.withColumn("__key", _list_key(token_column))
    joined = keys.join(texts, "__key", "left").drop("__key")
    return joined.withColumn(output, F.coalesce(output, F.when(F.col(token_column).isNotNull(), "")))


def _list_key(column: str) -> Column:
    # Of the list itself, so that lists which only look alike when joined stay apart.
    return F.sha2(F.to_json(F.struct(F.col(column).alias("l")), {"ignoreNullFields": "false"}), 256)


def _lookup_in_plan(token_array: Column, pairs: DataFrame) -> Column:
    # The table (its size was checked) becomes one constant: an array of small maps, indexed by the
    # token's hash, so that a lookup scans one bucket and not the whole table.
    def bucket(token: Column) -> Column:
        return F.pmod(F.hash(token), F.lit(_LEMMA_BUCKETS))

    slots: list[dict[str, str]] = [{} for _ in range(_LEMMA_BUCKETS)]
    for row in pairs.select("token", "lemma", bucket(F.col("token")).alias("b")).collect():
        slots[row["b"]][row["token"]] = row["lemma"]
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")
    return F.transform(
        token_array,
        lambda token: F.coalesce(F.try_element_at(F.get(table, bucket(token)), token), token),
    )


def domain_tags(text: Column, domains: Iterable[str] = TECHNOLOGY_DOMAINS) -> Column:
    """The domains whose lower-case name occurs in the text, in the order listed."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*(F.when(lowered.contains(d.lower()), F.lit(d)) for d in domains)))
