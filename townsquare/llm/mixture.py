"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets an exponential key divided by its quality weight. Within a source the
documents are taken in key order until the source's budget of words is met; whole passes
over the source come first, the sampled part follows.

The order is never built as a whole. The logarithm of a key, as a whole number, is its place:
a histogram of the places' upper half finds, for each source, the bucket in which the budget
ends, a histogram of the lower half goes on inside that bucket, and only the documents of one
place are ordered. Every other document is decided by comparing its place. The logarithm keeps
the buckets fine whatever the quality weights are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townsquare.llm.common import Stored

MAX_EPOCHS = 3
SOURCE_WEIGHTS = (1, 2, 3)
#: Bits of each half of a place, so buckets of a histogram: two levels tell 2^30 places apart.
PLACE_BITS = 15
#: The logarithm of a key lies within this distance of 0.
LOG_RANGE = 64.0
_WORDS = r"[^\x20\x09-\x0D]+"
_ODD = "#*$%&|<>{}[]=_~^\\"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("bigint")


def quality_of(odd: Column, size: Column) -> Column:
    """Weight in (0, 1]: 1 for prose, less for texts with many symbols a word."""
    return F.lit(1.0) / (F.lit(1.0) + odd / F.greatest(size, F.lit(1)))


def place_of(key: Column) -> Column:
    """The logarithm of a key as a whole number of twice PLACE_BITS bits; it rises with the key."""
    share = (F.log(F.greatest(key, F.lit(1e-27))) + LOG_RANGE) / (2 * LOG_RANGE)
    last = (1 << 2 * PLACE_BITS) - 1
    return F.least(F.lit(last), F.floor(share * (last + 1))).cast("bigint")


def _ends(rows: DataFrame, bucket: Column, start: Column) -> DataFrame:
    """Per source the bucket in which its budget ends, and the words before it.

    A source has 2^PLACE_BITS buckets at most, so the running sum goes over a bounded group.
    """
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("source", bucket.alias("bucket"), "budget", start.alias("start")).agg(F.sum("size").alias("words"))
        .withColumn("before", F.col("start") + F.coalesce(F.sum("words").over(along), F.lit(0)))
        .where((F.col("before") <= F.col("budget")) & (F.col("before") + F.col("words") > F.col("budget")))
        .select(F.col("source").alias("e_source"), F.col("bucket").alias("e_bucket"), F.col("before").alias("e_before"))
        .coalesce(1)
    )


def keyed(docs: DataFrame) -> DataFrame:
    """Narrow rows (doc_id, source, text_key, size, key, place); the text is read once.

    The key is a pure function of the row, so reruns and retried tasks agree.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
        size_of(text).alias("size"),
        (F.length(text) - F.length(F.translate(text, _ODD, ""))).alias("odd"),
    ).withColumn("quality", quality_of(F.coalesce("odd", F.lit(0)), F.col("size"))).drop("odd")
    draw = F.xxhash64(F.lit("mixture"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text_key")))
    uniform = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    key = -F.log(uniform) / F.col("quality")
    return rows.withColumn("key", key).withColumn("place", place_of(F.col("key"))).drop("quality")


def targets(sized: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """One row per source: its size, target, whole passes and the budget of the sampled part.

    Weights go round the sources in code point order, null last. A target stops at
    MAX_EPOCHS times its source's size; what is over is shared by weight among the others
    until none is above. In order of size over weight the stopped sources come first, so
    running sums solve it in one pass. These windows run over one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = per_source.withColumn("weight", weight.cast("double"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", MAX_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(after))
        .withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open_weight"))
        .withColumn("is_open", F.col("level") * F.col("weight") <= MAX_EPOCHS * F.col("source_size"))
    )
    # Once one source stays below its limit, all later ones do, at the same level.
    level = F.min(F.when(F.col("is_open"), F.struct(F.col("stopped").alias("s"), F.col("level").alias("v")))).over(everything)
    limit = (MAX_EPOCHS * F.col("source_size")).cast("double")
    target = F.coalesce(F.least(limit, F.col("weight") * level["v"]), limit)
    size = F.col("source_size")
    return (
        rows.withColumn("target", target)
        .withColumn("epochs", F.when(size > 0, F.least(F.lit(MAX_EPOCHS), F.floor(F.col("target") / size))).otherwise(0).cast("bigint"))
        .withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * size))
        .select("source", "source_size", "target", "epochs", "budget", "weight")
    )


def mix(docs: DataFrame, stored: Stored) -> DataFrame:
    """One row per document: doc_id, source, text_key, size, source_size, target, epochs, taken.

    ``taken`` is ``size`` times the passes that include the document: ``epochs`` whole
    passes and, for the sampled documents, one more. The document at the end of a budget
    is taken if that brings the source nearer to its target. Null or empty texts have size
    0; a null source is a source, last in order; rows of one doc_id and text (or one text,
    where doc_id is null) are tied and taken together. An empty table gives an empty
    result; other columns are ignored.
    """
    base = stored.put(keyed(docs))
    goals = stored.put(targets(base).coalesce(1))
    goal = goals.withColumnRenamed("source", "g_source")
    rows = base.join(goal, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
    upper = F.shiftright("place", PLACE_BITS)
    first = stored.put(_ends(rows, upper, F.lit(0)))
    inside = rows.join(first, F.col("source").eqNullSafe(F.col("e_source")) & (upper == F.col("e_bucket")))
    inside = stored.put(inside.select("source", "place", "key", "doc_id", "text_key", "size", "budget", "e_before"))
    ends = stored.put(_ends(inside, F.col("place"), F.col("e_before")))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "text_key")
    last_bucket = (
        inside.drop("e_before")
        .join(ends, F.col("source").eqNullSafe(F.col("e_source")) & (F.col("place") == F.col("e_bucket")))
        .groupBy("source", "key", "doc_id", "text_key", "budget", "e_before").agg(F.sum("size").alias("words"))
        .withColumn("up_to", F.col("e_before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("up_to") - F.col("words") / 2 <= F.col("budget"))
        .groupBy(F.col("source").alias("l_source"))
        .agg(F.max(F.struct("key", "doc_id", "text_key")).alias("last"))
    )
    limits = stored.put(
        ends.join(last_bucket, F.col("e_source").eqNullSafe(F.col("l_source")), "left")
        .select("e_source", "e_bucket", "last").coalesce(1)
    )
    own = F.struct("key", "doc_id", "text_key")
    sampled = F.when(F.col("e_bucket").isNull(), F.col("budget") > 0).otherwise(
        (F.col("place") < F.col("e_bucket"))
        | ((F.col("place") == F.col("e_bucket")) & F.coalesce(own <= F.col("last"), F.lit(False)))
    )
    return (
        rows.join(limits, F.col("source").eqNullSafe(F.col("e_source")), "left")
        .withColumn("copies", F.col("epochs") + F.when(sampled, 1).otherwise(0))
        .select(
            "doc_id", "source", "text_key", "size", "source_size", "target", "epochs", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, stored: Stored) -> DataFrame:
    """The documents the mix takes, with ``mix_epochs``: how many passes include each one.

    A column of that name, as in this function's own output, is replaced. Null and empty texts
    have no words: they go with the passes of their source. Equal rows are tied and go or stay
    together; a null source is a source; an empty table stays empty; other columns are kept.
    """
    wanted = (
        mix(docs, stored).where("copies > 0")
        .groupBy(F.col("doc_id").alias("__llm_doc"), F.col("source").alias("__llm_source"), F.col("text_key").alias("__llm_key"))
        .agg(F.first("copies").alias("mix_epochs"))
    )
    own = docs.withColumn("__llm_own", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("__llm_doc"))
        & F.col("source").cast("string").eqNullSafe(F.col("__llm_source"))
        & (F.col("__llm_own") == F.col("__llm_key"))
    )
    kept = [own[f"`{name}`"] for name in docs.columns if name.lower() != "mix_epochs"]
    return own.join(wanted, same).select(*kept, wanted["mix_epochs"])
