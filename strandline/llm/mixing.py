"""Mixing sources to target weights (operator 3).

Rows get hash-random keys, are range-sorted inside their source, and distributed prefix sums of their
word counts say where each source's budget ends: whole epochs first, then the rows up to the budget's
last word. Sources may hold any share of the rows; no row leaves the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.llm.order import prefix, random_key

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes (source, source_size) -> with target (double).

    Sources in code point order, null last, take the weights in turn. Together they get ``share`` of all
    words; a target stops at ``most`` times its source's size and the excess goes to the others by weight
    until none is above. That fixed point is ``min(cap, level * weight)`` with one level for all: with
    sources sorted by cap / weight, the first k are full and the level is what is left over the rest's
    weight. Over k that quotient rises until the next source stays below its cap and falls from there
    on, so the level is its maximum.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(everything) - 1) % len(weights)
    s = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(F.lit(1))
    s = s.withColumn("_full", F.coalesce(F.sum("_cap").over(up), F.lit(0.0))).withColumn("_used", F.coalesce(F.sum("_w").over(up), F.lit(0.0)))
    s = s.withColumn("_level", (F.sum("source_size").over(total) * share - F.col("_full")) / (F.sum("_w").over(total) - F.col("_used")))
    level = F.max("_level").over(total) * F.col("_w")
    return s.select("source", "source_size", F.greatest(F.least(level, F.col("_cap")), F.lit(0.0)).alias("target"))


ADDED = ("size", "source_size", "target", "taken")


def _taken(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> tuple[DataFrame, dict[str, str]]:
    """The rows with their columns numbered (so that no name clashes), and ADDED; the numbered names by the own ones."""
    names = {c: f"in{i}" for i, c in enumerate(docs.columns)}
    text, source, doc_id = (names[c] for c in ("text", "source", "doc_id"))
    sized = docs.toDF(*names.values()).withColumn("size", n_words(F.col(text)))
    by = F.coalesce(source, F.lit("")).alias("_s"), F.col(source).isNull().alias("_null")
    plan = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    plan = staged(plan)
    n_rows = plan.agg(F.sum("_n")).first()[0] or 0
    own = F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_null")
    plan = targets(plan.drop("_n"), weights, share, most).select(*own, "source_size", "target")
    rows = sized.select("*", *by, random_key(seed, doc_id, F.coalesce(F.xxhash64(text), F.lit(0))).alias("_key"))
    rows = prefix(rows, n_rows, ["_s", "_null"], F.col("_key") / F.lit(2.0**63), ["_key", doc_id, "size"], _before="size")
    rows = rows.join(plan, ["_s", "_null"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - F.col("_before")))
    return rows.select(*names.values(), "size", "source_size", "target", taken.cast("long").alias("taken")), names


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 20240601) -> DataFrame:
    """``docs`` (doc_id, text, source and any more columns) with size, source_size, target and taken.

    ``taken`` is the number of the row's words that the mix takes: as often as the source's target holds
    the whole source, and once more, or in part, for the rows before the cut. Taken words of a source add
    up to its target rounded to a word. A null or empty text has size 0 and is taken 0 times; null is a
    source of its own; rows alike in all columns count apart; an empty table gives an empty one. Columns of
    ``docs`` named like the four added give way to them; other names may be anything.
    """
    rows, names = _taken(docs, weights, share, most, seed)
    return rows.select(*[F.col(n).alias(c) for c, n in names.items() if c not in ADDED], *ADDED)


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 20240601) -> DataFrame:
    """The mix itself, with the columns of ``docs`` as they are: a row for every time that a document is taken.

    A document taken in part once keeps its first words and the white space between them; n_chars, if
    there, follows the text. Nulls, ties, repeated rows and names of columns are as for mix().
    """
    m, names = _taken(docs, weights, share, most, seed)
    text = names["text"]
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    m = m.withColumn("_whole", whole).withColumn("_part", part).where("taken > 0")
    m = m.withColumn("_copy", F.explode(F.expr("sequence(1, _whole + IF(_part > 0, 1, 0))")))
    cut = F.col("_copy") > F.col("_whole")
    words = F.slice(F.expr(rf"regexp_extract_all({text}, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0)"), 1, F.col("_part").cast("int"))
    m = m.withColumn(text, F.when(cut, F.array_join(words, "")).otherwise(F.col(text)))
    if "n_chars" in names:
        m = m.withColumn(names["n_chars"], F.length(text).cast(docs.schema["n_chars"].dataType))
    return m.select(*[F.col(n).alias(c) for c, n in names.items()])
