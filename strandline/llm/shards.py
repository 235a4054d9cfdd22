"""Sharding by proportional stratified interleaving (operator 8).

Rows are shuffled by seed inside their source; the r-th of a source's n rows stands at (r + phase) / n
of the whole, so any stretch of that order holds every source in proportion; cutting it into equal
stretches gives shards whose row counts differ by one at most (law ``rows``) and whose mixtures match.

The seeded shuffle goes by the text, so rows of equal texts have one key: they follow each other in their
source and stand at about the same place in others, and only a group that a cut or the places' noise parts
is in two shards. Texts of very many rows are shuffled row by row, so no range of keys grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.llm.order import prefix, random_key

SHARDS = 24
#: Texts of more rows than this are not kept together.
GROUP_ROWS = 5000


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = 7919) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard: one row for each row of ``docs``.

    size: UTF-8 bytes of the text (null: none) plus 8. text_crc32: unsigned, of the UTF-8 bytes, null as
    empty. Null is a source of its own. Rows of equal texts are kept together as far as the law and GROUP_ROWS
    allow. Rows alike in all columns get a place each; an empty table gives an empty one. Every source
    has a phase of its own, so that many sources of a row or two don't meet at one place. Other columns are not
    read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_h"))
    rows = staged(rows)
    many = rows.groupBy("_h").count().where(F.col("count") > GROUP_ROWS).select("_h", F.lit(True).alias("_many"))
    key = F.when(F.col("_many"), random_key(seed, "doc_id", "_h")).otherwise(random_key(seed, "_h"))
    rows = rows.join(many, "_h", "left").select(
        "doc_id", "source", "size", "text_crc32", key.alias("_key"), F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_null")
    )
    rows = staged(rows)
    n = rows.count()
    rows = prefix(rows, n, ["_s", "_null"], F.col("_key") / F.lit(2.0**63), ["_key", "doc_id", "text_crc32", "size"], _rank="1")
    phase = random_key(seed + 1, "_s", "_null") / F.lit(2.0**63)
    rows = rows.withColumn("_place", F.least((F.col("_rank") + phase) / F.col("_rank_all"), F.lit(1 - 2.0**-53)))
    rows = prefix(rows.drop("_rank", "_rank_all"), n, [], F.col("_place"), ["_place", "_s", "_null", "_key", "doc_id"], _at="1")
    shard = F.expr(f"(_at * {shards}) div {max(n, 1)}")
    slot = F.col("_at") - F.expr(f"(_shard * {n} + {shards - 1}) div {shards}")
    return rows.withColumn("_shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 7919) -> None:
    """Write the rows of ``docs`` under ``path`` by shard, each shard in the order of its slots.

    Rows find their place by doc_id and text hash; rows alike in both share what they are, so which of
    them takes which place is of no matter, and they are numbered to keep each one.
    """
    from pyspark.sql import Window

    key = lambda: Window.partitionBy("doc_id", "text_crc32")
    placed = interleave(docs, shards, seed).select("doc_id", "text_crc32", "shard", "slot")
    placed = placed.withColumn("_nth", F.row_number().over(key().orderBy("shard", "slot")))
    rows = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn("_nth", F.row_number().over(key().orderBy("doc_id")))
    joined = rows.join(placed, (rows.doc_id.eqNullSafe(placed.doc_id)) & (rows.text_crc32 == placed.text_crc32) & (rows._nth == placed._nth))
    out = joined.select(*[rows[c] for c in docs.columns], placed.shard, placed.slot)
    out.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
