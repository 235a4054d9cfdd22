"""The subpackage's registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import ann, jaccard, langid, licenses, linededup, mixing, neardup, packing, pii, quotes, repair, shards, sql, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.harmonic_packing(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "doc_row")


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")


def op4_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"))


def op6_personal_data_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.train(pii.labelled_table(spark)))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = [*[number(k) for k in pii.BASE_KINDS], F.sha2(listed("base"), 256).alias("base_sha256")]
    return found.select("doc_id", *base, listed("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, model = langid.fit(docs.where(~langid.held_out()))
    rows = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.predict(rows, langs, model).select("doc_id", "held_out", "lang_pred", "score", F.to_json("proportions").alias("proportions"))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.interleave(table(spark, sf_dir, "documents"))


def op9_jaccard_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), width=4, percent=85)


def op10_collision_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    explained = F.array(*[F.lit(v).cast("double") for v in model.explained])
    out = whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_c", "whitened"))
    return out.select(
        "vec_id",
        (F.col("_c") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(explained, "_c").cast("double").alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of the contract's damaged conversations; a dropped row has no copy."""
    at = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    what = F.crc32(at) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(what == 1, "").when(what == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(what == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"))


def op13_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(damaged(table(spark, sf_dir, "conversations")), F.col("copies"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_harmonic_packing,
        op2_quotation_linking,
        op3_mix_sources,
        op4_license_diagonals,
        op5_forest_neighbours,
        op6_personal_data_crf,
        op7_language_mixture,
        op8_interleaved_shards,
        op9_jaccard_partenum,
        op10_collision_neardup,
        op11_jacobi_davidson_whitening,
        op12_line_runs,
        op13_glr_repair,
    )
}

#: The others depend on hashes, models or a tokenizer that SQL lacks; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_quotation_linking": sql.QUOTES,
    "op4_license_diagonals": sql.LICENSES,
    "op9_jaccard_partenum": sql.JACCARD,
    "op10_collision_neardup": sql.NEAR_VECTORS,
    "op12_line_runs": sql.LINES,
}
