"""Registered queries of this subpackage: each applies one operator, with production parameters, to a whole table."""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placeloom.llm import decontaminate, jaccard, katz, licences, lines, multi_index, packing, planes, quality, runs, shards, sql, store, tokens, toxicity, variants
from placeloom.llm.blobs import column
from placeloom.session import tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return store.settled(tune(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def with_crc(df: DataFrame) -> DataFrame:
    """`df` with the unsigned crc32 of its binary column `ids` in that column's place, as ids_crc32."""
    rest = df.select(*[c for c in df.columns if c != "ids"], "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array([zlib.crc32(x) for x in column(batch, "ids")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], crc], names=[*batch.schema.names[:-1], "ids_crc32"])

    return rest.mapInArrow(run, rest.drop("ids").schema.add("ids_crc32", "long"))


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokens.vocabulary())
    return packing.place(with_crc(pieces)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op6_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store.new_path(spark, "ids")
    planes.write_ids(table(spark, sf_dir, "documents"), folder, tokens.vocabulary())
    return with_crc(planes.read_ids(spark, folder))


def op7_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_row")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.contiguous_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licence_matches(table(spark, sf_dir, "documents"))
    starts, named = F.transform("places", lambda p: p["start"]), lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(x, lambda m: m["label"]) for x in c]))), ",")
    score = F.when(F.size("accepted") > 0, 1.0).when(F.size("places") > 0, 0.5).otherwise(0.0)
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        named("places").alias("base_labels"), named("places", "accepted").alias("labels"), score.alias("score"))


def one_letter_less(word: Column, doc_id: Column) -> Column:
    """`word`, without one letter where 199 divides the crc32 of `<doc_id>:<word>`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.word_counts(table(spark, sf_dir, "documents"), one_letter_less)
    return variants.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in documents whose crc32(doc_id) ends in 0, words from a place on repeat with a period; both follow from the crc32."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("_h"), F.floor(h / 10).cast("long").alias("_g"))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    rows = rows.withColumn("_n", F.when(F.size("_w") > 0, F.size("_w"))).withColumn("_a", F.col("_g") % F.col("_n"))
    rows = rows.withColumn("_p", F.floor((F.col("_n") - F.col("_a")) / (F.col("_g") % 8 + 3)) + 1)
    place = lambda i: F.when(i < F.col("_a"), i.cast("long")).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")
    looped = F.array_join(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_w", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("_n").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_loops(table(spark, sf_dir, "documents")))
    none = F.expr("CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)")
    # Fractions compared exactly; of equal ones the first in order stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.floor(F.col("b.length") * 1000 / F.col("b.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_katz_backoff, op2_multi_index, op3_jaccard_join, op4_best_fit_packing, op5_line_dedup, op6_bit_planes, op7_factorization_machine, op8_decontamination, op9_quality, op10_minimax_shards,
                                   op11_license_templates, op12_spelling_variants, op13_periodic_runs)}

ORACLES: dict[str, str] = {"op11_license_templates": sql.OP11, "op12_spelling_variants": sql.OP12, "op13_periodic_runs": sql.OP13}
