"""Benchmark decontamination: exact containment of item windows, found by rare prefix tokens. Built-in functions only."""
from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.llm.store import numbered, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for NULL."""
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, w): every run of `window` words of an item; an item with fewer words, but some, is one window."""
    runs = F.when(F.size("w") >= window, F.transform(F.sequence(F.lit(1), F.size("w") - (window - 1)), lambda i: F.slice("w", i, F.lit(window))))
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    return items.select("item_id", F.explode(F.coalesce(runs, F.array("w"))).alias("w"))


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, row: str | None = None, broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: ((_row, doc_id, n_words, start, length, wid), (wid, item_id)). Each document has at least one row.

    A window occurs only where its rarest word does (rarity: counts of the benchmark's words over all documents), so that word is its
    necessary prefix; position and length bound the place, and the words there are compared. Windows are broadcast up to
    `broadcast_rows` (about 200 bytes each); above it words are joined by shuffle, without the texts, which come back by row number."""
    spans = stored(item_windows(benchmark, window), "windows")
    distinct = stored(spans.select("w").distinct().withColumn("wid", F.monotonically_increasing_id()), "window_ids")
    items = spans.join(distinct, "w").select("wid", "item_id").distinct()
    small = distinct.count() <= broadcast_rows
    hint = F.broadcast if small else (lambda df: df)
    texts = numbered(docs, row).select("_row", "doc_id", words(F.col("text")).alias("w"))
    vocabulary = distinct.select(F.explode("w").alias("word")).distinct()
    counts = texts.select(F.explode("w").alias("word")).join(hint(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    ranked = distinct.select("wid", F.posexplode("w").alias("at", "word")).join(counts, "word", "left")
    rare = ranked.groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("p"))
    # A window with a word that no document has can't occur.
    probe = stored(rare.filter("p.n > 0").join(distinct, "wid").select(F.col("p.word").alias("word"), F.col("p.at").alias("at"), F.size("w").alias("length"), F.col("w").alias("v"), "wid"), "probe")
    if small:
        at = texts.withColumn("n_words", F.size("w")).select("_row", "doc_id", "n_words", "w", F.posexplode_outer("w").alias("pos", "word")).join(hint(probe), "word", "left")
        start = F.col("pos") - F.col("at")
        found = (start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.greatest("length", F.lit(1))) == F.col("v"))
        ok = F.coalesce(F.when(F.col("length").isNotNull(), found), F.lit(False))
        hits = at.select("_row", "doc_id", "n_words", "pos", ok.alias("ok"), start.alias("start"), "length", "wid").filter(F.col("ok") | F.col("pos").isNull() | (F.col("pos") == 0))
        return stored(hits.select("_row", "doc_id", "n_words", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("start", "length", "wid")]), "hits"), items
    placed = stored(texts, "texts")
    near = placed.select("_row", F.posexplode("w").alias("pos", "word")).join(probe.drop("v"), "word").select("_row", (F.col("pos") - F.col("at")).alias("start"), "length", "wid").filter("start >= 0")
    held = near.join(placed, "_row").join(distinct.withColumnRenamed("w", "v"), "wid").filter((F.col("start") + F.col("length") <= F.size("w")) & (F.slice("w", F.col("start") + 1, F.col("length")) == F.col("v")))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("length", "int"), ("wid", "long"))]
    base = placed.select("_row", "doc_id", F.size("w").alias("n_words"), *none)
    return stored(base.unionByName(held.select("_row", "doc_id", F.size("w").alias("n_words"), "start", "length", "wid")), "hits"), items


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, row: str | None = None, **limits) -> DataFrame:
    """(_row, doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document.

    A word inside any occurring window is hit. NULL and empty texts have no words and are clean; so is all when the benchmark is
    empty. Repeated rows each get their row; NULL ids stay; NULL item ids count as no item; other columns are ignored."""
    hits, items = occurrences(docs, benchmark, window, row, **limits)
    span = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    per_doc = hits.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), span))).alias("s"))
    # Length of the union of the spans, in order of their starts.
    covered = F.aggregate("s", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], x["end"]).alias("end")), lambda a: a["n"])
    named = hits.filter("wid IS NOT NULL").select("_row", "wid").distinct().join(items, "wid").groupBy("_row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("i"))
    ids = F.coalesce("i", F.array().cast("array<string>"))
    out = per_doc.withColumn("n_hit", covered.cast("long")).join(named, "_row", "left")
    return out.select("_row", "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
