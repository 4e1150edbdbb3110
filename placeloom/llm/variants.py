"""Spelling variant grouping: PartEnum signatures of letter multisets, joined and verified, then forms followed to their root."""
from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

from placeloom.llm.store import stored
from placeloom.session import broadcast_measured

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"


def word_counts(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None, least_chars: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, of at least `least_chars` code points, seen at least `least_count` times.

    `edit(word, doc_id)` may change a lower-cased run before it is counted; it must not make it longer. Counts are combined in the map tasks."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS + f"{{{least_chars},}}"), F.lit(0))).alias("r"))
    # Only A-Z: `lower` would change accented letters too.
    lowered = F.when(F.octet_length("r") == F.char_length("r"), F.lower("r")).otherwise(F.translate("r", UPPER, LOWER))
    words = runs.select("doc_id", lowered.alias("w"))
    if edit:
        words = words.select(edit(F.col("w"), F.col("doc_id")).alias("w")).filter(F.char_length("w") >= least_chars)
    return words.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def signatures(words: DataFrame, partitions: int = 4, segments: int = 3, distance: int = 2) -> DataFrame:
    """(key, word, later): PartEnum signatures. Words one edit apart share one.

    A word's letters with their occurrence numbers are the ones of a binary vector; one edit changes at most `distance` places of it. The places are dealt to
    `partitions` parts by hash, and for each choice of all but `distance` parts the vector over them is a signature: one of them is untouched.
    An edit also touches one only of `segments` pieces of a word, so each signature is taken with the letters before and behind each piece.
    Where the pieces lie follows the shorter word's length t: a word stands in for it as itself (`later` 0) and as the longer one of t + 1 (1)."""
    letters = words.withColumn("_c", F.array_sort(F.split("word", "")))
    ones = letters.withColumn("_e", F.transform("_c", lambda c, i: F.xxhash64(c, i - F.array_position("_c", c))))
    part = lambda j: F.aggregate(F.filter("_e", lambda e: F.pmod(e, F.lit(partitions)) == j), F.lit(0).cast("long"), lambda a, e: a.bitwiseXOR(e))
    parts = ones.select("word", F.char_length("word").alias("_n"), *[part(j).alias(f"_p{j}") for j in range(partitions)])
    cuts = []
    for later in (0, 1):
        t = F.col("_n") - later
        for j in range(segments):
            head = F.floor(t * j / segments).cast("int")
            tail = t - F.floor(t * (j + 1) / segments).cast("int")
            ends = F.xxhash64(t, F.lit(j), F.substring("word", F.lit(1), head), F.when(tail > 0, F.substring("word", F.col("_n") - tail + 1, tail)).otherwise(""))
            cuts.append((later, j, ends.alias(f"_s{later}_{j}")))
    cut = parts.select("word", *[f"_p{j}" for j in range(partitions)], *[c for *_, c in cuts])
    keys = [F.struct(F.xxhash64(F.lit(k), F.col(f"_s{later}_{j}"), *[F.col(f"_p{p}") for p in chosen]).alias("key"), F.lit(later).alias("later"))
            for k, chosen in enumerate(combinations(range(partitions), partitions - distance)) for later, j, _ in cuts]
    return cut.select("word", F.explode(F.array(*keys)).alias("_k")).select("_k.key", "word", "_k.later")


def near_words(words: DataFrame, partitions: int = 4, segments: int = 3) -> DataFrame:
    """(a, b), each pair once: words of `words(word)` that differ by exactly one inserted, deleted or replaced code point."""
    broadcast_measured(words.sparkSession)  # a plan takes the signatures for as small as the words
    entries = signatures(words, partitions, segments)
    left = entries.filter("later = 0").select("key", F.col("word").alias("a"))
    right = entries.select("key", F.col("word").alias("b"), "later")
    met = left.join(right, "key").filter(((F.col("later") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()


def spelling_variants(words: DataFrame, ratio: int = 5, partitions: int = 4, segments: int = 3) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for `words(word, n)`, each word once.

    `form` is the near word of largest n, ties to the smallest in code-point order, if that n is at least `ratio` times the word's; `root` is
    where forms lead. Since n grows by `ratio` with each form, a chain is short, and halving it in each round takes a number of rounds that
    follows from the largest n.

    Words of fewer than 3 letters are met like others; an empty table gives no rows; NULL words are ignored."""
    broadcast_measured(words.sparkSession)
    words = stored(words.filter("word IS NOT NULL").select("word", "n"), "words")
    pairs = stored(near_words(words.select("word"), partitions, segments), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    told = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = told.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("b"))
    joined = words.join(best, "word", "left")
    fits = -F.col("b.m") >= ratio * F.col("n")
    forms = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("b.other")).alias("form"), F.when(fits, -F.col("b.m")).alias("form_n")), "forms")
    top = forms.agg(F.max("n")).first()[0] or 1
    step = stored(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    # A chain has at most log(top) / log(ratio) links; each round doubles how far `root` looks.
    for _ in range(ceil(log2(max(2, log2(max(2, top)) / log2(max(2, ratio)) + 1)))):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return forms.join(step, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
