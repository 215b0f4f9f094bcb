"""Benchmark decontamination by spaced-seed hashing, from SQL functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import few, materialize, numbered, unique_ids

#: Token positions that a seed looks at (1); it ignores the others, where a word may be another. Every segment of LEAST equal tokens
#: that counts, in an item of any length over BRIEF, shows one of the two all its ones; a test goes through all substitutions.
MASKS = ("11101001", "1110101")
#: For items of so many tokens also these, so that no choice of substitutions that SHARE leaves open escapes all masks.
MORE = {**dict.fromkeys(range(12, 16), ("11111",)), **dict.fromkeys((10, 11), ("100001111", "100011011")), **dict.fromkeys((7, 8, 9), ("11011",)), **dict.fromkeys((5, 6), ("1011", "10101")), 4: ("1111",), 3: ("111",), 2: ("11",), 1: ("1",)}
#: Seeds of benchmark items up to which they are broadcast; more are joined by a shuffle. Both give the same rows.
MOST_SEEDS = 500_000
#: An overlap counts from so many equal tokens in a segment; in items of at most BRIEF tokens, from this share of all of them.
LEAST, BRIEF, SHARE = 13, 16, 0.8


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; none of a null or an empty text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed(words: Column, at: Column, mask: str, kind: int) -> Column:
    return F.xxhash64(F.lit(kind), *[F.get(words, at + i) for i, c in enumerate(mask) if c == "1"])


def seeds(df: DataFrame, masks: list[tuple[int, str]], keep: list[str]) -> DataFrame:
    """df's columns keep with (h, p): for each numbered mask and each position of the column words, the hash of what the mask shows."""
    least = min(len(m) for _, m in masks)
    placed = df.filter(F.size("words") >= least).select(*keep, F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("p"))
    made = F.array(*[F.when(F.size("words") - F.col("p") >= len(m), _seed(F.col("words"), F.col("p"), m, i)) for i, m in masks])
    return placed.withColumn("h", F.explode(made)).filter("h is not null")


def aligned(own: Column, item: Column) -> Column:
    """Equal tokens of the best segment when own lies upon item: an equal token scores 1, another -2."""
    equal = F.zip_with(own, item, lambda a, b: F.coalesce(a == b, F.lit(False)))
    start = F.struct(F.lit(0).alias("score"), F.lit(0).alias("equal"), F.lit(0).alias("best"), F.lit(0).alias("most"))

    def step(s: Column, e: Column) -> Column:
        score = s["score"] + F.when(e, 1).otherwise(-2)
        n = F.when(score <= 0, 0).otherwise(s["equal"] + F.when(e, 1).otherwise(0))
        return F.struct(F.greatest(score, F.lit(0)).alias("score"), n.alias("equal"), F.greatest(s["best"], score).alias("best"), F.when(score > s["best"], n).otherwise(s["most"]).alias("most"))

    return F.aggregate(equal, start, step)["most"]


def masks_for(n: int) -> tuple[str, ...]:
    """The masks that seeds of an item of n tokens are made with."""
    return MASKS if n > BRIEF else tuple(m for m in (*(MASKS if n >= 10 else ()), *MORE.get(n, ())) if len(m) <= n)


def overlaps(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and benchmark item that overlap: key, item, n_equal (equal tokens), n_item (the item's
    tokens), start (the document's token that lies upon the item's first; negative if before the text).

    Seeds of all positions of all documents are joined with those of the items; around each hit the item is laid upon the
    document. An overlap is a segment of at least 13 equal tokens, one other token allowed for two equal ones; for items of
    up to 16 tokens, 80 % equal ones of all (13 of 16), wherever the others are. Items and documents without words overlap
    with nothing. Each row is a document and each row of benchmark an item, also where keys or ids are null or shared; equal items
    each give their rows. Extra columns are ignored; an empty table gives no rows.
    """
    named = benchmark.select(F.col(item).alias("_id"), words_of(F.col(item_text)).alias("words")).filter(F.size("words") > 0).withColumn("_item", F.xxhash64("words"))
    items = named.groupBy("_item").agg(F.first("words").alias("words"))
    lengths = sorted(r[0] for r in items.filter(F.size("words") <= BRIEF).select(F.size("words")).distinct().collect())  # BRIEF values at most
    masks = list(enumerate(dict.fromkeys([*MASKS, *(m for n in lengths for m in masks_for(n))])))
    own = [(masks_for(n), F.size("words") == n) for n in lengths] + [(MASKS, F.size("words") > BRIEF)]
    sown = reduce(DataFrame.unionByName, [seeds(items.filter(which), [(i, m) for i, m in masks if m in mine], ["_item", "words"]) for mine, which in own])
    sown = sown.select("h", "_item", F.col("p").alias("_q"), F.size("words").alias("n_item"))
    tokens = items.select("_item", F.col("words").alias("_tokens"))
    rows = unique_ids(docs.select(key, text), key, text).select(F.col("_rid").alias("_doc"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    if sown.count() <= MOST_SEEDS:
        sown, tokens = F.broadcast(sown), F.broadcast(tokens)
    # A word that a text repeats has many equal seeds; they are one row for each way of laying an item on it before anything is laid.
    hits = seeds(rows.select("_doc", words_of(F.col("_text")).alias("words")), masks, ["_doc", "words"]).select("h", "_doc", "p").join(sown, "h")
    places = few(hits.select("_doc", "_item", "n_item", (F.col("p") - F.col("_q")).alias("start")).distinct())
    hit = materialize(rows.join(few(places.select("_doc").distinct()), "_doc", "left_semi").select("_doc", "_key", words_of(F.col("_text")).alias("words")))
    first = F.col("start")
    skipped = F.greatest(-first, F.lit(0))
    laid = hit.join(places, "_doc").select("_doc", "_key", "_item", "n_item", first, skipped.alias("_skip"), F.slice("words", F.greatest(first, F.lit(0)) + 1, F.col("n_item") - skipped).alias("_own"))
    laid = laid.repartition("_doc", "_item", "start").join(tokens, "_item")  # one text's places are many tasks' work
    beneath = F.slice("_tokens", F.col("_skip") + 1, F.size("_own"))
    all_equal = F.size(F.filter(F.zip_with("_own", beneath, lambda a, b: a == b), lambda e: F.coalesce(e, F.lit(False))))
    n = F.when(F.col("n_item") <= BRIEF, all_equal).otherwise(aligned(F.col("_own"), beneath))
    found = laid.select("_doc", "_key", "_item", "n_item", "start", n.alias("n_equal")).filter(F.col("n_equal") >= F.least(F.lit(LEAST), F.ceil(F.col("n_item") * SHARE)))
    best = found.groupBy("_doc", "_item").agg(F.max(F.struct("n_equal", -F.col("start"), "n_item")).alias("b"), F.first("_key").alias("_key"))
    told = best.join(named.select("_item", "_id"), "_item")
    return told.select(F.col("_key").alias(key), F.col("_id").alias(item), F.col("b.n_equal").alias("n_equal"), F.col("b.n_item").alias("n_item"), (-F.col("b.col2")).alias("start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """docs without those that overlap with a benchmark item; all columns stay as they are, whatever their names. Rows that
    share a key or have none are judged each by itself; null and empty texts stay."""
    rows = numbered(docs, key, text)
    found = overlaps(rows.select("_rid", "_text"), benchmark, key="_rid", text="_text", **names).select("_rid").distinct()
    return rows.join(few(found), "_rid", "left_anti").select("_row.*")
