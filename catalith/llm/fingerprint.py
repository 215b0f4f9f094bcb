"""Document fingerprints: a Merkle tree over paragraphs and sections, from SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.llm.common import few, global_rank, materialize, unique_ids

#: A paragraph ends at a sentence's or a line's end, or after so many characters.
PIECE = 64
#: Neighbouring rows that find their next document in one task: ids alike but for so many low bits.
BLOCK_BITS = 8
#: Ids are ranked first where they span more than so many times their number.
SPARSE = 16


def paragraphs(text: Column) -> Column:
    """Leaves of the tree: for each paragraph, 56 bits of its hash and 8 of its length in characters (255 at most)."""
    parts = F.regexp_extract_all(text, F.lit(rf"[^.!?\n]{{1,{PIECE}}}[.!?\n]*|[.!?\n]+"), F.lit(0))
    return F.transform(parts, lambda p: F.shiftleft(F.xxhash64(p), 8).bitwiseOR(F.least(F.length(p), F.lit(255)).cast("long")))


def fingerprint(leaves: Column) -> Column:
    """root:tree. The tree lists the leaves in hexadecimal, with / behind each one that ends a section (the content says
    which: one in eight); a section's hash is that of its leaves, the root that of the sections' hashes."""
    text = F.array_join(F.transform(leaves, lambda x: F.concat(F.lpad(F.hex(x), 16, "0"), F.when(x.bitwiseAND(0x700) == 0, "/").otherwise(""))), "")
    sections = F.transform(F.array_remove(F.split(text, "/"), ""), lambda s: F.sha2(s, 256))
    return F.concat(F.sha2(F.array_join(sections, ""), 256), F.lit(":"), text)


def _weight(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(255))


def likeness(a: Column, b: Column) -> Column:
    """Twice the characters of the leaves that both have, by those of either (each leaf once): 1 for equal texts, 0 without a common paragraph."""
    both = _weight(F.array_distinct(a)) + _weight(F.array_distinct(b))
    return F.when(a == b, 1.0).otherwise(F.coalesce(F.try_divide(2.0 * _weight(F.array_intersect(a, b)), both), F.lit(1.0)))


def leaves_of(print_: Column) -> Column:
    """The leaves back from a fingerprint, as hexadecimal strings; a section is found by splitting the tree at /."""
    return F.regexp_extract_all(F.substring_index(print_, ":", -1), F.lit("[0-9A-F]{16}"), F.lit(0))


def edits(a: Column, b: Column) -> Column:
    """Where a's text differs from b's: numbers from 0 of a's paragraphs that are in no section of b and not in b. Equal
    roots give an empty list without a look at the trees."""
    own, other = leaves_of(a), leaves_of(b)
    sections = F.array_except(F.split(F.substring_index(a, ":", -1), "/"), F.split(F.substring_index(b, ":", -1), "/"))
    changed = F.regexp_extract_all(F.array_join(sections, "/"), F.lit("[0-9A-F]{16}"), F.lit(0))
    at = F.transform(own, lambda x, i: F.when(F.array_contains(changed, x) & ~F.array_contains(other, x), i))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.array().cast("array<int>")).otherwise(F.filter(at, lambda i: i.isNotNull()))


def with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text", out: str = "next_text") -> DataFrame:
    """(key, text, out): with each document the text of the next one in the order of key; the last one's next is the first.

    Texts are shuffled once, in blocks of neighbouring ids; the first text of each block also goes to the block before. Which
    texts these are is found from ids alone. Ids that lie far apart are ranked before. Null keys come first; documents that
    share a key follow by their text. An empty table gives no rows.
    """
    rows = unique_ids(docs.select(key, text), key, text).select(F.col(key), F.coalesce(text, F.lit("")).alias(text), F.col("_rid").cast("long").alias("_rid"))
    ids = rows.select("_rid")
    span = ids.agg(F.count("*").alias("n"), (F.max("_rid") - F.min("_rid")).alias("wide")).first()
    if span["n"] and not -1 < span["wide"] < SPARSE * span["n"]:
        ranks = global_rank(ids, "_rid", [], "_dense")
        rows = rows.join(ranks, "_rid").drop("_rid").withColumnRenamed("_dense", "_rid")
        ids = ranks.select(F.col("_dense").alias("_rid"))
    block = F.shiftright("_rid", BLOCK_BITS)
    blocks = materialize(ids.groupBy(block.alias("_block")).agg(F.min("_rid").alias("_rid")))
    count = blocks.count()
    ranked = global_rank(blocks, "_block", [], "_at")
    before = ranked.select(F.pmod(F.col("_at") + 1, F.lit(max(count, 1))).alias("_at"), "_block").join(ranked.select("_at", "_rid"), "_at").select("_block", "_rid")
    firsts = rows.select("_rid", F.col(text).alias("_first")).join(few(before), "_rid").select("_block", "_first")
    after = F.lead(text).over(Window.partitionBy("_block").orderBy("_rid"))
    dealt = rows.withColumn("_block", block).withColumn(out, after)
    return dealt.join(firsts, "_block").select(key, text, F.coalesce(F.col(out), F.col("_first")).alias(out))


def compare_edited(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text: the last floor(n / 2) characters give way to the first as
    many (or all) of the next document.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text counts as
    empty; an empty text has the fingerprint of no paragraph and is like other empty ones. Rows that share a key stay one
    row each.
    """
    n = F.length(text).cast("long")
    rows = with_next(docs, key=key, text=text, out="_next").withColumn("n_chars", n)
    half = F.expr("n_chars div 2").cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring(F.col(text), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("_next"), F.lit(1), half)))
    rows = rows.select(key, "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), paragraphs(F.col(text)).alias("_a"), paragraphs(F.col("_edited")).alias("_b"), paragraphs(F.col("_next")).alias("_c"))
    return rows.select(key, "n_chars", "edited_sha256", fingerprint(F.col("_a")).alias("fingerprint"), fingerprint(F.col("_b")).alias("edited_fingerprint"), likeness(F.col("_a"), F.col("_b")).alias("near_edited"), likeness(F.col("_a"), F.col("_c")).alias("near_next"))
