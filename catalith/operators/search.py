"""Search as a job over a table of queries: lexical, by vector, fused; and its metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.operators.relations import nearest
from catalith.sources.numbering import written

K1, B = 1.2, 0.75
#: What stands between two terms.
BETWEEN = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def spaced(text: Column) -> Column:
    """The terms of a text, one space between two."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BETWEEN, " "))


def bm25(queries: DataFrame, docs: DataFrame, k: int, *, query_text: str = "text", text: str = "text", k1: float = K1, b: float = B, block_queries: int = 256, block_docs: int = 2048) -> DataFrame:
    """(query, id, score, rank): the k best documents of each query by BM25 over the queries' own terms, ties by the smaller id.

    Only postings of terms that some query has are built: document terms are filtered by the query terms before they are
    counted, so the shuffle holds what can match. idf: log(1 + (N - df + 0.5) / (df + 0.5)).

    Queries and documents are dealt into blocks by their counts, and a posting goes to the blocks of queries that have its term. A block of each
    meets in one task as a product of two matrices that keeps k rows a query, and the block winners are ranked again: a common term costs
    its postings, not its postings times its queries, and no task holds all of a term's."""
    asked, held = (max(1, -(-df.count() // size)) for df, size in ((queries, block_queries), (docs, block_docs)))
    said = queries.select("query", F.explode(F.array_distinct(terms(F.col(query_text)))).alias("term"))
    numbers = written(said.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "terms")
    own = written(said.join(numbers, "term").select("query", "t", F.pmod(F.xxhash64("query"), F.lit(asked)).cast("int").alias("_q")), "asked")
    rows = docs.select("id", terms(F.col(text)).alias("_t"))
    stats = written(rows.agg(F.count("*").alias("n"), F.avg(F.size("_t")).alias("avgdl")), "sizes")
    tf = rows.select("id", F.size("_t").alias("dl"), F.explode("_t").alias("term")).join(numbers, "term").groupBy("id", "t", "dl").agg(F.count("*").alias("tf"))
    w = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    tf = written(tf.join(F.broadcast(stats)).select("id", "t", w.alias("w")), "postings")
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    left = own.join(tf.groupBy("t").agg(F.count("*").alias("df")), "t").join(F.broadcast(stats)).select("query", "t", "_q", idf.alias("idf"))
    left = left.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(held - 1))))
    right = tf.join(own.select("t", F.col("_q").alias("_p")).distinct(), "t").withColumn("_d", F.pmod(F.xxhash64("id"), F.lit(held)).cast("int"))

    def best(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            known, col = np.unique(q["t"].to_numpy(), return_inverse=True)
            names, who = np.unique(q["query"].to_numpy(), return_inverse=True)
            share = np.zeros((len(known), len(names)))
            share[col, who] = q["idf"].to_numpy()
            ids, row = np.unique(d["id"].to_numpy(), return_inverse=True)
            order = np.argsort(row, kind="stable")
            row, at, weights = row[order], np.searchsorted(known, d["t"].to_numpy())[order], d["w"].to_numpy()[order]
            total = np.empty((len(ids), len(names)))
            step = max(1, (1 << 21) // len(known))  # documents whose weights stand in one matrix
            for i in range(0, len(ids), step):
                a, z = np.searchsorted(row, [i, i + step])
                part = np.zeros((min(step, len(ids) - i), len(known)))
                np.add.at(part, (row[a:z] - i, at[a:z]), weights[a:z])
                total[i : i + step] = part @ share
            some = total > 0
            total = np.where(some, np.round(total, 9), -np.inf)
            top = np.argsort(-total, axis=0, kind="stable")[:k]  # ids ascend, so of equal scores the smaller id is first
            for j, name in enumerate(names):
                hit = top[:, j][np.isfinite(total[top[:, j], j])]
                out.append(pd.DataFrame({"query": name, "id": ids[hit], "score": total[hit, j]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "id": [], "score": []})

    kinds = f"query {queries.schema['query'].dataType.simpleString()}, id {docs.schema['id'].dataType.simpleString()}, score double"
    local = left.groupBy("_q", "_c").cogroup(right.groupBy("_p", "_d")).applyInPandas(best, kinds).withColumn("score", F.round("score", 9))
    return local.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)


def _words(text: str) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def containing(docs: DataFrame, passages: DataFrame, *, words: int = 7) -> DataFrame:
    """(query, id): documents (id, text) that hold a passage (query, text) whole. The words after a passage's first one, seven or as
    many as it has before its last, are looked up among the documents' runs of as many words; what is found is compared whole. So a
    document meets only passages that it shares such a run with. A passage of under three words has no such run and isn't looked for
    here: containing_any looks for all."""
    own = passages.select("query", F.col("text").alias("_passage"), _words("text").alias("_w")).withColumn("_n", F.least(F.lit(words), F.size("_w") - 2)).filter("_n > 0")
    probes = own.select("query", "_passage", "_n", F.xxhash64("_n", F.slice("_w", F.lit(2), F.col("_n"))).alias("_h"))
    lengths = sorted(r[0] for r in probes.select("_n").distinct().collect())  # words values at most
    rows = docs.select("id", "text", _words("text").alias("_w"))

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.lit(n), F.slice("_w", i, n)))

    made = F.flatten(F.array(*[runs(n) for n in lengths])) if lengths else F.array().cast("array<long>")
    hits = rows.select("id", F.explode(F.array_distinct(made)).alias("_h")).join(probes.select("query", "_h", "_passage"), "_h").select("id", "query", "_passage")
    return hits.join(docs.select("id", "text"), "id").filter(F.col("text").contains(F.col("_passage"))).select("query", "id").distinct()


def _scan(asked: pa.Table, most: int = 1 << 16) -> Callable[[pa.Table | pa.RecordBatch], Iterator[pa.Table]]:
    """A function from documents (id, text) to tables (query, id) of what of asked (query, text) stands in them. Texts are bytes, so that those
    that are no UTF-8 are compared too; about most rows a table."""
    import ahocorasick

    rows: dict[bytes, list[int]] = {}
    for i, text in enumerate(asked["text"].to_pylist()):
        rows.setdefault(text, []).append(i)
    everywhere, of = rows.pop(b"", []), list(rows.values())
    automaton = ahocorasick.Automaton()
    for n, text in enumerate(rows):
        automaton.add_word(text.decode("latin-1"), n)  # a character a byte
    if of:
        automaton.make_automaton()

    def scan(docs: pa.Table | pa.RecordBatch) -> Iterator[pa.Table]:
        told = lambda q, d: pa.table({"query": asked["query"].take(pa.array(q, pa.int64())), "id": docs["id"].take(pa.array(d, pa.int64()))})
        which, where = [], []
        for row, text in enumerate(docs["text"]):
            hits = {n for _, n in automaton.iter(text.as_py().decode("latin-1"))} if of else ()
            own = everywhere + [i for n in hits for i in of[n]]
            which += own
            where += [row] * len(own)
            if len(which) >= most:
                yield told(which, where)
                which, where = [], []
        yield told(which, where)

    return scan


def containing_any(docs: DataFrame, passages: DataFrame, *, words: int = 7, list_bytes: int = 1 << 20, doc_bytes: int = 1 << 23) -> DataFrame:
    """(query, id) as containing gives them, and also of passages of under three words, empty ones among them. Such a passage may stand
    within words, so an automaton of all of them reads each document once. A list of up to list_bytes goes where the documents are read; of a
    longer one blocks of that size meet blocks of documents, in one task each two."""
    found = containing(docs, passages, words=words)
    few = passages.filter(F.size(_words("text")) < 3).select("query", F.col("text").cast("binary").alias("text"))
    size = few.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    if size is None:
        return found
    texts = docs.filter("text is not null").select("id", F.col("text").cast("binary").alias("text"))
    kinds = f"query {passages.schema['query'].dataType.simpleString()}, id {docs.schema['id'].dataType.simpleString()}"
    if size <= list_bytes:
        listed = few.toArrow()

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scan = _scan(listed)
            for batch in batches:
                for out in scan(batch):
                    yield from out.to_batches()

        short = texts.mapInArrow(read, kinds)
    else:
        asked, held = -(-size // list_bytes), max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // doc_bytes))
        left = few.withColumn("_q", F.pmod(F.xxhash64("query", "text"), F.lit(asked)).cast("int")).withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(held - 1))))
        right = texts.withColumn("_d", F.pmod(F.xxhash64("id"), F.lit(held)).cast("int")).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))
        short = left.groupBy("_q", "_d").cogroup(right.groupBy("_q", "_d")).applyInArrow(lambda a, b: pa.concat_tables(_scan(a)(b)), kinds)
    return found.unionByName(short).distinct()


def by_modality(queries: DataFrame, corpus: DataFrame, k: int, excluded: tuple[str, ...] = (), **options) -> DataFrame:
    """The k nearest inside each modality, without the excluded domains: both cuts are made before the ranking."""
    rows = corpus.filter(~F.col("domain_label").isin(*excluded)) if excluded else corpus
    return nearest(queries, rows, k, within="modality", **options)


def fuse(lexical: DataFrame, vector: DataFrame, weights: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """(query, id, similarity): each list's scores between 0 and 1 by its least and greatest of the query, then the weighted
    mean; 1.0 when all of a list's scores are the same, 0 for what a list doesn't have."""
    w = Window.partitionBy("query")

    def scaled(df: DataFrame, column: str, out: str) -> DataFrame:
        lo, hi = F.min(column).over(w), F.max(column).over(w)
        return df.select("query", "id", F.coalesce(F.try_divide(F.col(column) - lo, hi - lo), F.lit(1.0)).alias(out))

    both = scaled(lexical, "score", "_l").join(scaled(vector, "similarity", "_v"), ["query", "id"], "full")
    total = (weights[0] * F.coalesce("_l", F.lit(0.0)) + weights[1] * F.coalesce("_v", F.lit(0.0))) / sum(weights)
    return both.select("query", "id", F.round(F.least(total, F.lit(1.0)), 9).alias("similarity"))


def gate(rows: DataFrame, buckets: list[str], top: float, floor: float, on: bool = True, column: str = "similarity") -> DataFrame:
    """Empties buckets whose best result is under top, then drops results under floor."""
    if not on:
        return rows
    return rows.withColumn("_m", F.max(column).over(Window.partitionBy(*buckets))).filter((F.col("_m") >= top) & (F.col(column) >= floor)).drop("_m")


def merge(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """One row an id over all buckets, its best; order (-similarity, id)."""
    best = rows.groupBy("query", "id").agg(F.max("similarity").alias("similarity"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id")))
    return ranked.filter(F.col("rank") <= limit) if limit else ranked


def modalities(raw: str, known: tuple[str, ...] = ("text", "image", "video", "audio")) -> list[str]:
    """A list of modalities from a comma-separated one; an error names all that aren't known."""
    asked = [x.strip().lower() for x in raw.split(",") if x.strip()]
    bad = [x for x in asked if x not in known]
    if bad:
        raise ValueError(f"unknown modalities: {', '.join(bad)}")
    return asked


def metrics(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """(query, recall, precision, mrr, ndcg, nonrelevant_mean_rank, nonrelevant_exposure) of the first k of each query that has a
    relevant id; a query without results has zeros, and null where nothing non-relevant was shown."""
    r = written(relevant.select("query", "id").distinct(), "relevant")
    sizes = r.groupBy("query").agg(F.count("*").alias("n"))
    rows = ranked.select("query", "id", "rank").join(r.withColumn("_r", F.lit(1)), ["query", "id"], "left").withColumn("_hit", F.coalesce("_r", F.lit(0)))
    top = F.col("rank") <= k
    agg = rows.groupBy("query").agg(
        F.sum(F.when(top, F.col("_hit"))).alias("hits"),
        F.min(F.when(F.col("_hit") == 1, F.col("rank"))).alias("first"),
        F.sum(F.when(top, F.col("_hit") / F.log2(F.col("rank") + 1.0))).alias("dcg"),
        F.avg(F.when(F.col("_hit") == 0, F.col("rank"))).alias("mean_rank"),
        F.count_if(top & (F.col("_hit") == 0)).alias("shown"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return sizes.join(agg, "query", "left").select(
        "query", zero(F.col("hits") / F.col("n")).alias("recall"), zero(F.col("hits") / F.lit(k)).alias("precision"), zero(1 / F.col("first")).alias("mrr"),
        zero(F.round(F.col("dcg") / ideal, 9)).alias("ndcg"), F.col("mean_rank").alias("nonrelevant_mean_rank"), zero(F.col("shown") / F.lit(k)).alias("nonrelevant_exposure"),
    )
