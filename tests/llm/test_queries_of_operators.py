"""Each registered query, run over a small folder of tables with null, empty, long, repeated and shared rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from catalith.llm import queries
from tests.llm.test_table_operators import linked, repeats

COLUMNS = {
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"], "op3_quality": ["doc_id", "held_out", "score", "predicted"],
    "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "op5_url_rules": ["page_id", "host", "path", "rule", "verdict"],
    "op6_ngram_join": ["doc_id", "n_shingles", "component_id"], "op7_fingerprint": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op8_html_extract": ["page_id", "url", "text", "n_chars"], "op9_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def write(spark, at, docs, pages, items, labels):
    text = F.col("text")
    spark.createDataFrame(docs, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length(text).cast("long")}).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    words = ["".join(rng.choice(list("abcdefghijklm"), rng.integers(3, 9))) for _ in range(800)]
    texts = [" ".join(rng.choice(words, rng.integers(5, 90))) for _ in range(60)]
    texts += [None, "", " ", texts[3], texts[3] + " again", "é" * 300, " ".join(rng.choice(words, 6000)), "<|endoftext|> as text", texts[5] + texts[6], None]
    item = " ".join(rng.choice(words, 30))
    texts += [f"{texts[7]} {item}"]
    pages = [(0, "http://a.example.com/en/x?q", "<article><p>Some words of text here</p></article>"), (1, None, None), (2, "x", ""), (2, "https://B.net/es/", "<p>hi")]
    return write(spark, tmp_path_factory.mktemp("tables"), list(enumerate(texts)), pages, [(0, item), (None, "a b")], [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(60)]), texts


def test_columns_and_whole_results(spark, folder):
    at, texts = folder
    made = {name: __spark_entry__.queries()[name](spark, at) for name in COLUMNS}
    for name, df in made.items():
        assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    n = len(texts)
    for name in ("op2_toxicity", "op3_quality"):
        rows = made[name].collect()
        folds, held, least = (5, 0, 0.5) if name == "op2_toxicity" else (4, 2, 0.7)
        assert sorted(r["doc_id"] for r in rows) == list(range(n))
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= least) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in rows)
    shards = made["op4_sharding"].collect()
    for s in range(8):
        assert sorted(r["slot"] for r in shards if r["shard"] == s) == list(range((n - s + 7) // 8))
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in shards)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in made["op6_ngram_join"].collect()} == linked(texts)
    import hashlib

    want = {i: (b, g, s, hashlib.sha256(k).hexdigest()) for i, (b, g, s, k) in repeats(texts).items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in made["op9_suffix_dedup"].collect()} == want
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in made["op8_html_extract"].collect()) == [(0, "Some words of text here", 23), (1, "", 0), (2, "", 0), (2, "hi", 2)]
    assert {(r["doc_id"], r["item_id"]) for r in __spark_entry__.queries()["op1_decontaminate"](spark, at).collect()} == {(n - 1, 0)}
    assert sorted(r["doc_id"] for r in made["op7_fingerprint"].collect()) == list(range(n))


def test_packed_ids_are_the_tokenizers(spark, folder):
    tokenizers, (at, texts) = pytest.importorskip("tokenizers"), folder
    own = tokenizers.Tokenizer.from_file(queries.vocabulary())
    rows = __spark_entry__.queries()["op10_packing"](spark, at).collect()
    for i, t in enumerate(texts):
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["start"] for r in mine] == np.cumsum([0, *[r["length"] for r in mine]])[:-1].tolist() and sum(r["length"] for r in mine) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) and r["offset"] + r["length"] <= 1024 for r in mine)


def test_empty_tables_give_no_rows(spark, tmp_path):
    at = write(spark, tmp_path, [], [], [], [])
    for name in ("op1_decontaminate", *COLUMNS, "pipeline"):
        assert __spark_entry__.queries()[name](spark, at).count() == 0
