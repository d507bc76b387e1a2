"""Cases that earlier versions got wrong: clashing names, capped parts, short items, values with a common beginning, bare workers."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fanpulse.llm import (byte_language, decontaminate, hilbert_shards, jaccard_join, license_scan, merkle_manifest, mixing, quality_rules,
                          ranked_search, secret_scan, toxicity)

CLASH = ["n", "size", "epoch", "pieces", "__hash", "__id", "__gone", "__size", "__crc", "h", "t", "row", "key", "crc", "own_1", "score", "place", "node", "words"]
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"text number {i % 30} with some words in it and more of them {i % 30}", "en", f"s{i % 3}", 50, *range(len(CLASH))) for i in range(60)]
    rows += [(100, None, None, None, None, *range(len(CLASH))), (101, "", "en", "s1", 0, *range(len(CLASH)))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)).cache()


def test_stages_keep_all_columns(spark, clashing):
    items = spark.createDataFrame([(1, "number 7 with some words in it")], "item_id long, text string")
    lexicon = toxicity.Lexicon({" idiot ": 3.0})
    for stage, rows in (
        (lambda d: toxicity.score(d, lexicon, score_col="__toxicity").drop("__toxicity"), 62),
        (jaccard_join.representatives, 32), (lambda d: decontaminate.clean(d, items), 60), (mixing.mixed_documents, None),
        (lambda d: hilbert_shards.shard_documents(d, 4).drop("shard", "slot"), 62),
    ):
        out = stage(clashing)
        assert out.columns == clashing.columns
        got = out.collect()
        assert rows is None or len(got) == rows
        assert got and all(r[c] == i for r in got for i, c in enumerate(CLASH))


def test_operators_take_clashing_names(spark, clashing):
    items = clashing.where("doc_id < 3").withColumn("item_id", F.col("doc_id"))
    assert jaccard_join.join(clashing).count() == 62 and merkle_manifest.manifest(clashing, proofs=False).count() == 62
    assert decontaminate.contained(clashing, items).count() >= 6 and ranked_search.search(clashing, items, 2).count() == 6
    assert byte_language.predict(clashing, None).count() == secret_scan.scan(clashing).count() == 62
    assert quality_rules.op10_quality_rules is not None and license_scan.op1_license_scan is not None


def test_secret_parts_have_no_length_limit():
    key = "password = Abcdefgh1234567890"
    url = "https://host.example/" + "a" * 3000 + "?q=1"
    user = "u" * 80 + "@" + "h" * 70 + ".example.com"
    text = f"{user} {key} {url}"
    _, spans = secret_scan.scan_text(text)
    assert [text[s:e] for s, k, e in spans if secret_scan.KINDS[k] == "user"] == [user]
    assert [text[s:e] for s, k, e in spans if secret_scan.KINDS[k] == "endpoint"] == [url]
    assert secret_scan.endpoints("x://a ://b 9ab+c://d/://e 10.0.0.1:80 http://1.2.3.4/ 1.2.3.4.5") == [(12, 25), (26, 37), (38, 53)]
    secret_scan.scan_text("password = Abcdefgh1234567890 @ " + "a" * 300_000 + "." * 300_000 + " a@" + "b." * 100_000)  # linear


def test_values_with_a_common_beginning_part(spark):
    docs = spark.range(800).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.concat(F.lit("https://common-crawl.example/"), F.col("id") % 8).alias("source"), F.lit("en").alias("lang"))
    cells = hilbert_shards.text_cells(docs, "source", 5).collect()
    assert sorted(r.cell for r in cells) == [4 * i for i in range(8)] and [r.value[-1] for r in sorted(cells, key=lambda r: r.cell)] == list("01234567")
    out = hilbert_shards.shard_documents(docs, 8).groupBy("shard").agg(F.count_distinct("source").alias("n")).collect()
    assert len(out) == 8 and sum(r.n for r in out) <= 16  # a run of the curve holds few sources


def test_equal_texts_stand_together(spark):
    rows = [(i, f"text {i % 40}" if i % 2 else None if i % 20 == 0 else f"own {i}", f"l{i % 3}", f"s{i % 5}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(((r.shard, r.slot, r.text or "") for r in hilbert_shards.shard_documents(docs, 6).collect()))
    runs = [t for i, (_, _, t) in enumerate(got) if i == 0 or got[i - 1][2] != t]
    assert len(runs) == len(set(runs))  # each text is one run of places, so only a shard's end can part it


def test_empty_tables(spark, clashing):
    none, items = clashing.limit(0), spark.createDataFrame([], "item_id long, text string")
    assert mixing.mixed_documents(none).count() == jaccard_join.representatives(none).count() == hilbert_shards.shard_documents(none).count() == 0
    assert decontaminate.clean(clashing, items).count() == 62 and decontaminate.clean(none, items).count() == 0


def test_workers_need_no_copy_of_the_repository(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as E
from fanpulse.session import get_session
spark = get_session("local[2]", 2)
queries = E.queries()
for name in ("op2_mixing", "op11_ranked_search", "op12_merkle_manifest", "op13_byte_language"):
    assert queries[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
