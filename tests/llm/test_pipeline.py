from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.brute import components, shingles, similar

from tidelake.llm.tables import probable, sieve, sieve_pages, with_sieve

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def tables(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [
        ("plain words of one kind with nothing to be found in them at all", "en"),
        ("plain words of one kind with nothing to be found in them at all", None),
        ("PLAIN words of one kind with nothing to be found in them at all today", "en"),
        (f"some text before {item} and some text after it", "en"),
        ("write to jane.doe@mail.example.com or call +1 (555) 010-1234 now", "en"),
        ("12345 %%% 678", "en"), (None, "en"), ("", None),
        ("Wörter einer anderen Sprache über allerlei schöne Dinge", "de"),
    ]
    rows = [(10 * i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_in_order(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        kept[name] = sorted(r["doc_id"] for r in docs.collect())
        if name != "tokens":
            assert docs.columns == COLUMNS
    assert kept["language"] == [0, 0, 10, 20, 30, 40, 80]
    assert kept["near_duplicates"] == [0, 30, 40, 80]
    assert kept["benchmark"] == kept["personal_data"] == kept["tokens"] == [0, 40, 80]
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert texts[40]["text"] == "write to [EMAIL] or call [PHONE] now"
    assert texts[0]["text"].startswith("plain words") and texts[0]["n_tokens"] == len(texts[0]["ids"])


def test_the_run_over_given_tables(spark):
    """Each stage against a plain version of what it decides."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    result = {r["doc_id"]: r["text"] for r in corpus_pipeline.run(spark, folder).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if any(c.isalpha() for c in r["text"] or ""))
    sets = [shingles(t) for _, t in rows]
    least = components(sets, similar)
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    wanted = {
        rows[i][0]: rows[i][1]
        for i in sorted(set(least))
        if not any(item and 100 * len(item & sets[i]) >= 80 * len(item) for item in items)
    }
    assert result.keys() == wanted.keys()
    same = sum(result[i] == text for i, text in wanted.items())
    assert same >= 0.8 * len(wanted) and not any("@mail" in text for text in result.values())


def test_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.count() == 0


def test_a_text_of_another_column_is_not_touched(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").withColumn("source", F.lit("a@b.example.com"))
    assert {r["source"] for r in corpus_pipeline.personal_data(spark, docs, tables).collect()} == {"a@b.example.com"}


def test_null_and_repeated_ids_are_decided_by_row(spark, tables):
    base = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    texts = [
        (None, base), (None, base + " more"), (None, "clean text that stands alone in all of this corpus"),
        (1, other), (2, other + " more"), (2, "a different text under the same number that is linked to none"),
        (None, other + " again"), (None, base),
    ]

    def documents(rows):
        rows = [(i, t, "en", "s", len(t)) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    kept = corpus_pipeline.near_duplicates(spark, documents(texts), tables)
    assert kept.columns == COLUMNS
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sum(t in (base, base + " more") for _, t in found) == 1
    assert sorted(found, key=str)[:2] == sorted([(1, other), texts[5]], key=str)
    assert texts[2] in found and len(found) == 4

    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    mixed = [(None, f"one {item} two"), (None, "clean words"), (7, f"three {item} four"), (7, "clean words too"), (7, "clean words too")]
    clean = corpus_pipeline.benchmark(spark, documents(mixed), tables).collect()
    assert sorted(r["text"] for r in clean) == ["clean words", "clean words too", "clean words too"]


def test_without_labels_only_texts_without_letters_go(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs.withColumn("lang", F.lit(None).cast("string")), tables)
    assert kept.columns == COLUMNS
    assert sorted((r["doc_id"], r["lang"]) for r in kept.collect()) == [(i, None) for i in (0, 0, 10, 20, 30, 40, 80)]


def test_texts_that_stay_for_sure_are_not_shuffled(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, tables)
    plan = kept._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    sure = plan.children().apply(0).toString()
    assert "Aggregate" not in sure and "LeftSemi" not in sure and "strategy=broadcast" in sure


def test_a_full_sieve_changes_no_result(spark, tables, monkeypatch):
    """With all bits set every row is in the sieves, and the exact steps decide."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    wanted = sorted(map(str, corpus_pipeline.near_duplicates(spark, docs, tables).collect()))
    full = spark.range(1, 2049).select(F.col("id").alias("page"), F.unhex(F.repeat(F.lit("FF"), 4096)).alias("bits"))
    monkeypatch.setattr(corpus_pipeline, "sieve_pages", lambda hashes: full)
    assert sorted(map(str, corpus_pipeline.near_duplicates(spark, docs, tables).collect())) == wanted


def test_a_sieve_in_spark_says_what_one_in_numpy_does(spark):
    rows = spark.range(3000).select("id", F.xxhash64("id").alias("h"))
    keys = rows.filter("id % 7 = 0").select("h")
    found = with_sieve(rows, "h", sieve_pages(keys), "found")
    assert found.columns == ["id", "h", "found"]
    got = found.toPandas()
    assert (probable(sieve(keys), got["h"].to_numpy()) == got["found"]).all()
    assert 429 <= got["found"].sum() < 600
    assert not with_sieve(rows, "h", sieve_pages(keys.limit(0)), "found").filter("found").count()
