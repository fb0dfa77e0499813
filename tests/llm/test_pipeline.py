"""The pipeline: every stage's decisions against the operators' own tests' brute force, on a small corpus."""

import corpus_pipeline as cp
from shipgauge.llm.decontaminate import normalised
from test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.01"


def test_stages_keep_clean_documents_and_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = cp.keep_good(spark, docs, SF).cache()
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    wrong = sum((d in kept) != bool(q) for d, q in labels.items())
    assert wrong <= 0.02 * len(labels)

    one = cp.keep_one_of_each(spark, good, SF).cache()
    assert one.columns == docs.columns
    prints = {r.doc_id: int(brute_print(r.text), 16) for r in good.select("doc_id", "text").collect()}
    group, least = brute_groups(prints.values(), 2), {}
    for d in sorted(prints):
        least.setdefault(group[prints[d]], d)
    assert sorted(r.doc_id for r in one.collect()) == sorted(least.values())

    clean = cp.drop_contaminated(spark, one, SF).cache()
    assert clean.columns == docs.columns
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = sorted(r.doc_id for r in one.collect() if not any(i in normalised(r.text) for i in items))
    assert sorted(r.doc_id for r in clean.collect()) == want

    private = cp.replace_personal_data(spark, clean, SF).cache()
    assert private.columns == docs.columns and private.count() == clean.count()
    assert all(r.n_chars == len(r.text) for r in private.collect())
    packed = cp.pack(spark, private, SF)
    assert {r.doc_id for r in packed.collect()} == set(want)


def test_run_applies_the_stages(spark):
    rows = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and len({(r.doc_id, r.start) for r in rows}) == len(rows)


def test_nulls_repeats_and_extra_columns(spark, tmp_path):
    item = "this passage of more than forty characters is in the benchmark"
    rows = [(1, None, "x", 0), (2, "", "x", 0), (2, "", "x", 0), (3, "one two three four five", "x", 23),
            (3, "one two three four five", "x", 23), (4, f"words before {item} and after", "x", 80), (None, "mail a.b@c.org to me", "x", 20),
            (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    good = cp.keep_good(spark, docs, str(tmp_path))
    assert good.count() == 8 and good.columns == docs.columns
    one = cp.keep_one_of_each(spark, good, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in one) == [0, 1, 3, 4]  # empty texts are one group
    assert {r.doc_id for r in cp.drop_contaminated(spark, docs, str(tmp_path)).collect()} == {1, 2, 3, None}
    assert cp.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 3
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
