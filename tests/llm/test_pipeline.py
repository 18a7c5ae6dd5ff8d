"""The stages of the corpus pipeline, each against brute force on its own input."""

import brute
import corpus_pipeline
from test_documents import BENCHMARK, texts

from brevetlake.llm import langid


def test_stages(spark, tmp_path):
    rows = texts() + [(5000, "123 456"), (5001, BENCHMARK[0][1])]
    data = [(d, t, "en", f"src{d % 3}" if d % 7 else None, len(t or ""), "extra") for d, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, key string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()]
        out = stage(spark, now, str(tmp_path))
        path = str(tmp_path / f"out{k}")
        out.write.parquet(path)
        now = spark.read.parquet(path)
        if name == "mix":
            assert {r.doc_id for r in now.collect()} == {d for d, _ in before}
            break
        assert now.columns == list(corpus_pipeline.COLUMNS)
        after = {r.doc_id: r.text for r in now.collect()}
        if name == "language":
            assert set(after) == {d for d, t in before if any(c.isalpha() for c in t or "")}
        elif name == "lines":
            assert {d: brute.sha(t) for d, t in after.items()} == {d: v[2] for d, v in brute.line_dedup(before).items()}
        elif name == "near_copies":
            assert set(after) == {d for d, v in brute.near_dedup(before).items() if v[2]}
        elif name == "leaks":
            assert set(after) == {d for d, v in brute.decontaminate(before, BENCHMARK).items() if not v[4]}
    assert corpus_pipeline.run(spark, str(tmp_path)).exceptAll(now).isEmpty()


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_unlabelled_corpus(spark):
    rows = [(1, "some words"), (2, "é"), (3, "123 !?"), (4, ""), (5, None)]
    docs = spark.createDataFrame([(d, t, None, "src", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r.doc_id, r.text, r.lang) for r in corpus_pipeline.keep_languages(spark, docs, "").collect()} == {(1, "some words", None), (2, "é", None)}


def test_missing_labels_are_predicted(spark):
    samples = {"xx": "abra kadabra ", "yy": "schnell zwischen "}
    rows = [(k, samples[lang] * 3, lang) for k, lang in enumerate(list(samples) * 20)] + [(100 + k, text, None) for k, text in enumerate(samples.values())] + [(200, "12 !", None), (201, None, "xx")]
    docs = spark.createDataFrame([(d, t, lang, "src", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.lang for r in corpus_pipeline.keep_languages(spark, docs, "").collect()}
    assert found == {d: lang for d, _, lang in rows[:40]} | {100: "xx", 101: "yy"}


def test_held_out_accuracy(spark):
    docs = langid.with_fold(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    profiles = langid.learn(docs.where("not held_out"))
    found = langid.predict(docs.where("held_out").select("doc_id", "lang", "text"), profiles)
    n, right = found.selectExpr("count(*)", "sum(int(lang_pred = lang))").first()
    assert right > 0.97 * n
