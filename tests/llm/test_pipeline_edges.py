"""The corpus pipeline on string ids, clashing columns, nulls and no rows."""

import corpus_pipeline

ITEMS = [("i1", "the quick brown fox jumps over the lazy dog and then goes home to sleep"), ("i2", None)]
SCHEMA = "doc_id string, text string, lang string, source string, n_chars long, TAKEN int, near_th_own int, line_th int"


def _tables(spark, path, docs):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def _text(words, n):
    return " ".join(f"{words}{k}" for k in range(n))


def test_string_ids_and_clashing_columns(spark, tmp_path):
    copied = _text("one", 60) + "\n" + _text("two", 5)
    docs = [("a", copied, "en", "s", 1), ("b", copied, "en", "s", 1), ("b", copied, "en", "s", 1),
            ("c", "own line here\n" + copied, "en", None, 1), ("d", ITEMS[0][1], "en", "t", 1),
            ("e", _text("three", 40), "de", "t", 1), (None, _text("four", 40), "de", None, None), ("f", None, None, None, None),
            ("g", "", "en", "s", 0)]
    sf = _tables(spark, tmp_path, [(*d, 7, 8, 9) for d in docs])
    frames, kept = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        columns = kept.columns
        kept = step(spark, kept, sf)
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = frames[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert kept.columns == columns
    text = {r["doc_id"]: r["text"] for r in frames["line_dedup"].collect()}
    assert text["a"] == copied and "b" not in text and text["c"] == "own line here"
    out = frames["mixing"].collect()
    assert {r["doc_id"] for r in out} <= {"a", "c", "e", None} and {r["near_th_own"] for r in out} == {8}
    assert [c for c in frames["mixing"].columns if c.lower() == "taken"] == ["taken"]


def test_no_documents(spark, tmp_path):
    sf = _tables(spark, tmp_path, [])
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "text", "lang"]
