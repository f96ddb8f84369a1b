import corpus_pipeline as C
from shelfmark.llm.common import written


def data(spark, folder):
    from tests_llm_rows import toxic_rows

    rows = [(i, t, "en", "s", len(t)) for i, t, _ in toxic_rows(160)]
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    copy = " ".join(f"c{k}" for k in range(120))
    rows += [(1000, "kept text and " + passage + " more kept text", "en", "s", 5), (1001, copy, "en", "s", 5), (1002, copy.replace("c60", "other"), "en", "s", 5),
             (1003, "a line that stands in two documents\nown words here", "en", "s", 5), (1004, "a line that stands in two documents", None, None, None), (1005, None, None, None, None),
             (1006, "", None, None, None), (None, "no id at all", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in toxic_rows(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_every_stage_takes_effect(spark, tmp_path, monkeypatch):
    import sys
    import types

    from test_filters import toxic_rows

    monkeypatch.setitem(sys.modules, "tests_llm_rows", types.SimpleNamespace(toxic_rows=toxic_rows))
    folder = f"file://{tmp_path}"
    docs = data(spark, folder)
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
    at, seen = docs, {}
    for name, stage in C.STAGES[:4]:
        at = written(stage(spark, at, folder), name)
        assert at.columns == docs.columns
        seen[name] = {r.doc_id: r for r in at.collect()}
    toxic = {i for i, _, y in toxic_rows(160) if y}
    assert len(toxic & seen["toxicity"].keys()) < 0.2 * len(toxic)
    assert {1000, 1001, 1002, 1003, 1004, 1005, 1006, None} <= seen["toxicity"].keys()
    assert 1004 not in seen["line_dedup"] and 1005 in seen["line_dedup"] and 1006 in seen["line_dedup"] and seen["line_dedup"][1003].text.count("\n") == 1
    assert 1002 not in seen["near_dedup"] and 1001 in seen["near_dedup"] and None in seen["near_dedup"]
    assert seen["decontaminate"][1000].text == "kept text and  more kept text" and seen["decontaminate"][1000].n_chars == 29
    packed = C.packing(spark, at, folder).collect()
    assert {r.doc_id for r in packed} == seen["decontaminate"].keys()
    assert C.run(spark, folder).count() == len(packed)
