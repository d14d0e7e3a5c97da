import numpy as np

import corpus_pipeline


def test_pipeline_against_expected_rows(spark, tmp_path):
    """Junk, a near copy, an exact copy, a repeated line and a benchmark passage go; every other document comes out whole."""
    rng = np.random.default_rng(1)

    def prose(n=70):
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(n))

    item = prose(20)
    texts = {i: prose() for i in range(150)} | {i: " ".join(["spam"] * (40 + i % 9)) for i in range(150, 200)}
    own = prose()
    texts |= {200: texts[3] + " tail", 201: f"{texts[5]}\n{own}", 202: f"{prose(40)} {item} {prose(40)}", 203: texts[7]}
    rows = [(i, t, "en", "src0", len(t), "x") for i, t in texts.items()] + [(204, None, None, None, None, None), (205, "", "en", "src0", 0, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 150), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, documents, str(tmp_path))
    assert first.columns == documents.columns
    good = {r["doc_id"] for r in first.collect()}
    assert not good & set(range(150, 200)) and len(good & set(range(150))) > 142
    want = {i: texts.get(i) or "" for i in good - {202}}
    want |= {201: own} if {5, 201} <= good else {}
    for copy, of in ((200, 3), (203, 7)):
        if of in good:
            want.pop(copy, None)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["text"] or "" for r in rows} == want and len(rows) == len(want)
    assert all(r["lossless"] for r in rows)
    assert {3, 5, 7, 201} <= set(want)
