import brute

import corpus_pipeline
from starmill.llm import pii, quality


def test_stages_against_brute_force(spark, make, odd_rows, tmp_path):
    rows = [*odd_rows, (500, " ".join(f"mail{i}@host{i}.example.com word{i}" for i in range(30)))]
    d = make(rows)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, odd_rows[11][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good = [(i, t) for i, t in rows if not brute.quality_counts(t)[-1]]
    one = [(i, t) for (i, t), (_, _, c) in zip(good, brute.jaccard_components(good), strict=True) if i == c]
    clean = [(i, t) for (i, t), r in zip(one, brute.contamination(one, items), strict=True) if not r[-1]]
    hidden = [(i, pii.rewrite(t, pii.Surrogates())[0]) for i, t in clean]
    docs, want = d, [good, one, clean, hidden]
    for (_, stage), rows_left in zip(corpus_pipeline.STAGES, want, strict=False):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == d.columns
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(rows_left)
    ids = dict(zip([i for i, _ in hidden], brute.ids_of([t for _, t in hidden]), strict=True))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(ids)
    for r in packed:
        assert brute.crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
    assert len(corpus_pipeline.STAGES) == 5 and quality.WINDOW == 8
