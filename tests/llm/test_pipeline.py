import os

import corpus_pipeline as P

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        path = P.scratch(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0.7 * sizes[0]
    assert docs.where("n_chars <> char_length(text)").count() == 0
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[4]


def test_run_is_the_stages_in_turn(spark):
    first, again = (sorted(tuple(r)[:5] for r in P.run(spark, "/root/testdata/sf0.001").collect()) for _ in range(2))
    assert first and first == again


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []


def test_clashing_columns_stay_as_they_were(spark):
    """Columns with the names that operators and stages give their own, in any case, of other types."""
    names = ["score", "Predicted", "n_words", "N_Removed", "doc", "spans", "windows", "fp", "who", "key", "band", "leaks", "__leaks", "predicted2", "row_id", "component_id"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("*", *[f"concat('{n}-', doc_id) as `{n}`" for n in names])
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.dtypes == docs.dtypes
        rows = out.collect()
        assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names)


def test_stage_tables_are_removed(spark, monkeypatch):
    made = []
    monkeypatch.setattr(P, "scratch", lambda s, n, plain=P.scratch: made.append(plain(s, n)) or made[-1])
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 4 and not any(os.path.exists(p) for p in made)
