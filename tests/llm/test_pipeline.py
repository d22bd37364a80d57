"""The corpus pipeline, stage by stage, against brute force on a small table."""

import numpy as np
import pytest

import corpus_pipeline
from stratiform.llm import decontamination, secrets
from tests.llm.test_operators import ids, leaks, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The whole small tables, with one more column and a null text."""
    out = str(tmp_path_factory.mktemp("sf"))
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = d.selectExpr("*", "nullif(1, 2) AS score")
    extra.unionByName(spark.createDataFrame([(10**6, None, None, None, None, None)], extra.schema)).write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 0").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns, name
            after = {r["doc_id"]: r for r in out.collect()}
            assert set(after) <= set(before)
        if name == "quality":
            assert len(bad & set(after)) <= 0.2 * len(bad) and len(before) - len(after) <= len(bad) + 0.2 * len(before)
        elif name == "near_duplicates":
            kept = [set(zip(*(words(r["text"])[i:] for i in range(5)), strict=False)) for r in after.values()]
            assert not any(a and 100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(kept) for b in kept[:i])
        elif name == "decontamination":
            assert set(before) - set(after) == {d for d, _ in leaks([(k, r["text"]) for k, r in before.items()], items)}
        elif name == "secrets":
            assert all(r["text"] == secrets.redact_text(before[k]["text"]) for k, r in after.items()) and set(after) == set(before)
        else:
            got = {}
            for r in out.collect():
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
            assert got == {k: len(ids(r["text"], 1)) for k, r in before.items()}
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert np.isclose(docs.count(), corpus_pipeline.run(spark, folder).count())


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    assert decontamination.SIMILARITY == (75, 100)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Few rows: null ids and texts, repeats, one id with two texts, extra columns with names that operators use."""
    out = str(tmp_path_factory.mktemp("odd"))
    same = " ".join(f"word{k % 37}x{k % 11}" for k in range(120))
    rows = [(1, same), (1, same), (2, same), (3, None), (None, "a text with a null id and some words"), (None, "a text with a null id and some words"), (4, ""), (5, " \n\t"), (6, "one other text"), (6, same + " more")]
    docs = spark.createDataFrame([(*r, "en", "s", 1, "x", 2) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component string, bucket int")
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, None, None), (6, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, "nothing like this is in there"), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    near = corpus_pipeline.near_duplicates(spark, docs, odd)
    assert near.columns == docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in near.collect())
    assert ids == [(False, 1), (False, 3), (False, 4), (False, 5), (True, 0), (True, 0)]
    for name, stage in corpus_pipeline.STAGES[2:4]:
        out = stage(spark, docs, odd)
        assert out.columns == docs.columns and out.count() == 10, name
    assert corpus_pipeline.quality(spark, docs, odd).columns == docs.columns
    pieces = corpus_pipeline.packing(spark, docs, odd)
    assert pieces.where("doc_id is null").count() == 2 and pieces.select("doc_id").distinct().count() == 7
    assert corpus_pipeline.run(spark, odd).count() > 0


def test_empty_tables(spark, odd, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
