"""The pipeline against the brute-force versions of its stages, each on the stage's own input."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_rules_and_lines import dedup_lines
from tests.llm.test_sharding_packing import brute_ids
from tests.llm.test_simhash import brute_components, brute_fingerprint
from vigil.llm import quality_classifier
from vigil.llm.common import fold

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert all(s.count() > 100 for s in stages[:-1])


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality_classifier.classify(stages[0], labels, fold("doc_id", 5, 0)).filter("predicted = 1").select("doc_id")
    assert sorted(rows(stages[1])) == sorted(rows(stages[0].join(good, "doc_id", "left_semi")))


def test_line_dedup_stage(stages):
    want = sorted((a, t) for a, t, *_ in dedup_lines(rows(stages[1]), 10))
    assert sorted(rows(stages[2])) == want
    assert stages[2].filter(F.length("text") != F.col("n_chars")).count() == 0


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    before = sorted(rows(stages[2]))
    comp = brute_components([brute_fingerprint(t) for _, t in before], 4)
    assert sorted(rows(stages[3])) == [before[i] for i in range(len(before)) if comp[i] == i]


def test_decontamination_stage(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {r[0] for r in brute_contamination(rows(stages[3]), items, 13, 0) if r[5]}
    assert sorted(rows(stages[4])) == sorted(r for r in rows(stages[3]) if r[0] not in dirty)
    assert dirty


def test_packing_stage_holds_every_id_once(stages):
    pieces = defaultdict(list)
    for x in stages[5].collect():
        pieces[x["doc_id"]].append(x)
    for doc, ids in brute_ids(rows(stages[4])):
        at = 0
        for x in sorted(pieces.pop(doc), key=lambda x: x["start"]):
            assert x["start"] == at and x["ids_crc32"] == zlib.crc32(np.array(ids[at: at + x["length"]], "<u4").tobytes())
            at += x["length"]
        assert at == len(ids)
    assert not pieces


def test_stages_take_empty_tables_and_odd_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, n_lines int, root string, `a b.c` double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
    some = spark.createDataFrame([(1, "one two three", 1), (1, "one two three", 1), (None, None, 2), (2, "other words here", 3), (None, "x y z", 4)],
                                 "doc_id long, text string, n_lines int")
    assert corpus_pipeline.lines(spark, some, SF).count() == 5
    assert sorted(map(str, rows(corpus_pipeline.near_duplicates(spark, some, SF)))) == sorted(map(str, [(1, "one two three"), (None, None), (2, "other words here"), (None, "x y z")]))


def test_decontamination_stage_removes_rows_not_ids(spark):
    dirty = spark.read.parquet(f"{SF}/benchmark.parquet").filter(F.size(F.split("text", " ")) >= 13).first()["text"]
    some = spark.createDataFrame([(None, dirty), (None, "clean text"), (7, dirty), (7, "other clean text"), (7, dirty), (8, None), (None, None)], "doc_id long, text string")
    got = rows(corpus_pipeline.decontaminated(spark, some, SF))
    assert sorted(map(str, got)) == sorted(map(str, [(None, "clean text"), (7, "other clean text"), (8, None), (None, None)]))


CLASHING = ("doc_id long, text string, n_lines string, n_dropped int, _dirty boolean, dirty int, key string, row long, rest int, _row int, x array<int>, "
            "held_out string, fp long, root string, _rest int, _id int, `a b.c` double, n_chars int")


def test_every_stage_keeps_columns_of_any_name(spark):
    long = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, None if i == 4 else f"{long} number {i} {'abcdefgh'[i] * 9}\nand so on with line {i}", f"a{i}", i, i % 2 == 0, i + 1, f"k{i}", 10 * i, -i, i, [i],
                                   f"h{i}", i, f"r{i}", i, i, i / 2, 7) for i in range(8)], CLASHING)
    before = {r["doc_id"]: r.asDict() for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        got = out.collect()
        assert got, name
        for r in got:
            own = dict(before[r["doc_id"]])
            if name == "line_dedup":
                own |= {"text": own["text"] or "", "n_chars": len(own["text"] or "")}
            assert r.asDict() == own, name


def test_quality_stage_without_labels_of_both_kinds(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    assert sorted(map(str, rows(corpus_pipeline.quality(spark, docs, str(tmp_path))))) == sorted(map(str, rows(docs)))
