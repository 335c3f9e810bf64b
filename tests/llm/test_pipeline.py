"""The corpus pipeline against brute force on a small fixture, and the registered queries."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from stationflow.llm import gam, tokens  # noqa: E402
from stationflow.llm.common import ship  # noqa: E402


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """Real documents with odd rows and an extra column, labels and items."""
    ship(spark)
    out = str(tmp_path_factory.mktemp("sf"))
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = [(9001, None, "en", "src1", None), (9002, "", "en", None, 0), (9003, "w " * 5000, None, "src2", 10000), (None, "no id " * 30, "en", "src1", 180)]
    odd += [odd[2], (9001, "tie " * 50, "en", "src1", 200)]
    rows = real.unionByName(spark.createDataFrame(odd, real.schema)).withColumn("_score", F.lit(3))
    rows.write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


def test_stages_one_by_one(spark, fixture_dir):
    docs = spark.read.parquet(f"{fixture_dir}/documents.parquet")
    from stationflow.session import materialize

    stages = dict(corpus_pipeline.STAGES)
    # quality: exactly the rows that the classifier accepts
    kept = materialize(stages["quality"](spark, docs, fixture_dir))
    assert kept.columns == docs.columns
    model = gam.fit(docs, spark.read.parquet(f"{fixture_dir}/labels.parquet"))
    scored = gam.with_score(docs, model, docs.columns, "s").filter(F.col("s") >= gam.THRESHOLD)
    assert kept.count() == scored.count() < docs.count()
    # near-duplicates: one of each group
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    lone = materialize(stages["near_dedup"](spark, kept, fixture_dir))
    assert lone.columns == docs.columns
    assert sorted((r.doc_id for r in lone.collect()), key=repr) == brute.simhash_groups(rows, representatives=True)
    # decontamination: no document with a hit
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{fixture_dir}/benchmark.parquet").collect()]
    clean = materialize(stages["decontaminate"](spark, lone, fixture_dir))
    assert clean.columns == docs.columns
    expected = [i for i, *_, bad in brute.contamination([(r.doc_id, r.text) for r in lone.collect()], items) if not bad]
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(expected, key=repr)
    # mixing: the targets, in words
    target, _ = brute.mix_targets([(r.source, len(brute.words(r.text))) for r in clean.collect()])
    mixed = materialize(stages["mix"](spark, clean, fixture_dir))
    assert mixed.columns == docs.columns
    got = {s: 0 for s in target}
    for r in mixed.collect():
        got[r.source] += len(brute.words(r.text))
    assert all(abs(got[s] - target[s]) <= 1 for s in target)
    # token files: the library's ids, end to end
    e = tokens.Encoder()
    out = stages["tokenize"](spark, mixed, fixture_dir).collect()
    ids = [[*e.library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in mixed.collect()]
    assert sorted((r.n_tokens, r.ids_crc32) for r in out) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids)


def test_run(spark, fixture_dir):
    out = corpus_pipeline.run(spark, fixture_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_pipeline_on_an_empty_table(spark, fixture_dir):
    docs = spark.read.parquet(f"{fixture_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, fixture_dir)
        assert docs.count() == 0


def test_every_operator_is_registered():
    from __spark_entry__ import oracle_sql, queries

    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(oracle_sql()) <= set(names)
