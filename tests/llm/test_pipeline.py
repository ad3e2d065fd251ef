"""The pipeline: stages keep columns, their decisions take effect, and planted cases come out right."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.llm.test_operators import DOCS, sentence


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_planted_cases(spark, tmp_path):
    dice = random.Random(21)
    item = sentence(dice, 30)
    rows, labels = [], []
    insult = ["scumbag", "lowlife"]
    for i in range(160):
        toxic = i % 4 == 0
        words = sentence(dice, 120).split()
        if toxic:
            words[::30] = [insult[0]] * len(words[::30])
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    clean = [i for i in range(160) if i % 4]
    copy, near, leak, toxic = 1000, 1001, 1002, 1003
    rows.append((copy, rows[1][1], "en", "src0", 0))
    words = rows[2][1].split()
    words[5] = "changed"
    rows.append((near, " ".join(words), "en", "src0", 0))
    rows.append((leak, f"{sentence(dice, 50)} {item} {sentence(dice, 50)}", "en", "src0", 0))
    rows.append((toxic, f"{sentence(dice, 30)} scumbag {sentence(dice, 30)} scumbag", "en", "src0", 0))
    rows += [(1004, None, None, None, None), (None, "no key at all", "en", "src1", 0)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    everyone = {r[0] for r in rows}
    gone = [a - b for a, b in zip([everyone, *left], left)]
    assert gone[0] == {i for i in range(160) if i % 4 == 0} | {toxic}
    assert gone[1] == {copy, near}
    assert gone[2] == {leak}
    assert gone[3] < set(clean) | {1004, None}
    final = pipeline.STAGES[-1][1](spark, docs, folder)
    assert final.count() == docs.count() and set(final.columns) == {*docs.columns, "shard"}


def test_whole_run_and_empty_tables(spark, tmp_path):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 50 and out.select(F.min("shard"), F.max("shard")).first()[1] < 16
    source = "/root/testdata/sf0.001"
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{source}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
