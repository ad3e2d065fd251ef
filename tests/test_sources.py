"""What the source queries write before they read it back."""

import glob
import hashlib

from corpusloom.plans import source_queries


def test_first_lines_come_from_many_sorted_files(spark, monkeypatch):
    seen = []
    checked_in = source_queries.checked_in

    def counted(rows, folder):
        seen.append(len(glob.glob(f"{folder.removeprefix('file:')}/part-*")))
        return checked_in(rows, folder)

    monkeypatch.setattr(source_queries, "checked_in", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [r.text_md5 for r in source_queries.jsonl_first_lines(spark, "/root/testdata/sf0.001").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    first = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(100).collect()
    assert sorted(got) == sorted(hashlib.md5(r.text.encode()).hexdigest() for r in first) and seen[0] > 1
