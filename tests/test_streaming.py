"""Incremental ingestion: new files only, cleaned with the batch cleaners."""

import os

from loomstar.operators.cleaning import clean_address
from loomstar.streaming.ingest import clean_arrivals


def test_clean_arrivals_picks_up_new_files_once(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, d) for d in ("in", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"id": 1, "address": "1 Road\\nTown"}\n{"id": 2, "address": null}\n')
    q = clean_arrivals(spark, src, "id LONG, address STRING", clean_address, sink, checkpoint_dir=ckpt)
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(sink).collect()] == [(1, "1 Road, Town")]
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write('{"id": 3, "address": "3 Road"}\n')
    q = clean_arrivals(spark, src, "id LONG, address STRING", clean_address, sink, checkpoint_dir=ckpt)
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, "1 Road, Town"), (3, "3 Road")]
