"""The pipeline's stages against brute force on their own inputs."""

import itertools

import corpus_pipeline
from test_operators import covered, linked

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.orderBy("doc_id").collect() if name != "packing" else None
        docs = stage(spark, docs, SF).cache()
        tables[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
    before, after = tables["exact_dedup"]
    assert len(after) == len({r.text for r in before}) == len({r.text for r in after})
    before, after = tables["near_dedup"]
    tops = linked([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {before[i].doc_id for i, (_, top) in enumerate(tops) if top == i}
    before, after = tables["suffix_dedup"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    text = {r.doc_id: r.text for r in after}
    for r, (removed, _, _) in zip(before, covered([(r.doc_id, r.text) for r in before], 100)):
        assert 0 <= len(text[r.doc_id].encode()) - (len(r.text.encode()) - removed) <= 6 * removed / 100 + 6
        assert removed or text[r.doc_id] == r.text
    packed = sorted(tables["packing"][1], key=lambda r: (r.sequence_id, r.offset))
    assert {r.doc_id for r in packed} == set(text)
    for _, rows in itertools.groupby(packed, key=lambda r: r.sequence_id):
        assert sum(r.length for r in rows) <= 2048
