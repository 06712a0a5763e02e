"""Readers and writers on files of their own."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.operators import ledger
from gristmill.sources import readers, writers


def test_corpus_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "one"), (2, "two, too")], "doc_id bigint, text string")
    df.write.json(str(tmp_path / "j"))
    df.write.csv(str(tmp_path / "c"), header=True)
    df.select("text").write.text(str(tmp_path / "t"))
    want = {"one", "two, too"}
    assert {r.text for r in readers.read_corpus(spark, str(tmp_path / "j"), "json").collect()} == want
    assert {r.text for r in readers.read_corpus(spark, str(tmp_path / "c"), "csv", header=True).collect()} == want
    assert {r.value for r in readers.read_corpus(spark, str(tmp_path / "t"), "text").collect()} == want


def test_token_records_round_trip(spark, tmp_path):
    df = spark.range(1000).select("id", F.array(*[(F.col("id") * k).cast("int") for k in range(3)]).alias("input_ids"))
    writers.write_token_records(df, str(tmp_path / "r"), 3, order="id")
    back = readers.read_token_records(spark, str(tmp_path / "r"), 3)
    assert [r.input_ids for r in back.orderBy("record_no").collect()] == [[0, i, 2 * i] for i in range(1000)]


def test_plain_int32_file_and_partial_record(spark, tmp_path):
    np.arange(12, dtype="<i4").tofile(tmp_path / "train.bin")
    got = readers.read_token_records(spark, str(tmp_path / "train.bin"), 4).orderBy("record_no").collect()
    assert [r.input_ids for r in got] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]
    with pytest.raises(Exception, match="no whole number of records"):
        readers.read_token_records(spark, str(tmp_path / "train.bin"), 5).collect()


def test_records_of_a_wrong_length_are_refused(spark, tmp_path):
    df = spark.createDataFrame([([1, 2],)], "input_ids array<int>")
    with pytest.raises(Exception, match="exactly 3 ids"):
        writers.write_token_records(df, str(tmp_path / "r"), 3)


def test_leftover_files_of_lost_tasks_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([([1, 2],)], "input_ids array<int>")
    writers.write_token_records(df, str(tmp_path / "r"), 2)
    np.arange(2, dtype="<i4").tofile(tmp_path / "r" / "part-000009-77.bin")
    assert readers.read_token_records(spark, str(tmp_path / "r"), 2).count() == 1


def test_vocab_and_merge_files(spark, tmp_path):
    (tmp_path / "v.tsv").write_text("a\t5\nno tab\nb\tc\t9\na\t7\n")
    vocab = {r.token: r.id for r in readers.read_vocab_tsv(spark, str(tmp_path / "v.tsv")).collect()}
    assert vocab == {"a": 7, "b": None}
    (tmp_path / "m.tsv").write_text("1\t2\t3\nbad line\n4 5 6\n1 2 9\n")
    merges = {(r.left_id, r.right_id): (r.id, r.priority) for r in readers.read_merges_tsv(spark, str(tmp_path / "m.tsv")).collect()}
    assert merges == {(1, 2): (9, 2), (4, 5): (6, 1)}
    (tmp_path / "big.tsv").write_text("99999999999 1 2\n1 2 3\n")
    assert [tuple(r) for r in readers.read_merges_tsv(spark, str(tmp_path / "big.tsv")).collect()] == [(1, 2, 3, 0)]
    b64 = lambda b: base64.b64encode(b).decode()
    (tmp_path / "v.json").write_text(json.dumps({"0": b64(b"\xff"), "1": b64(b"ab")}))
    assert {r.id: bytes(r.token) for r in readers.read_vocab_json(spark, str(tmp_path / "v.json")).collect()} == {0: b"\xff", 1: b"ab"}
    (tmp_path / "m.json").write_text(json.dumps({f"{b64(b'a')}|{b64(b'b')}": 260}))
    assert [(bytes(r.left), bytes(r.right), r.id) for r in readers.read_merges_json(spark, str(tmp_path / "m.json")).collect()] == [(b"a", b"b", 260)]


def test_ledger_documents(spark, tmp_path):
    good = {"tenant": "t", "monthly_budget": 30.0, "history": [{"timestamp": "2024-01-01T00:00:00", "cost_usd": 2.5, "phase": None}]}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "b.json").write_text("{not json")
    records = readers.ledger_records(readers.read_ledger(spark, str(tmp_path), "spend"), "spend").collect()
    assert [(r.tenant, r.cost_usd, r.phase) for r in records] == [("t", 2.5, None)]


@pytest.mark.parametrize("kind", sorted(readers.LEDGERS))
def test_every_ledger_schema_reads(spark, tmp_path, kind):
    (tmp_path / "x.json").write_text("{}")
    assert readers.read_ledger(spark, str(tmp_path), kind).count() == 1


def test_checkpoint_listing(spark, tmp_path):
    for name in ("run1/checkpoint_step_100.pt", "run1/checkpoint_step_20.pt", "run1/checkpoint_step_final.pt", "run2/best_model_v3.pt", "run2/x.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"12345")
    files = readers.list_files(spark, str(tmp_path))
    assert files.columns == ["path", "modificationTime", "length"]
    found = ledger.parse_inventory(files)
    assert {(r.run_id, r.step, r.length) for r in found.collect()} == {("run1", 100, 5), ("run1", 20, 5)}
    newest = ledger.newest_usable(found.withColumn("compatible", F.lit(True))).first()
    assert newest.step == 100 and newest.path.endswith("checkpoint_step_100.pt")
    versions = ledger.next_versions(files.withColumn("model", F.element_at(F.split("path", "/"), -2))).collect()
    assert {r.model: (r.highest, r.next_version) for r in versions} == {"run1": (None, 1), "run2": (3, 4)}


def test_random_records_are_reproducible(spark):
    a = readers.synthetic_records(spark, 100, 64, 500)
    assert a.filter(F.exists("input_ids", lambda x: (x < 0) | (x >= 500))).isEmpty() and a.count() == 100
    assert sorted(a.collect()) == sorted(readers.synthetic_records(spark, 100, 64, 500).repartition(3).collect())


def test_saved_tokenizer_round_trip(spark, tmp_path):
    vocab = spark.createDataFrame([(0, b"\xff"), (1, b"ab")], "id int, token binary")
    merges = spark.createDataFrame([(b"a", b"|b", 260)], "left binary, right binary, id int")
    special = spark.createDataFrame([("<PAD>", 256)], "token string, id int")
    writers.write_tokenizer_json(vocab, merges, special, str(tmp_path / "t"))
    back = readers.read_tokenizer_json(spark, str(tmp_path / "t"))
    assert {r.id: bytes(r.token) for r in back["vocab"].collect()} == {0: b"\xff", 1: b"ab"}
    assert [(bytes(r.left), bytes(r.right), r.id) for r in back["merges"].collect()] == [(b"a", b"|b", 260)]
    assert [tuple(r) for r in back["special_tokens"].collect()] == [("<PAD>", 256)]
    rules = spark.createDataFrame([(1, 2, 9, 1), (3, 4, 8, 0)], "left_id int, right_id int, id int, priority int")
    assert [r.value for r in writers.merges_tsv_lines(rules).collect()] == ["3\t4\t8", "1\t2\t9"]


def test_paths_need_a_file_system():
    from gristmill.sources.fixed_width import _open

    with pytest.raises(ValueError, match="names no file system"):
        _open("/data/records")


def test_no_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from gristmill.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_documents_of_a_ledger_are_compressed_and_spread_over_files(spark, tmp_path, monkeypatch):
    """Run records of 6 GB of orders took 97 GB as plain JSON."""
    from gristmill.plans import catalog_ledger

    monkeypatch.setattr(catalog_ledger, "scratch", lambda spark, label: str(tmp_path / label))
    rows = catalog_ledger.s10_runs(spark, "/root/testdata/sf0.001").count()
    files = [f for f in (tmp_path / "s10-runs").iterdir() if f.name.startswith("part-")]
    assert sum(f.stat().st_size for f in files) < 600 * rows  # a record has 1 700 bytes

    df = spark.range(10, numPartitions=1).select(F.col("id").cast("string").alias("run_id"))
    writers.write_documents(df, str(tmp_path / "d"), per_file=4)
    assert len(list((tmp_path / "d").glob("part-*"))) == 3
    assert spark.read.json(str(tmp_path / "d")).count() == 10
