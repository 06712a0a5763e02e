"""Requests assembled with state per key: over batches, late events, and requests that never end."""

import datetime as dt

from gristmill.streaming import jobs, keyed

ROWS = f"{jobs.EVENT_ROWS}, sent timestamp"


def run(spark, tmp_path, batches, schema, **options):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    if "time" in options:
        stream = stream.withWatermark("sent", "1 second")
    query = (
        keyed.assembled_requests(stream, **options).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())), progress


def test_requests_over_batches(spark, tmp_path):
    one = [(1, 0, "start", None), (1, 2, "token", "llo"), (2, 1, "token", "x"), (2, 1, "token", "x"), (4, 1, "token", "open")]
    two = [(1, 1, "token", "He"), (1, 3, "complete", None), (1, 4, "token", "late"), (2, 2, "error", None), (3, 1, "complete", None)]
    three = [(1, 5, "token", "later"), (1, 6, "complete", None)]
    got, _ = run(spark, tmp_path, [one, two, three], jobs.EVENT_ROWS)
    assert got == [(1, "complete", "Hello", 2), (2, "error", "x", 1), (3, "complete", "", 0)]


def test_abandoned_requests_expire(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    batches = [
        [(1, 1, "token", "a", at(0)), (2, 1, "token", "b", at(0))],
        [(2, 2, "token", "c", at(8)), (3, 1, "complete", None, at(8))],
        [(9, 1, "complete", None, at(15))],
        [(9, 2, "token", "late", at(59))],
    ]
    got, state = run(spark, tmp_path, batches, ROWS, patience=10_000, time="sent")
    assert (1, "timeout", "a", 1) in got and (2, "timeout", "bc", 2) in got
    assert [r for r in got if r[1] == "complete"] == [(3, "complete", "", 0), (9, "complete", "", 0)]
    assert len(got) == 4


def test_the_query_takes_few_batches_however_many_files(spark, tmp_path, monkeypatch):
    from gristmill.plans import catalog_ledger

    rows = [(c, t, "u", f"{c}.{t} ") for c in range(30) for t in range(c % 4 + 1)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    table.repartition(11).write.parquet(str(tmp_path / "conversations.parquet"))
    batches, put = [], catalog_ledger.put_batch
    monkeypatch.setattr(catalog_ledger, "put_batch", lambda df, path, n: batches.append(n) or put(df, path, n))
    got = catalog_ledger.t05(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [
        (c, "complete", "".join(f"{c}.{t} " for t in range(c % 4 + 1)), c % 4 + 1) for c in range(30)
    ]
    # The last batch may be an empty one that only moves the watermark on.
    assert len(set(batches)) <= catalog_ledger.BATCHES + 1
