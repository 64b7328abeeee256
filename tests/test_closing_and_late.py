from datetime import date, datetime

import pytest

from orderflow.streaming.closing import CLOSES, closable, run_and_close
from orderflow.streaming.ingest import append_stream, read_landing
from orderflow.streaming.late import ingest_log_split, read_kind, split_batch
from orderflow.streaming.monitors import stream_label_join, stream_positive_rate
from tests.test_streaming import SCHEMA, at, land, struct

END = datetime(2100, 1, 1)


def test_closing_emits_every_day_and_no_marker(spark, tmp_path):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))
    land(spark, landing, [(1, at(1, 5), 1), (2, at(2, 5), 0), (3, at(2, 9), 0)])
    stream, markers = closable(read_landing(spark, landing, struct(spark)), str(tmp_path / "marks"), "ts")
    rates = stream_positive_rate(stream, "ts", "y", "1 day")

    def days():
        return {r["day"]: (r["n_rows"], r["n_positive"]) for r in spark.read.schema(rates.schema).parquet(out).collect()}

    append_stream(rates, out, cursor).awaitTermination()
    assert days() == {}
    want = {date(2024, 1, 1): (1, 1), date(2024, 1, 2): (2, 0)}
    for _ in range(2):  # closed twice: still no marker
        run_and_close(lambda: append_stream(rates, out, cursor), [markers], END, spark)
        assert days() == want


def test_closing_both_sides_of_a_join(spark, tmp_path):
    cursor, out = str(tmp_path / "cursor"), str(tmp_path / "out")
    p_schema, f_schema = "order_id long, pred_at timestamp", "order_id long, known_at timestamp, y int"
    land(spark, tmp_path / "p", [(1, at(1)), (2, at(1)), (None, at(2)), (3, at(10))], p_schema)
    land(spark, tmp_path / "f", [(1, at(4), 1), (9, at(3), 0), (None, at(3), 1), (3, at(18), 1)], f_schema)
    p, left = closable(read_landing(spark, str(tmp_path / "p"), struct(spark, p_schema)), str(tmp_path / "pm"), "pred_at", {"order_id": 0})
    f, right = closable(read_landing(spark, str(tmp_path / "f"), struct(spark, f_schema)), str(tmp_path / "fm"), "known_at", {"order_id": 0})
    joined = stream_label_join(p, f, "order_id", "pred_at", "known_at", "5 days", "1 day")
    assert CLOSES not in joined.columns
    run_and_close(lambda: append_stream(joined, out, cursor), [left, right], END, spark)
    rows = spark.read.schema(joined.schema).parquet(out).collect()
    assert sorted(((r["order_id"], r["y"]) for r in rows), key=str) == [(1, 1), (2, None), (3, None), (None, None)]


@pytest.fixture()
def log(spark, tmp_path):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))

    def deliver(rows):
        land(spark, landing, rows)
        ingest_log_split(read_landing(spark, landing, struct(spark)), "event_id", "ts", "1 day", cursor, out).awaitTermination()
        schema = struct(spark, SCHEMA.replace("timestamp_ntz", "timestamp"))
        kinds = {k: sorted((r["event_id"] for r in read_kind(spark, out, k, schema).collect()), key=str) for k in ("accepted", "late")}
        ledger = {r["batch_id"]: (r["n_delivered"], r["n_accepted"], r["n_repeated"], r["n_late"]) for r in read_kind(spark, out, "ledger").collect()}
        return kinds["accepted"], kinds["late"], ledger

    return deliver, out


def test_late_entries_are_kept_and_counted(spark, log):
    deliver, _ = log
    got = deliver([(1, at(5), 0), (1, at(5), 0), (2, at(1), 1), (None, at(5), 0), (None, at(5), 0)])
    assert got == ([1, 2, None, None], [], {0: (5, 4, 1, 0)})
    got = deliver([(1, at(5), 0), (3, at(4, 1), 0), (4, at(3), 0), (2, at(1), 1), (5, None, 0), (6, at(9), 1)])
    assert got == ([1, 2, 3, 6, None, None], [2, 4, 5], {0: (5, 4, 1, 0), 1: (6, 2, 1, 3)})
    accepted, late, ledger = deliver([(3, at(8, 1), 1)])  # a key with another time, on time: an entry of its own time
    assert 3 in accepted and ledger[2] == (1, 1, 0, 0)
    assert sum(n for n, *_ in ledger.values()) == len(accepted) + len(late) + sum(x[2] for x in ledger.values())


def test_a_replayed_batch_changes_nothing(spark, log):
    deliver, out = log
    deliver([(1, at(5), 0)])
    before = deliver([(2, at(1), 1), (1, at(5), 0), (7, at(6), 1)])
    rows = spark.createDataFrame([(2, at(1), 1), (1, at(5), 0), (7, at(6), 1)], SCHEMA.replace("timestamp_ntz", "timestamp"))
    split_batch(rows, 1, "event_id", "ts", "1 day", out)
    schema = rows.schema
    assert sorted(r["event_id"] for r in read_kind(spark, out, "accepted", schema).collect()) == before[0]
    assert [r["event_id"] for r in read_kind(spark, out, "late", schema).collect()] == before[1] == [2]
    assert read_kind(spark, out, "ledger").count() == 2
