"""Numbers over ties, stored answers, claims of writers, and progress while a job runs."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from billflow.operators.evaluate import observed_progress
from billflow.operators.lookup import number_rows
from billflow.plans.store import StagingStore, StoreBusy
from billflow.sources.ledger import Ledger, LedgerWriter, call_key, extract_through_ledger
from tests.test_flows import DDL, GOOD


def test_numbers_spread_over_ties(spark):
    """Nine rows of ten have one order value: the order is total, the ranges are even."""
    rows = spark.range(10_000).select(
        "id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(50).alias("seq"))
    for each in (300, 20_000):
        got = [(r.seq, r.id, r.n) for r in number_rows(
            rows.repartition(7), "seq", "id", "n", after=5, rows_each=each).collect()]
        want = sorted((r.seq, r.id) for r in rows.collect())
        assert sorted(got, key=lambda r: r[2]) == [(s, i, k + 6) for k, (s, i) in enumerate(want)]
    cuts = rows.repartitionByRange(34, "seq", "id").groupBy(F.spark_partition_id()).count()
    assert cuts.agg(F.max("count")).first()[0] < 1500
    same = spark.createDataFrame([(1, 1)] * 5, "seq int, id int")
    assert sorted(r.n for r in number_rows(same, "seq", "id", "n").collect()) == [1, 2, 3, 4, 5]
    assert number_rows(same.limit(0), "seq", "id", "n").count() == 0


def test_killed_task_calls_nothing_twice(spark, tmp_path):
    """A worker dies in the middle; the next run asks only for what was not stored."""
    calls, marker = tmp_path / "calls", str(tmp_path / "died")
    calls.mkdir()

    def extractor(name):
        with open(calls / f"{name}-{time.time_ns()}", "w"):
            pass
        if name == "f15" and not os.path.exists(marker):
            open(marker, "w").close()
            os._exit(1)
        if name == "bad":
            raise ValueError("unreadable")
        return {"name": name}

    names = spark.createDataFrame([(f"f{i}", f"c{i % 20}") for i in range(25)] + [("bad", "cb")],
                                  "file_name string, content string")
    root = str(tmp_path / "ledger")

    def run():
        return extract_through_ledger(names, extractor, root, key=["content"], partitions=1,
                                      side_by_side=1).collect()
    with pytest.raises(Exception):
        run()
    stored = {f.name for f in (tmp_path / "ledger").rglob("*") if len(f.name) == 64}
    assert stored
    rows = {r.file_name: r for r in run()}
    assert len(rows) == 26 and rows["bad"].error_message == "unreadable"
    assert any(r.from_ledger for r in rows.values())
    assert rows["f20"].raw == rows["f0"].raw  # equal content, one call
    made = [f.name.split("-")[0] for f in calls.iterdir()]
    assert all(made.count(n) == 1 for n in set(made) - {"f15", "bad"}) and len(set(made)) == 21
    again = {r.file_name: r.from_ledger for r in run()}
    assert [n for n, known in again.items() if not known] == ["bad"]


def test_call_keys_and_ledger(tmp_path):
    assert call_key("a", "bc") != call_key("ab", "c") != call_key(b"ab", "c")
    ledger = Ledger(f"file://{tmp_path}/l")
    assert ledger.get("ab" * 32) is None
    ledger.put("ab" * 32, {"raw": "x"})
    assert Ledger(f"{tmp_path}/l").get("ab" * 32) == {"raw": "x"}


def bills(spark, *amounts):
    return spark.createDataFrame([(f"{a}.jpg", a, json.dumps(GOOD | {
        "total_amount": float(a), "vendor_name": f"Vendor {a % 3}"})) for a in amounts], DDL)


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "s")).create()
    problems = []

    def load(writer, *amounts):
        try:
            StagingStore(spark, store.root).load(bills(spark, *amounts), 0, writer=writer)
        except Exception as problem:
            problems.append(problem)
    threads = [threading.Thread(target=load, args=x) for x in
               (("one", 1, 2, 3), ("two", 3, 4, 5), ("three", 6, 7))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not problems
    invoices = store.invoices().collect()
    assert sorted(int(r.total_amount) for r in invoices) == [1, 2, 3, 4, 5, 6, 7]
    assert len({r.invoice_id for r in invoices}) == 7 and store.vendors().count() == 3
    assert store.published().where("writer IS NOT NULL").count() == 3


def test_claim_of_a_failed_writer(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "s")).create()
    publish, store._publish = store._publish, None  # dies before it publishes
    with pytest.raises(TypeError):
        store.load(bills(spark, 1), 0, writer="one")
    other = StagingStore(spark, store.root)
    with pytest.raises(StoreBusy):
        other.load(bills(spark, 2), 0, writer="two", wait_seconds=0.3)
    assert other.invoices().count() == 0
    store._publish = publish
    store.load(bills(spark, 1), 0, writer="one")  # its own claim is its own
    other.load(bills(spark, 2), 0, writer="two", wait_seconds=0.3)
    store._publish = None
    with pytest.raises(TypeError):
        store.load(bills(spark, 3), 1, writer="one")
    other.take_over()
    other.load(bills(spark, 4), 1, writer="two", wait_seconds=0.3)
    assert sorted(int(r.total_amount) for r in other.invoices().collect()) == [1, 2, 4]


def test_failed_documents_are_numbered(spark, tmp_path):
    store = StagingStore(spark, str(tmp_path / "s")).create()
    for number, names in enumerate((["b", "a"], ["c"])):
        store.load(spark.createDataFrame([(n, 10 * number + i, "{") for i, n in enumerate(names)],
                                         DDL), number)
    assert [(r.dlq_id, r.file_name) for r in store.dlq().orderBy("dlq_id").collect()] == [
        (1, "b"), (2, "a"), (3, "c")]


def test_progress_comes_with_the_action(spark):
    attempts = spark.createDataFrame([("bill_1", "m", None), ("bill_7", "m", "quota")],
                                     "file string, model string, error string")
    rows, seen = observed_progress(attempts)
    assert rows.count() == 2
    assert seen.get == {"n_attempts": 2, "n_failed": 1, "last_bill": 7}


def test_ledger_takes_the_room_of_its_answers(spark, tmp_path):
    """Answers share files, by bucket: 6,000 of them take fewer files than that, and all are found again."""
    names = spark.range(6000).selectExpr("concat('f', id) AS file_name")
    root = str(tmp_path / "ledger")

    def run(partitions):
        rows = extract_through_ledger(names, lambda name: {"name": name}, root, partitions=partitions).collect()
        assert all(r.raw == json.dumps({"name": r.file_name}) and r.attempts == 1 for r in rows)
        return [r.from_ledger for r in rows]
    assert run(4) == [False] * 6000
    files = [f for f in (tmp_path / "ledger").rglob("*") if f.is_file()]
    assert len(files) <= 4096 < 6000
    assert run(3) == [True] * 6000


def test_ledger_reads_older_and_merged_files(tmp_path):
    ledger, old, new = Ledger(str(tmp_path)), "cd" * 32, ["ab" * 32, "ab" * 31 + "00"]
    (tmp_path / "cd").mkdir()
    (tmp_path / "cd" / old).write_text('{"raw": "old"}')
    with LedgerWriter(ledger, appends=False) as writer:
        for i, key in enumerate(new):
            writer.put(key, {"raw": i})
            assert ledger.get(key) == {"raw": i}  # before the file of the bucket is made
    assert len(list((tmp_path / "aba").iterdir())) == 1
    with open(next((tmp_path / "aba").iterdir()), "ab") as file:
        file.write(b"ab0 {")  # a killed writer's last line
    assert ledger.known([old, *new, "ef" * 32]) == {old: {"raw": "old"}, new[0]: {"raw": 0}, new[1]: {"raw": 1}}
