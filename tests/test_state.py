"""Streams with state: restarts, late rows, attempts that take back, and the pace."""

import json
import uuid

import pandas as pd
from pyspark.sql import functions as F

from billflow.operators.evaluate import field_metrics
from billflow.plans.store import StagingStore
from billflow.streaming import ingest, state
from tests.test_flows import BAD, DDL, GOOD


def arrive(rows, path):
    rows.coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, schema, make):
    """One start of a stream over the files so far."""
    stream = ingest.document_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
    made = make(stream)
    ingest.run_to_table(made, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    return spark.read.schema(made.schema).parquet(str(tmp_path / "out"))


def test_stateful_ingest_equals_the_batch_load(spark, tmp_path):
    changed = {**GOOD, "tax_amount": 40.5, "line_items": GOOD["line_items"][:1]}
    other = {**GOOD, "vendor_name": "Mani & Sons", "total_amount": 7.0}
    deliveries = [[("1.jpg", 1, json.dumps(GOOD)), ("2.jpg", 2, json.dumps(GOOD))],
                  [("3.jpg", 3, json.dumps(BAD)), ("4.jpg", 4, json.dumps(other)),
                   ("x.jpg", 5, "{")],
                  [("5.jpg", 6, json.dumps(changed)), ("6.jpg", 7, json.dumps(other))]]
    ingested = state.StatefulIngest(spark, str(tmp_path / "stateful"), buckets=3)
    store = StagingStore(spark, str(tmp_path / "store")).create()
    for number, rows in enumerate(deliveries):  # each start goes on with the state of the one before
        documents = spark.createDataFrame(rows, DDL)
        arrive(documents, str(tmp_path / "in"))
        store.load(documents, number)
        stream = ingest.document_stream(spark, str(tmp_path / "in"), DDL)
        ingested.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    columns = {"vendors": ["vendor_name"], "dlq": ["file_name", "error_type", "error_message",
                                                   "raw_payload"],
               "invoices": ["invoice_hash", "invoice_date", "invoice_number", "total_amount",
                            "tax_amount"],
               "line_items": ["position", "product_desc", "quantity", "total_price"]}
    for table, names in columns.items():
        mine, theirs = (sorted(map(tuple, getattr(s, table)().select(*names).collect()), key=repr)
                        for s in (ingested, store))
        assert mine == theirs and mine
    ids = [r.invoice_id for r in ingested.invoices().collect()]
    assert len(set(ids)) == len(ids) == 2
    assert {r.invoice_id for r in ingested.line_items().collect()} <= set(ids)


def test_late_and_forgotten_deliveries(spark, tmp_path):
    schema = "invoice_hash string, at timestamp"
    days = [[("a", 1), ("a", 1), ("b", 1)], [("b", 3), ("c", 9)], [("d", 12)],
            [("a", 12), ("e", 2), ("b", 4)]]
    for rows in days:
        stamped = spark.createDataFrame(rows, "invoice_hash string, day int").select(
            "invoice_hash", F.make_timestamp(F.lit(2024), F.lit(5), "day", F.lit(0), F.lit(0),
                                             F.lit(0)).alias("at"))
        arrive(stamped, str(tmp_path / "in"))
        told = run(spark, tmp_path, schema, lambda s: state.stream_deliveries(
            s, "at", "1 day", live_days=4))
    got = sorted((r.invoice_hash, r.at.day, r.outcome, r.reason) for r in told.collect())
    behind = "{} s behind the watermark"  # which is at day 11 by then
    assert got == [
        ("a", 1, "kept", None), ("a", 12, "kept", None),  # forgotten after four days
        ("b", 1, "kept", None), ("b", 4, "late", behind.format(7 * 86_400)),
        ("c", 9, "kept", None), ("d", 12, "kept", None),
        ("e", 2, "late", behind.format(9 * 86_400))]


def scored_rows(spark, rows):
    """(file, model, attempt, whether the amount is right) as scored attempts."""
    fields = "vendor_name string, invoice_number string, date string, total_amount double, " \
             "tax_amount double, gstin string, invoice_number_is_text boolean"
    truth = ("V", "1", "2024-01-01", 5.0, 0.0, "Unspecified")
    made = [(f, m, a, None, (*truth[:3], 5.0 if ok else 99.0, *truth[4:], True), truth)
            for f, m, a, ok in rows]
    return spark.createDataFrame(
        made, f"file string, model string, attempt bigint, error string, extracted struct<"
              f"{fields}>, truth struct<{fields.rsplit(',', 1)[0]}>")


def test_later_attempts_take_back(spark, tmp_path):
    deliveries = [[("1", "m", 1, True), ("2", "m", 1, False), ("2", "n", 5, True)],
                  [("1", "m", 2, False), ("2", "m", 1, False), ("3", "m", 1, True)],
                  [("1", "m", 1, True), ("2", "m", 2, True), ("2", "n", 4, False)]]
    rows = [r for d in deliveries for r in d]
    for delivery in deliveries:
        scored = scored_rows(spark, delivery)
        arrive(scored, str(tmp_path / "in"))
        changes = run(spark, tmp_path, scored.schema, state.stream_metric_changes)
    got = {tuple(r) for r in state.metrics_from_changes(changes).collect()}
    want = {tuple(r) for r in field_metrics(scored_rows(spark, rows), ["m", "n"]).select(
        "model", "field", "correct", "total").collect()}
    assert got == want
    assert ("m", "total_amount", 2, 3) in got  # 2 and 3; the last attempt at 1 is wrong


def test_pace_is_kept(spark, tmp_path):
    requests = spark.createDataFrame([(m, f"{m}{i}") for m in ("a", "b") for i in range(5)],
                                     "model string, request string")
    arrive(requests, str(tmp_path / "in"))
    stream = ingest.document_stream(spark, str(tmp_path / "in"), requests.schema)
    paced = state.stream_paced(stream, 0.7, burst=2)
    out = str(tmp_path / "out")
    query = ingest.run_to_table(paced, out, str(tmp_path / "c"), pace="0 seconds")
    rows = ingest.wait_for_rows(query, out, paced.schema, 10, seconds=120).collect()
    assert len({r.request for r in rows}) == len(rows) == 10
    for model in ("a", "b"):
        times = sorted(r.released_ms for r in rows if r.model == model)
        # three wait for a token each, whatever the batches take
        assert times[-1] - times[0] >= 3 * 700
        for i, t in enumerate(times):
            assert sum(1 for u in times[:i + 1] if t - u < 700) <= 3  # a burst and one more


def test_requests_that_fill_their_last_frame(spark, tmp_path, monkeypatch):
    """A frame without requests goes out after the last full one; its columns must be texts, too."""
    monkeypatch.setattr(state.TokenBucket, "CHUNK", 10)
    monkeypatch.setattr(state.TokenBucket, "GIVEN", 20)
    requests = spark.range(80).selectExpr("'m' AS model", "concat('r', id) AS request")
    arrive(requests.coalesce(1), str(tmp_path / "in"))
    stream = ingest.document_stream(spark, str(tmp_path / "in"), "model string, request string")
    paced = state.stream_paced(stream, 0.01, burst=40)
    out = str(tmp_path / "out")
    query = ingest.run_to_table(paced, out, str(tmp_path / "c"), pace="0 seconds")
    rows = ingest.wait_for_rows(query, out, paced.schema, 80, seconds=60).collect()
    assert sorted(r.request for r in rows) == sorted(f"r{i}" for i in range(80))


def counted(processor, folder):
    """The processor, which leaves a file in the folder for each group it is called for."""
    handle = processor.handleInputRows

    def told(key, rows, timers):
        (folder / uuid.uuid4().hex).touch()
        return handle(key, rows, timers)
    processor.handleInputRows = told
    return processor


def test_keys_share_groups(spark, tmp_path, monkeypatch):
    """Each group has a fixed cost of its own, so there are not as many as keys."""
    calls = tmp_path / "calls"
    calls.mkdir()
    made = state.RecentDeliveries
    monkeypatch.setattr(state, "RecentDeliveries", lambda ms: counted(made(ms), calls))
    rows = spark.range(2000).selectExpr("concat('k', id % 1500) AS invoice_hash",
                                        "timestamp '2024-05-01' AS at")
    arrive(rows, str(tmp_path / "in"))
    told = run(spark, tmp_path, "invoice_hash string, at timestamp",
               lambda s: state.stream_deliveries(s, "at", "1 day", live_days=4))
    assert told.where("outcome = 'kept'").count() == told.count() == 1500
    assert 0 < len(list(calls.iterdir())) <= 300


def test_bills_share_changes(spark, tmp_path):
    """Changes are added up for a bucket, not written for each bill, model and field."""
    rows = [(str(i), m, 1, i % 3 == 0) for i in range(1000) for m in ("m", "n")]
    scored = scored_rows(spark, rows)
    arrive(scored, str(tmp_path / "in"))
    changes = run(spark, tmp_path, scored.schema, lambda s: state.stream_metric_changes(s, buckets=8))
    assert changes.count() <= 8 * (1 + 2 * 6)
    assert ("m", "total_amount", 334, 1000) in {tuple(r) for r in state.metrics_from_changes(changes).collect()}


def test_many_requests_wait_in_few_entries(spark, tmp_path, monkeypatch):
    """5,000 requests wait and come out once each, in order of arrival, in a handful of state entries."""
    entries = []

    class Map(dict):
        def updateValue(self, key, value):
            entries.append(key)
            self[key] = value
        getValue, removeKey = dict.__getitem__, dict.__delitem__

    class One:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value
        update = lambda self, value: setattr(self, "value", value)

    class Handle:
        getMapState = lambda self, *names: Map()
        getValueState = lambda self, *names: One()
        registerTimer = lambda self, at: None

    bucket = state.TokenBucket(pace_ms=1.0, burst=2500)
    bucket.init(Handle())
    frame = pd.DataFrame({"request": [f"r{i:04d}" for i in range(5000)]})
    out = []
    for now, frames in ((10_000, [frame]), (10_700, []), (12_500, []), (99_999, [])):
        out.append(pd.concat(list(bucket._release(("m",), now, iter(frames))))["request"].tolist())
    assert [len(o) for o in out] == [2500, 700, 1800, 0]
    assert sum(out, []) == list(frame["request"]) and len(entries) <= 10
    assert not bucket.waiting


class Handle:
    """State in dictionaries, with the calls counted."""

    def __init__(self):
        self.calls, self.maps, self.values = 0, {}, {}

    def getMapState(self, name, key, value):
        return Entry(self, self.maps.setdefault(name, {}))

    def getValueState(self, name, schema):
        return Entry(self, self.values.setdefault(name, {}))


class Entry:
    def __init__(self, handle, held):
        self.handle, self.held = handle, held

    def _called(self):
        self.handle.calls += 1

    def containsKey(self, key):
        self._called()
        return key in self.held

    def getValue(self, key):
        self._called()
        return self.held[key]

    def updateValue(self, key, value):
        self._called()
        self.held[key] = value

    def exists(self):
        return () in self.held

    def get(self):
        return self.held[()]

    def update(self, value):
        self.held[()] = value


def test_known_names_take_few_calls_of_the_state_and_lose_none():
    handle, told, kind = Handle(), {}, "invoice"
    names = [f"name {i}" for i in range(3000)] + [None]
    batches = [names[:1], names[:40], names[30:1000], names[5:7], names[900:] + names[:10], names]
    for batch in batches:
        processor = state.KnownNames(buckets=4)
        processor.init(handle)
        handle.calls = 0
        rows = pd.DataFrame({"seq": range(len(batch)), "name": batch, "first": "f", "last": "l"})
        out = pd.concat(processor.handleInputRows((kind, 2), iter([rows[1::2], rows[::2]]), None))
        assert handle.calls <= 4 + 2 * len(batch)
        if len(batch) > 500:
            assert handle.calls < len(batch) / 5
        assert len(out) == len(batch)
        for name, number, version, first in zip(out["name"], out["id"], out["version"], out["first"]):
            name = None if pd.isna(name) else name
            known = told.get(name)
            assert number == (known[0] if known else 3 + 4 * len(told))
            assert version == (known[1] + 1 if known else 1) and pd.isna(first) == bool(known)
            told[name] = (number, version)
    parts = handle.maps["known"].values()
    assert sum(len(p[0]) for p in parts) == len(names)
    assert max(len(p[0]) for p in parts) < 6 * state.KnownNames.PART


def test_documents_of_one_file_are_loaded_by_many_tasks(spark, tmp_path):
    class Store:
        tasks = 0

        def load(self, batch, number, writer):
            self.tasks = batch.select(F.spark_partition_id()).distinct().count()

    arrive(spark.createDataFrame([(f"{i}.jpg", i, "{") for i in range(200)], DDL), str(tmp_path / "in"))
    stream, store = ingest.document_stream(spark, str(tmp_path / "in"), DDL, files_per_batch=1), Store()
    ingest.stream_ingest(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.tasks > 1


def test_last_attempts_take_few_calls_of_the_state_and_lose_none():
    """Bills share entries of the state; counts are those of the last attempts whatever the batches."""
    handle, last, sums, bills = Handle(), {}, {}, 0
    names = [f"bill_{i}" for i in range(2000)] + [None]
    for number, batch in enumerate((names[:1], names[:300], names[250:], names[3:9], names)):
        processor = state.LastAttempts(("a", "b"))
        processor.init(handle)
        rows = [(f, m, 4 * ((number * 7 + i) % 3) + (i + number) % 4) for i, f in enumerate(batch) for m in ("m", "n")]
        handle.calls = 0
        told = pd.concat(processor.handleInputRows((2,), iter([
            pd.DataFrame(rows[::2], columns=["file", "model", "rank"]),
            pd.DataFrame(rows[1::2], columns=["file", "model", "rank"])]), None))
        if len(batch) > 200:
            assert handle.calls < len(batch) / 4
        for f, m, rank in rows:
            last[f, m] = max(rank, last.get((f, m), -1))
        for model, field, correct, new in told.itertuples(index=False):
            bills += new
            if model is not None:
                sums[model, field] = sums.get((model, field), 0) + correct
    assert bills == len(names)
    assert sums == {(m, f): sum(r >> bit & 1 for (_, of), r in last.items() if of == m)
                    for m in ("m", "n") for bit, f in ((1, "a"), (0, "b"))}


def test_a_stream_leaves_no_shuffle_files(spark, tmp_path):
    from tests.test_workspace import shuffle_files
    before = shuffle_files(spark, 500)
    documents = spark.createDataFrame([(f"{i}.jpg", i, json.dumps({**GOOD, "total_amount": float(i)}))
                                       for i in range(300)], DDL)
    documents.write.parquet(str(tmp_path / "in"))
    ingested = state.StatefulIngest(spark, str(tmp_path / "stateful"), buckets=3)
    ingested.start(ingest.document_stream(spark, str(tmp_path / "in"), DDL), str(tmp_path / "c")).awaitTermination()
    assert shuffle_files(spark, 500) <= before
    assert ingested.invoices().count() == 300
