"""Streams that keep their own state: known keys, recent deliveries, last attempts, tokens of a pace.

Each operator keeps what it must remember by key in RocksDB on the executors, saved with the
stream's checkpoint. A micro-batch costs what it brings along; nothing that older batches have
written is read, and a stream that starts again goes on where it stopped.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from billflow.operators.evaluate import attempt_rank, cells_of
from billflow.operators.load import INSERT_ONLY, UPDATED, load_rows
from billflow.operators.validate import dlq_columns, unnest_line_items, validate
from billflow.schemas import AMOUNT_TYPE, FIELDS, LINE_ITEM, QUANTITY_TYPE
from billflow.workspace import shuffles_going

# The processors travel to the workers by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def on_rocksdb(stream: DataFrame) -> DataFrame:
    """The same stream in a session whose streams keep their state in RocksDB."""
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    return stream


def in_buckets(stream: DataFrame, key: str, buckets: int) -> DataFrame:
    """The stream with a ``bucket`` of its keys to group by: a group has a fixed cost, however few rows it has."""
    return on_rocksdb(stream).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


# One bill each 13 seconds, the pace of a rate-limited extractor.
PACE_SECONDS = 13.0

# Ingestion -----------------------------------------------------------------------------------

IDENTITY = "vendor_name string, invoice_date date, invoice_number string"
AMOUNTS = (f"total_amount {AMOUNT_TYPE}, tax_amount {AMOUNT_TYPE},"
           f" line_items array<{LINE_ITEM.simpleString()}>")
DELTAS = "kind string, id bigint, version bigint, name string, first string, last string"


def part_of(name: str | None, parts: int) -> int:
    """The part of a name by linear hashing: another part takes names of one older part only."""
    value = 0 if name is None else zlib.crc32(name.encode("utf-8", "surrogatepass"))
    whole = 1 << parts.bit_length()
    return value % whole if value % whole < parts else value % (whole >> 1)


class Parted(StatefulProcessor):
    """A bucket's names and what is known of each, two values, in parts of the bucket.

    Each entry of the state is a call of its own, so an entry holds a part of the bucket's names. Parts are added
    with the names and keep their size: a batch reads and writes the parts of its names, not the bucket.
    """

    PART = 64  # names in a part, on average; fixed for the life of a checkpoint

    def _hold(self, handle, name: str, values: str) -> None:
        self.known = handle.getMapState(name, "part bigint", f"names array<string>, {values}")
        self.count = handle.getValueState("count", "n bigint")

    def _counted(self) -> int:
        return self.count.get()[0] if self.count.exists() else 0

    def _parts(self, count: int) -> int:
        return 1 + count // self.PART

    def _read(self, parts) -> dict:
        """Both values by name. Once there are names, each part has an entry, if only an empty one."""
        known: dict = {}
        for part in parts:
            names, one, two = self.known.getValue((part,))
            known.update(zip(names, zip(one, two)))
        return known

    def _known(self, names, before: int) -> dict:
        return self._read({part_of(name, self._parts(before)) for name in names} if before else ())

    def _write(self, known: dict, changed: list, before: int, count: int) -> None:
        old, parts = self._parts(before), self._parts(count)
        added = range(old, parts)
        split = [part - (1 << part.bit_length() - 1) for part in added]
        if before:
            read = {part_of(name, old) for name in known}
            known = self._read({part for part in split if part < old} - read) | known
        fill: dict = {part: [] for part in [*added, *split, *(part_of(name, parts) for name in changed)]}
        for name in known:
            part = part_of(name, parts)
            if part in fill:
                fill[part].append(name)
        for part, names in fill.items():
            told = [known[name] for name in names]
            self.known.updateValue((part,), (names, [i for i, _ in told], [v for _, v in told]))
        self.count.update((count,))


class KnownNames(Parted):
    """Numbers names at their first arrival and counts the batches that bring them again.

    The key is a kind and a bucket of names. Ids of a kind are unique because bucket b of n gives
    b + 1, b + 1 + n, b + 1 + 2 n and so on, without asking other buckets.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets

    def init(self, handle) -> None:
        self._hold(handle, "known", "ids array<bigint>, versions array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        kind, bucket = key
        arrived = pd.concat(list(rows)).sort_values("seq", kind="stable")
        if kind == "failed":
            out = arrived[["kind", "name", "first", "last"]].assign(id=None, version=None)
            yield out[["kind", "id", "version", "name", "first", "last"]].astype(
                {"id": "Int64", "version": "Int64"})
            return
        count = before = self._counted()
        ends = arrived.drop_duplicates("name").merge(
            arrived.drop_duplicates("name", keep="last")[["name", "last"]], on="name",
            suffixes=("", "_of_last"))
        names = [None if pd.isna(name) else name for name in ends["name"]]
        known = self._known(names, before)
        out, changed = [], []
        for name, first, last in zip(names, ends["first"], ends["last_of_last"]):
            if name in known:
                number, version = known[name]
                if kind == "vendor":
                    continue
                first = None
            else:
                number, version = int(bucket) + 1 + count * self.buckets, 0
                count += 1
            known[name] = (number, version + 1)
            changed.append(name)
            out.append((kind, number, version + 1, name, first, last))
        self._write(known, changed, before, count)
        yield pd.DataFrame(out, columns=["kind", "id", "version", "name", "first", "last"])

    def close(self) -> None:
        pass


class StatefulIngest:
    """Continuous load into one table of deltas, from which the staging tables are read.

    A document gives a vendor row and an invoice row, or a row of the dead-letter table; all of a
    micro-batch become visible together. ``buckets`` is fixed for the life of a checkpoint:
    several for each task that the state is spread over.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def events(self, documents: DataFrame, strict: bool = False) -> DataFrame:
        """(kind, bucket, seq, name, first, last) rows of each document."""
        checked = validate(documents, strict=strict)
        checked = checked.withColumn("invoice", F.when(F.col("error_type").isNull(),
                                                       F.col("invoice")))
        flat = load_rows(checked, "seq", "error_type", *dlq_columns(checked))
        none = F.lit(None).cast("string")

        def event(kind: str, name: Column, first: Column, last: Column) -> Column:
            bucket = F.pmod(F.xxhash64(name), F.lit(self.buckets)).cast("int")
            return F.struct(F.lit(kind).alias("kind"), bucket.alias("bucket"), F.col("seq"),
                            name.alias("name"), first.alias("first"), last.alias("last"))
        identity = F.to_json(F.struct(*INSERT_ONLY))
        amounts = F.to_json(F.struct(*UPDATED, "line_items"))
        loaded = F.array(event("vendor", F.col("vendor_name"), none, none),
                         event("invoice", F.col("invoice_hash"), identity, amounts))
        failed = F.array(event("failed", F.col("_file_name"), F.to_json(F.struct(
            F.col("error_type"), F.col("_error_message").alias("error_message"))),
            F.col("_raw_payload")))
        return flat.select(F.explode(F.when(F.col("error_type").isNull(), loaded).otherwise(failed))
                           .alias("e")).select("e.*")

    def start(self, documents: DataFrame, checkpoint: str, pace: str | None = None
              ) -> StreamingQuery:
        trigger = {"availableNow": True} if pace is None else {"processingTime": pace}
        # a file is often one split: its documents are validated by all cores, not by one for each file
        spread = documents.repartition(self.spark.sparkContext.defaultParallelism)
        deltas = on_rocksdb(self.events(spread)).groupBy("kind", "bucket").transformWithStateInPandas(
            KnownNames(self.buckets), DELTAS, "append", "none")
        with shuffles_going(self.spark):  # a stream keeps the settings of its start
            return (deltas.writeStream.format("parquet").option("path", f"{self.root}/deltas")
                    .option("compression", "zstd").option("checkpointLocation", checkpoint)
                    .trigger(**trigger).start())

    def _deltas(self, kind: str) -> DataFrame:
        rows = self.spark.read.schema(DELTAS).parquet(f"{self.root}/deltas")
        return rows.where(F.col("kind") == kind)

    def vendors(self) -> DataFrame:
        return self._deltas("vendor").select(
            F.col("id").alias("vendor_id"), F.col("name").alias("vendor_name"),
            F.lit(None).cast("string").alias("tax_id"))

    def _versions(self) -> DataFrame:
        """One row for each invoice: its first version's identity, its last version's amounts."""
        merged = self._deltas("invoice").groupBy("id", F.col("name").alias("invoice_hash")).agg(
            F.max("first").alias("first"), F.max_by("last", "version").alias("last"))
        return merged.select(
            F.col("id").alias("invoice_id"), "invoice_hash",
            F.from_json("first", IDENTITY).alias("first"), F.from_json("last", AMOUNTS).alias("last"))

    def invoices(self) -> DataFrame:
        return self._versions().select("invoice_id", "invoice_hash", "first.*",
                                       *[f"last.{c}" for c in UPDATED])

    def line_items(self) -> DataFrame:
        rows = self._versions().select("invoice_id", "last.line_items")
        return unnest_line_items(rows).select(
            "invoice_id", "position", "product_desc",
            F.col("quantity").cast(QUANTITY_TYPE).alias("quantity"),
            F.col("unit_price").cast(AMOUNT_TYPE).alias("unit_price"),
            F.col("total_price").cast(AMOUNT_TYPE).alias("total_price"))

    def dlq(self) -> DataFrame:
        told = F.from_json("first", "error_type string, error_message string")
        return self._deltas("failed").select(F.col("name").alias("file_name"), told.alias("t"),
                                             F.col("last").alias("raw_payload")).select(
            "file_name", "t.*", "raw_payload")


# De-duplication ------------------------------------------------------------------------------

class RecentDeliveries(StatefulProcessor):
    """Keeps the first delivery of a key and forgets it when its time to live has passed. What is older than
    the watermark comes out as late, since its first delivery may be forgotten.

    The state is that of a bucket of keys: a key costs a look and an entry, not a group and a timer of its own.
    Keys that are to be forgotten at one time are listed by that time, which has the timer.
    """

    def __init__(self, live_ms: int):
        self.live_ms = live_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "key string", "until bigint")
        self.ending = handle.getMapState("ending", "until bigint, part bigint", "keys array<string>")
        self.parts = handle.getMapState("parts", "until bigint", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        arrived = pd.concat(list(rows)).sort_values("arrived_ms", kind="stable")[["key", "arrived_ms"]]
        behind = arrived["arrived_ms"] < watermark
        late = arrived[behind]
        reason = ((watermark - late["arrived_ms"]) // 1000).astype(str) + " s behind the watermark"
        first = arrived[~behind].drop_duplicates("key")
        kept = first[np.array([not self.seen.containsKey((name,)) for name in first["key"]], dtype=bool)]
        for at, names in kept.groupby("arrived_ms")["key"]:
            until = int(at) + self.live_ms
            for name in names:
                self.seen.updateValue((name,), (until,))
            n = self.parts.getValue((until,))[0] if self.parts.containsKey((until,)) else 0
            self.ending.updateValue((until, n), (list(names),))
            self.parts.updateValue((until,), (n + 1,))
            self.handle.registerTimer(until)
        yield pd.concat([late.assign(outcome="late", reason=reason),
                         kept.assign(outcome="kept", reason=None)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = expiredTimerInfo.getExpiryTimeInMs()
        for part in range(self.parts.getValue((until,))[0] if self.parts.containsKey((until,)) else 0):
            for name in self.ending.getValue((until, part))[0]:
                self.seen.removeKey((name,))
            self.ending.removeKey((until, part))
        self.parts.removeKey((until,))
        return iter(())

    def close(self) -> None:
        pass


def stream_deliveries(documents: DataFrame, arrived: str, delay: str, live_days: float,
                      key: str = "invoice_hash", buckets: int = 256) -> DataFrame:
    """(key, arrived, outcome, reason): the first delivery of each key as ``kept``, deliveries behind the
    watermark as ``late`` with their reason; repeated ones within ``live_days`` are dropped. ``arrived`` is the
    time of arrival, so the state holds the keys of the last days only. ``buckets`` is fixed for the life of a
    checkpoint: several for each task that the state is spread over."""
    timed = documents.withColumn(arrived, F.col(arrived).cast("timestamp")).withWatermark(
        arrived, delay)
    # The engine would silently drop rows behind the watermark if their time came along as such.
    narrow = timed.select(F.col(key).cast("string").alias("key"),
                          F.unix_millis(arrived).alias("arrived_ms"))
    told = in_buckets(narrow, "key", buckets).groupBy("bucket").transformWithStateInPandas(
        RecentDeliveries(int(live_days * 86_400_000)),
        "key string, arrived_ms bigint, outcome string, reason string", "append", "EventTime")
    return told.select(F.col("key").alias(key), F.timestamp_millis("arrived_ms").alias(arrived),
                       "outcome", "reason")


# Field metrics -------------------------------------------------------------------------------

class LastAttempts(Parted):
    """Remembers the last attempt of each model at a bill; a later one takes back what the earlier one counted.

    The state is that of a bucket of bills; what a micro-batch changes is added up for the bucket.
    """

    def __init__(self, fields: tuple[str, ...]):
        self.fields = fields

    def init(self, handle) -> None:
        self._hold(handle, "last", "models array<array<string>>, ranks array<array<bigint>>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        best = pd.concat(list(rows)).groupby(["file", "model"], dropna=False, sort=False)["rank"].max()
        arrived: dict = {}
        for (file, model), rank in best.items():
            arrived.setdefault(None if pd.isna(file) else file, []).append(
                (None if pd.isna(model) else model, int(rank)))
        before = self._counted()
        known = self._known(arrived, before)
        changes: dict[tuple, int] = {}
        changed, bills = [], 0
        for file, attempts in arrived.items():
            held = known.get(file)
            last = {} if held is None else dict(zip(*held))
            later = held is None
            bills += later
            for model, rank in attempts:
                old = last.get(model, -1)
                if model is None or rank <= old:
                    continue
                last[model], later = rank, True
                for i, field in enumerate(self.fields):
                    bit = len(self.fields) - 1 - i
                    change = (rank >> bit & 1) - (old >> bit & 1 if old >= 0 else 0)
                    if change or old < 0:
                        changes[model, field] = changes.get((model, field), 0) + change
            if later:
                known[file] = (list(last), list(last.values()))
                changed.append(file)
        if changed:
            self._write(known, changed, before, before + bills)
        out = [(None, None, 0, bills)] if bills else []
        out += [(model, field, n, 0) for (model, field), n in changes.items()]
        yield pd.DataFrame(out, columns=["model", "field", "correct", "bills"])

    def close(self) -> None:
        pass


def stream_metric_changes(scored: DataFrame, matcher: str = "lenient", buckets: int = 256) -> DataFrame:
    """Changes of the (model, field) counts as attempts arrive, and of the number of bills. The last attempt
    of a model at a bill counts, as in the batch metrics. ``buckets`` is fixed for the life of a checkpoint."""
    ranked = cells_of(scored, matcher).select("file", "model", attempt_rank().alias("rank"))
    return in_buckets(ranked, "file", buckets).groupBy("bucket").transformWithStateInPandas(
        LastAttempts(tuple(FIELDS)), "model string, field string, correct bigint, bills bigint",
        "append", "none")


def metrics_from_changes(changes: DataFrame) -> DataFrame:
    """(model, field, correct, total) out of all changes so far."""
    sums = changes.where(F.col("model").isNotNull()).groupBy("model", "field").agg(
        F.sum("correct").alias("correct"))
    return sums.withColumn("total", changes.agg(F.coalesce(F.sum("bills"), F.lit(0))).scalar())


# Pace ----------------------------------------------------------------------------------------

class TokenBucket(StatefulProcessor):
    """Lets at most ``burst`` requests of a model pass at once and one more each ``pace_ms``; the others wait in
    order of arrival until a timer finds tokens for them. They wait in chunks, since each entry of the state is
    a call of its own."""

    CHUNK, GIVEN = 1000, 50_000  # requests in an entry of the state, and in a frame that goes out

    def __init__(self, pace_ms: float, burst: int):
        self.pace_ms, self.burst = pace_ms, burst

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "chunk bigint", "requests array<string>")
        # the first chunk and how many of it have passed, the chunk after the last, how many wait in all, and
        # until when the tokens given out so far are used up
        self.state = handle.getValueState(
            "state", "chunk bigint, passed bigint, next bigint, n_waiting bigint, paid_ms double")

    def _release(self, key, now: int, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, passed, following, n, paid = self.state.get() if self.state.exists() else (0, 0, 0, 0, 0.0)
        for frame in frames:
            requests = frame.sort_values("request")["request"].tolist()
            for low in range(0, len(requests), self.CHUNK):
                self.waiting.updateValue((following,), (requests[low:low + self.CHUNK],))
                following += 1
            n += len(requests)
        paid = max(paid, now - self.burst * self.pace_ms)  # a full bucket holds no more
        free = min(n, int((now - paid) // self.pace_ms))
        n, paid = n - free, paid + free * self.pace_ms
        out: list[str] = []
        while free:
            requests = self.waiting.getValue((chunk,))[0]
            some = requests[passed:passed + free]
            out += some
            free, passed = free - len(some), passed + len(some)
            if passed == len(requests):
                self.waiting.removeKey((chunk,))
                chunk, passed = chunk + 1, 0
            if len(out) >= self.GIVEN:
                yield self._given(key, out, now)
                out = []
        self.state.update((chunk, passed, following, n, paid))
        if n:
            self.handle.registerTimer(int(max(now + 1, paid + self.pace_ms)))
        yield self._given(key, out, now)

    @staticmethod
    def _given(key, requests: list[str], now: int) -> pd.DataFrame:
        # typed, as an empty list would be a column of numbers, which cannot go out as text
        names = pd.Series(requests, dtype=object)
        return pd.DataFrame({"model": key[0], "request": names, "released_ms": now},
                            columns=["model", "request", "released_ms"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        yield from self._release(key, timerValues.getCurrentProcessingTimeInMs(), rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._release(key, timerValues.getCurrentProcessingTimeInMs(), iter(()))

    def close(self) -> None:
        pass


def stream_paced(requests: DataFrame, pace_seconds: float = PACE_SECONDS, burst: int = 1
                 ) -> DataFrame:
    """(model, request, released_ms): each request once, when its model's bucket has a token for it. Needs a
    processing-time trigger, as waiting requests pass between arrivals."""
    narrow = requests.select(F.col("model").cast("string").alias("model"),
                             F.col("request").cast("string").alias("request"))
    return on_rocksdb(narrow).groupBy("model").transformWithStateInPandas(
        TokenBucket(pace_seconds * 1000, burst),
        "model string, request string, released_ms bigint", "append", "ProcessingTime")
