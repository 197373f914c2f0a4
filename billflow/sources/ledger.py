"""A durable ledger of answers, so that no paid call is made twice for what is already known.

An answer is stored under the hash of the call's inputs before it is used. Keys are dealt into buckets
by their first digits, and a task appends the answers of a bucket to one file of its own there, line by
line, so that the ledger takes the room of its answers and not a file for each. A task that is killed
and tried again, a run that is started again, and a second file of the same content find them there.
Calls of a task run side by side up to a bound, since they wait more than they work.
"""

from __future__ import annotations

import hashlib
import json
import re
import secrets
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from billflow.sources.extract import MAX_ATTEMPTS, answer_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def call_key(*inputs) -> str:
    """The hash of a call's inputs; name the model among them where there are several."""
    digest = hashlib.sha256()
    for value in inputs:
        data = value if isinstance(value, bytes) else json.dumps(value, default=str).encode()
        digest.update(f"{type(value).__name__}:{len(data)}:".encode() + data)
    return digest.hexdigest()


BUCKET_DIGITS = 3  # of a key: 4,096 buckets
OPEN_BUCKETS = 64  # that a task writes to at once


class Ledger:
    """Answers below a shared folder, on any file system that Arrow opens."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def opened(self):
        from pyarrow import fs
        path = "file://" + self.root[len("file:"):] if re.match(r"file:/(?!//)", self.root) \
            else self.root
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def known(self, keys: Iterable[str]) -> dict[str, dict]:
        """The stored answers among these keys; each of their buckets is read once."""
        from pyarrow import fs
        system, root = self.opened()
        wanted, found = set(keys), {}

        def content(path: str) -> bytes:
            try:
                with system.open_input_stream(path) as file:
                    return file.read()
            except FileNotFoundError:
                return b""  # just merged into another one
        for bucket in sorted({key[:BUCKET_DIGITS] for key in wanted}):
            for file in system.get_file_info(fs.FileSelector(f"{root}/{bucket}",
                                                             allow_not_found=True)):
                for line in content(file.path).split(b"\n")[:-1]:  # a line without end is half written
                    key, _, answer = line.partition(b" ")
                    if (key := key.decode()) in wanted:
                        found[key] = json.loads(answer)
        # ledgers of before have one file for each answer, in folders by two digits
        for folder in {key[:2] for key in wanted - found.keys()}:
            if system.get_file_info(f"{root}/{folder}").type == fs.FileType.Directory:
                for key in [k for k in wanted - found.keys() if k[:2] == folder]:
                    if answer := content(f"{root}/{folder}/{key}"):
                        found[key] = json.loads(answer)
        return found

    def get(self, key: str) -> dict | None:
        return self.known([key]).get(key)

    def put(self, key: str, answer: dict) -> None:
        with LedgerWriter(self) as writer:
            writer.put(key, answer)


class LedgerWriter:
    """Appends answers, one file for each bucket; what ``put`` has returned from outlives the process.

    Where a file can only be read once it is closed (all but local file systems and mounted ones), each
    answer is a file at first; closing merges those of a bucket into one.
    """

    def __init__(self, ledger: Ledger, appends: bool | None = None):
        self.system, self.root = ledger.opened()
        self.appends = self.system.type_name == "local" if appends is None else appends
        self.files, self.single, self.lock = {}, {}, Lock()

    def _new(self, bucket: str):
        path = f"{self.root}/{bucket}/{secrets.token_hex(32)}"
        return path, self.system.open_output_stream(path)

    def put(self, key: str, answer: dict) -> None:
        bucket, line = key[:BUCKET_DIGITS], f"{key} {json.dumps(answer)}\n".encode()
        with self.lock:
            if bucket not in self.files:
                self.system.create_dir(f"{self.root}/{bucket}", recursive=True)
                self.files[bucket] = self._new(bucket)[1] if self.appends else None
            if self.appends:
                self.files[bucket].write(line)
                self.files[bucket].flush()
                return
        path, file = self._new(bucket)
        with file:
            file.write(line)
        with self.lock:
            self.single.setdefault(bucket, []).append((path, line))

    def __enter__(self) -> "LedgerWriter":
        return self

    def __exit__(self, *problem) -> None:
        for file in self.files.values():
            if file is not None:
                file.close()
        for bucket, written in self.single.items():
            if len(written) > 1:
                with self._new(bucket)[1] as file:
                    file.write(b"".join(line for _, line in written))
                for path, _ in written:
                    self.system.delete_file(path)


def extract_through_ledger(files: DataFrame, extractor: Callable[..., dict], root: str,
                           inputs: Sequence[str] = ("file_name",),
                           key: Sequence[str] | None = None, partitions: int | None = None,
                           side_by_side: int = 8, max_attempts: int = MAX_ATTEMPTS,
                           pause: Callable[[float], None] | None = None) -> DataFrame:
    """Like ``extract_with_retry``, with ``from_ledger``: a stored answer is taken, a new one is stored and then
    used. ``key`` names the columns that make a call the same (the content's hash rather than the file's name);
    failures are not stored, so another run tries them again.

    Calls are sorted by key, so that a task has whole buckets of the ledger and reads each of them about once;
    inputs equal by key are sent to one task and called once there.
    """
    key = list(key or inputs)
    ledger = Ledger(root)

    @F.pandas_udf("binary")
    def digest(*columns: pd.Series) -> pd.Series:
        return pd.Series([bytes.fromhex(call_key(*row)) for row in zip(*columns)], dtype=object)

    keyed = files.withColumn("_call", digest(*key))
    bucket = F.substring(F.hex("_call"), 1, BUCKET_DIGITS)
    spread = keyed.repartition(partitions, bucket) if partitions else keyed.repartition(bucket)

    def told(pool: ThreadPoolExecutor, first: dict[str, tuple]) -> dict[str, tuple]:
        known = ledger.known(first)
        with LedgerWriter(ledger) as writer:
            def call(same: str, values: tuple) -> tuple:
                if same in known:
                    return known[same]["raw"], known[same]["attempts"], None, None, True
                answer = answer_of(extractor, values, max_attempts, pause)
                if answer[2] is None:
                    writer.put(same, {"raw": answer[0], "attempts": answer[1]})
                return *answer, False
            return dict(zip(first, pool.map(call, first, first.values())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(side_by_side) as pool:
            for batch in batches:
                keys = [call.hex() for call in batch["_call"]]
                values = list(batch[list(inputs)].itertuples(index=False, name=None))
                first = dict(zip(reversed(keys), reversed(values)))  # one call for equal keys
                answers: dict[str, tuple] = {}
                buckets = sorted({k[:BUCKET_DIGITS] for k in first})
                for low in range(0, len(buckets), OPEN_BUCKETS):
                    some = set(buckets[low:low + OPEN_BUCKETS])
                    answers |= told(pool, {k: v for k, v in first.items() if k[:BUCKET_DIGITS] in some})
                names = ("raw", "attempts", "error_type", "error_message", "from_ledger")
                yield batch.drop(columns="_call").assign(**{
                    name: [answers[k][i] for k in keys] for i, name in enumerate(names)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return spread.sortWithinPartitions("_call").mapInPandas(
        run, f"{schema}, raw string, attempts int, error_type string,"
             " error_message string, from_ledger boolean")
