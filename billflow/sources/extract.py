"""Calling a caller-supplied extractor for many files, with retries and errors as rows."""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Retry policy.
MAX_ATTEMPTS = 3
WAIT_MULTIPLIER = 2.0
WAIT_MIN = 2.0
WAIT_MAX = 10.0


class TransientExtractorError(Exception):
    """The one error an extractor may raise to be called again."""


def wait_before(attempt: int, multiplier: float = WAIT_MULTIPLIER, low: float = WAIT_MIN,
                high: float = WAIT_MAX) -> float:
    """Seconds to wait after a failed attempt: exponential between two limits."""
    return max(low, min(multiplier * 2.0 ** (attempt - 1), high))


def answer_of(extractor: Callable[..., dict], values: Sequence, max_attempts: int = MAX_ATTEMPTS,
              pause: Callable[[float], None] | None = time.sleep) -> tuple:
    """(raw, attempts, error_type, error_message) of one call with its retries."""
    for attempt in range(1, max_attempts + 1):
        try:
            return json.dumps(extractor(*values)), attempt, None, None
        except TransientExtractorError as problem:
            last = problem
            if attempt < max_attempts and pause is not None:
                pause(wait_before(attempt))
        except Exception as problem:
            return None, attempt, "extractor", str(problem)
    return None, max_attempts, "extractor", f"gave up after {max_attempts} attempts: {last}"


def extract_with_retry(files: DataFrame, extractor: Callable[..., dict],
                       inputs: Sequence[str] = ("file_name",), partitions: int | None = None,
                       max_attempts: int = MAX_ATTEMPTS,
                       pause: Callable[[float], None] | None = time.sleep) -> DataFrame:
    """Run ``extractor(*inputs)`` per row; adds raw, attempts, error_type, error_message.

    A failing call never fails its task, so paid calls of the same partition are not repeated
    by a task retry. Run with speculation off. ``partitions`` spreads the calls, since a file
    listing may arrive in few partitions.
    """
    spread = files if partitions is None else files.repartition(partitions, *inputs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [answer_of(extractor, row, max_attempts, pause)
                       for row in batch[list(inputs)].itertuples(index=False)]
            yield batch.assign(**{
                name: [r[i] for r in results] for i, name in
                enumerate(("raw", "attempts", "error_type", "error_message"))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spread.schema)
    return spread.mapInPandas(
        run, f"{schema}, raw string, attempts int, error_type string, error_message string")


def model_fanout(files: DataFrame, models: Sequence[str], extractor: Callable[..., dict],
                 file: str = "file_name", partitions: int | None = None, **options) -> DataFrame:
    """Every file through every model; one model's failure is a column of its own row."""
    pairs = files.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return extract_with_retry(pairs, extractor, (file, "model"), partitions, **options)
