"""Keys that several postings share, found over postings packed into arrays.

A task that reads texts turns each batch into (key, payload) postings, marks the
keys that occur more than once within the batch, and sends a single posting of
each key on, packed by key bucket. So a key that a third of all rows have costs its
bucket one posting per batch; postings already known to share their key travel in
slices to any bucket. The tasks that gather a bucket find the keys that several
batches share. The result is every posting whose key occurs again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PACKED = "bucket int, known boolean, base bigint, keys binary, payloads binary"
#: Postings that a task holds at once while it gathers a bucket, least and most, and those of a slice.
LEAST_PER_BUCKET, PER_BUCKET, SLICE = 1 << 15, 1 << 20, 1 << 15

Unpack = Callable[[np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def buckets_for(frame: DataFrame, postings: float, most: int = PER_BUCKET) -> int:
    """As many buckets as keep each one small, and the cluster busy, but not more than fill packed rows."""
    width = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(width, int(postings / LEAST_PER_BUCKET) + 1), int(postings / most) + 1)


def again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, whether each posting in that order shares its key, and whether it is the first of it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    last = np.ones(len(ordered), bool)
    last[:-1] = first[1:]
    return order, ~(first & last), first


def pack(keys: np.ndarray, payloads: np.ndarray, buckets: int, base: int = 0) -> pd.DataFrame:
    """The packed rows of a batch; `base` is what the payloads are relative to."""
    rows = []
    if len(keys):
        order, shared, first = again(keys)
        known = order[shared]
        where = int(keys[0]) % buckets
        for start in range(0, len(known), SLICE):
            part = known[start : start + SLICE]
            rows.append(((where + start // SLICE) % buckets, True, base, keys[part].tobytes(), payloads[part].tobytes()))
        sent = np.sort(order[first])
        at = (keys[sent] % keys.dtype.type(buckets)).astype(np.int64)
        by_bucket = np.argsort(at, kind="stable")
        sent, at = sent[by_bucket], at[by_bucket]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], len(at)], strict=True):
            part = sent[start:end]
            rows.append((int(at[start]), False, base, keys[part].tobytes(), payloads[part].tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "known", "base", "keys", "payloads"])


def shared_postings(packed: DataFrame, key: np.dtype, payload: np.dtype, unpack: Unpack, schema: str) -> DataFrame:
    """Postings whose key others have too, of a frame of packed rows; some may come twice.

    `unpack` turns keys, payloads and their bases into rows of the schema.
    """

    def joined(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.frombuffer(b"".join(rows["keys"]), key)
        lengths = [len(packed_keys) // np.dtype(key).itemsize for packed_keys in rows["keys"]]
        bases = np.repeat(rows["base"].to_numpy(np.int64), lengths)
        return keys, np.frombuffer(b"".join(rows["payloads"]), payload), bases

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        known = rows["known"].to_numpy(bool)
        keys, payloads, bases = joined(rows[~known])
        order, shared, _ = again(keys)
        found = order[shared]
        parts = [unpack(keys[found], payloads[found], bases[found])]
        if known.any():
            parts.append(unpack(*joined(rows[known])))
        return pd.concat(parts, ignore_index=True)

    return packed.groupBy("bucket").applyInPandas(gather, schema)
