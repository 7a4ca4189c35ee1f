"""Words of many texts at once in numpy, and sums of counts by 64-bit keys.

Keys and counts are summed by Spark without a row per key: a task sends one row per bucket of
the key space with its keys and counts packed, and each bucket is added up in numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopledger.llm.common import by_batch

# Bytes of text that are held as words at a time.
BLOCK = 1 << 19
# Keys that are merged before they leave a task.
MERGE = 1 << 21
# Buckets of the key space per partition of the input, so that a bucket stays small at any size.
BUCKETS_PER_PARTITION = 8

# Keys are sent by their high six bytes. Among 10^12 keys one in 300 then shares its key with another one.
_SENT = 6
_CUT = np.uint64((1 << 64) - (1 << 8 * (8 - _SENT)))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_HELD: dict[int, np.ndarray] = {}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64; kept by the task and longer when needed."""
    held = _HELD.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        held = _HELD[base] = np.cumprod(steps)
    return held[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(factor)
    return values ^ (values >> np.uint64(33))


def polynomials(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each range of ``values`` modulo 2^64, from one prefix polynomial over all of them."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * _powers(_INVERSE, len(values) + 1)[starts]


def text_values(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A well mixed value of each range of bytes."""
    return mixed(polynomials(text.astype(np.uint64) + np.uint64(1), starts, ends) + (ends - starts).astype(np.uint64))


def edges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    turns = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def encoded(text: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """A number per word, equal for equal words only, and the different words; ``inside`` marks the words' bytes."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[inside].tobytes())])
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def buckets_of(frame: DataFrame) -> int:
    return BUCKETS_PER_PARTITION * max(1, frame.rdd.getNumPartitions())


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal parts of the key space begins among sorted keys, and the end."""
    firsts = np.array([-(-i * (1 << 64) // buckets) for i in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, firsts), len(keys))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads, dtype=counts.dtype) if len(keys) else counts


def frequent_keys(
    frame: DataFrame, columns: list[str], counted: Callable[..., Iterator[tuple]], least: int, merge: int | None = None
) -> DataFrame:
    """``key``: the keys whose counts, over all that ``counted(*lists)`` yields, sum to at least ``least``.

    Keys are cut to their high 48 bits and counted as such, so none is lost and few others are let through.
    """
    buckets, merge = buckets_of(frame), merge or MERGE

    def packed(found: list[np.ndarray], counts: list[np.ndarray]) -> dict:
        keys, total = _sums(np.concatenate(found), np.concatenate(counts))
        at = bounds(keys, buckets)
        held = np.flatnonzero(np.diff(at))
        high = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - _SENT :]
        return {
            "bucket": held,
            "keys": [high[at[b] : at[b + 1]].tobytes() for b in held],
            "counts": [total[at[b] : at[b + 1]].tobytes() for b in held],
        }

    def work(*lists: list) -> Iterator[dict]:
        found: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for keys, n in counted(*lists):
            found.append(keys & _CUT)
            counts.append(n.astype(np.uint32))
            if sum(map(len, found)) > merge:
                keys, n = _sums(np.concatenate(found), np.concatenate(counts))
                found, counts = [keys], [n]
                if len(keys) > merge // 2:
                    yield packed(found, counts)
                    found, counts = [], []
        if found:
            yield packed(found, counts)

    def summed(bucket: pa.Table) -> pa.Table:
        high = np.frombuffer(b"".join(bucket["keys"].to_pylist()), np.uint8).reshape(-1, _SENT)
        whole = np.zeros((len(high), 8), np.uint8)
        whole[:, 8 - _SENT :] = high
        keys = whole.view("<u8").ravel()
        counts = np.frombuffer(b"".join(bucket["counts"].to_pylist()), np.uint32)
        keys, total = _sums(keys, counts.astype(np.int64))
        return pa.table({"key": keys[total >= least].view(np.int64)})

    sent = by_batch(frame, columns, work, "bucket int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(summed, "key long")


def packed_rows(rows: pa.Table, keys: np.ndarray, buckets: int) -> dict:
    """``bucket, rows``: a table cut by the bucket of each row's key, as Arrow streams."""
    order = np.argsort(keys, kind="stable")
    at = bounds(keys[order], buckets)
    whole = rows.take(pa.array(order)).combine_chunks()
    made: dict[str, list] = {"bucket": [], "rows": []}
    for b in np.flatnonzero(np.diff(at)).tolist():
        part = whole.slice(at[b], at[b + 1] - at[b])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_table(part)
        made["bucket"].append(b)
        made["rows"].append(sink.getvalue().to_pybytes())
    return made


def unpacked(bucket: pa.Table) -> pa.Table:
    """All rows sent to a bucket by ``packed_rows``."""
    return pa.concat_tables([pa.ipc.open_stream(rows).read_all() for rows in bucket["rows"].to_pylist()])
