"""Suffix-array dedup of bytes by a depth-limited radix sort.

``passages`` deals the stretches in which repeats are possible to bounded shards. A task orders
the suffixes that begin a window through the threshold only, most significant digit first: digits
are ``DIGIT`` bytes, read as one 64-bit number that equal bytes share; each pass splits the groups
of the last one whose members differ in the next digit, and suffixes left alone are dropped. The groups that remain
after the last digit are exactly the repeated windows.

Texts are UTF-8 bytes; strings are judged on the input, count within one document too, and may
overlap. Null and empty texts have no bytes. Rows without a doc_id are returned and take no part.
Repeated rows repeat each other. An empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import documents, flat, slices, table, window_starts
from airloom.llm.hashing import byte_values, grams, mixed
from airloom.llm.passages import (
    Units, covered, decided_rows, repeated_spans, stretches, with_spans,
)

THRESHOLD = 200
DIGIT = 50
ANCHOR_BYTES = 40
SHARD_BYTES = 2_000_000


def radix_groups(values: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that occur twice or more, and the group of each, in group order.

    Digits are hashed once. A group whose members agree in a digit is left as it is; only the
    members of the others are sorted.
    """
    group = np.zeros(len(starts), np.int64)
    digits: dict[int, np.ndarray] = {}
    done = 0
    while done < depth and len(starts):
        size = min(DIGIT, depth - done)
        if size not in digits:
            digits[size] = grams(values, size)
        key = digits[size][starts + done]
        within = group[1:] == group[:-1]
        split = np.zeros(int(group[-1]) + 1, bool)
        split[group[1:][within & (key[1:] != key[:-1])]] = True
        apart = split[group]
        if apart.any():
            # Those that agree go first, the others follow by group and digit.
            own = mixed(group[apart].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key[apart])
            order = np.flatnonzero(apart)[np.argsort(own)]
            place = np.concatenate([np.flatnonzero(~apart), order])
            starts, key, group = starts[place], key[place], group[place]
        new = np.ones(len(starts), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        more = np.repeat(count > 1, count)
        kept = count[count > 1]
        starts, group = starts[more], np.repeat(np.arange(len(kept)), kept)
        done += size
    return starts, group.astype(np.uint64)


def _cut(data: np.ndarray, at: np.ndarray) -> Units:
    places = np.arange(len(data))
    return byte_values(data), places, places + 1, at


def _decider(threshold: int):
    def decide(group: pa.Table) -> pa.Table:
        data, at = flat(group["text"])
        starts = np.flatnonzero(window_starts(at, threshold, max(0, len(data) - threshold + 1)))
        again, member = radix_groups(byte_values(data), starts, threshold)
        repeated = np.zeros(len(data), bool)
        repeated[again] = True
        doc, key, base = (group[c].to_numpy() for c in ("doc_id", "key", "base"))
        root = group["root"].to_numpy() == doc
        salted = len(group) > 0 and group["salts"][0].as_py() > 1
        open_ = np.zeros(len(data), bool)
        if salted:
            # Undecided here: windows that are alone in this salt, and one of those that no root
            # document has, for the copies in other salts.
            open_[starts] = ~repeated[starts]
            of_root = np.repeat(root, np.diff(at))
            with_root = np.zeros(int(member.max()) + 1 if len(member) else 0, bool)
            with_root[member[of_root[again]]] = True
            first = np.diff(member.astype(np.int64), prepend=-1) != 0
            open_[again[first & ~with_root[member]]] = True
            open_ &= ~of_root
        rows = []
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            d, k, o = int(doc[i]), int(key[i]), int(base[i])
            rows += [(d, k, o + x, o + y + threshold, None) for x, y in stretches(repeated[a:b])]
            rows += [
                (d, k, o + x, o + y + threshold, data[a + x : a + y + threshold].tobytes())
                for x, y in stretches(open_[a:b])
            ]
        return decided_rows(rows)

    return decide


def repeated(docs: DataFrame, threshold: int = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows (doc_id, key, spans) of byte ranges that repeated windows cover."""
    k = min(ANCHOR_BYTES, threshold)
    return repeated_spans(docs, _cut, _decider(threshold), k, threshold, shard_bytes, False, b"")


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def dedup(docs: DataFrame, threshold: int = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The bytes of every document that no repeated window covers."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, at = flat(batch.column("text"))
            n, removed, spans_, kept = [], [], [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                own = data[at[i] : at[i + 1]]
                gone = covered(spans, len(own))
                n.append(len(own))
                removed.append(int(gone.sum()))
                spans_.append(len(list(stretches(gone))))
                kept.append(own[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, removed, spans_)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    found = repeated(documents(docs), threshold, shard_bytes)
    return with_spans(docs, found).mapInArrow(remove, KEPT)


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:


    out = dedup(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
