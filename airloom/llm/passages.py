"""Finding where repeated windows can be, and dealing those stretches out in bounded shards.

A window is a fixed number of consecutive units, words or bytes, of one document. Each window is
owned by the smallest of the ``k``-unit hashes in it, its anchor, so equal windows have equal
anchors; a few percent of all places are anchors. Anchors that occur twice or more are shared.
Their root is the smallest document that has them. All windows of a shared anchor, in whatever
documents, go to the shard of its root: neighbouring anchors of a copied passage mostly have one
root, so the passage travels as one segment. Windows of other anchors cannot be repeated and stay.

A shard that holds far more than its share, because many documents have its passages, is salted:
the roots' own segments go to every salt, the others to one each. What a salt can't decide alone
it passes on, and a second level deals that out by whole windows, of which each salt has one copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import flat, materialize, slices, texts, window_starts
from airloom.llm.hashing import grams, minimizers
from airloom.session import broadcast_checked

#: Units of a slice of texts: their hashes, and the byte bounds and first units of the texts.
Units = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
Cut = Callable[[np.ndarray, np.ndarray], Units]

DOC = ["doc_id", "key"]


def keyed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, base, text): the key tells apart texts that share a doc_id."""
    text = texts().cast("binary").alias("text")
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(texts()).alias("key"),
        F.lit(0).cast("long").alias("base"), text,
    )


def anchor_runs(units: Units, k: int, window: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, first and last window of every anchor's run of windows."""
    values, _, _, at = units
    hashes = grams(values, k)
    owner = minimizers(hashes, window - k + 1)
    starts = np.flatnonzero(window_starts(at, window, len(owner)))
    owner = owner[starts]
    new = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(new[1:], len(owner)) - 1 if len(new) else new
    text = np.searchsorted(at, starts[new], "right") - 1
    first = at[text]
    return text, hashes[owner[new]].view(np.int64), starts[new] - first, starts[last] - first


def _runs(docs: DataFrame, cut: Cut, k: int, window: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text, h, first, last = anchor_runs(cut(*flat(batch.column("text"))), k, window)
            base = batch.column("base").to_numpy()[text]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("doc_id").to_numpy()[text]),
                    pa.array(batch.column("key").to_numpy()[text]),
                    pa.array(h),
                    pa.array(base + first),
                    pa.array(base + last),
                ],
                ["doc_id", "key", "h", "first", "last"],
            )

    schema = "doc_id long, key long, h long, first long, last long"
    return docs.mapInArrow(find, schema)


def segments(
    docs: DataFrame, cut: Cut, k: int, window: int, across_only: bool, join: bytes
) -> DataFrame:
    """Rows (root, doc_id, key, base, text, n): stretches whose windows have shared anchors.

    ``across_only``: shared means by two documents at least, else also twice in one. ``join`` is
    put between units. ``base`` is the first unit's place, ``n`` the number of units.
    """
    # Read twice below, and dearer to make than to write.
    runs = materialize(_runs(docs, cut, k, window), "anchor-runs")
    seen = runs.groupBy("h").agg(
        F.min("doc_id").alias("root"), F.max("doc_id").alias("top"), F.count("*").alias("size")
    )
    shared = seen.filter(F.col("root") < F.col("top") if across_only else F.col("size") > 1)
    shared = materialize(shared.select("h", "root"), "shared-anchors")
    found = (
        runs.join(shared, "h")
        .groupBy(*DOC)
        .agg(F.collect_set(F.struct("first", "last", "root")).alias("runs"))
    )
    both = docs.join(found.hint("shuffle_hash"), DOC)

    def slice_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            _, start, end, at = cut(data, offsets)
            rows = []
            for i, (doc, key, base, spans) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "base", "runs")), strict=True)
            ):
                here = len(start[at[i] : at[i + 1]]) - window
                for first, last, root in merged(
                    [(s["first"] - base, s["last"] - base, s["root"]) for s in spans], here
                ):
                    a, b = at[i] + first, at[i] + last + window
                    if join:
                        text = join.join(
                            data[x:y].tobytes() for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)
                        )
                    else:
                        text = data[start[a] : end[b - 1]].tobytes()
                    rows.append((root, doc, key, base + first, text, int(b - a)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["root", "doc_id", "key", "base", "text", "n"],
            )

    schema = "root long, doc_id long, key long, base long, text binary, n long"
    return both.mapInArrow(slice_out, schema)


def merged(spans: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """Touching runs of one root as one; runs outside this stretch's windows are another's."""
    out: list[tuple[int, int, int]] = []
    for first, last, root in sorted(s for s in spans if s[0] >= 0 and s[1] <= most):
        if out and out[-1][2] == root and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]), root)
        else:
            out.append((first, last, root))
    return out


def dealt(found: DataFrame, shard_units: int, salted: bool) -> DataFrame:
    """The segments with ``shard``, ``salt`` and ``salts``; roots are in all salts of a shard."""
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_units))
    out = found.withColumn("shard", F.pmod(F.xxhash64("root"), F.lit(shards)))
    if not salted:
        return out.withColumns({"salt": F.lit(0), "salts": F.lit(1)})
    sizes = out.groupBy("shard").agg(F.sum("n").alias("size"))
    hot = sizes.filter(F.col("size") > 4 * shard_units).select(
        "shard", F.ceil(F.col("size") / (2 * shard_units)).cast("int").alias("salts")
    )
    hot = broadcast_checked(materialize(hot, "hot-shards"))
    out = out.join(hot, "shard", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    own = F.pmod(F.xxhash64("doc_id", "base"), F.col("salts")).cast("int")
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    is_root = F.col("root") == F.col("doc_id")
    return out.withColumn("salt", F.explode(F.when(is_root, every).otherwise(F.array(own))))


DECIDED = "doc_id long, key long, first long, last long, rest binary"

Decide = Callable[[pa.Table], pa.Table]


def repeated_spans(
    docs: DataFrame, cut: Cut, decide: Decide, k: int, window: int, shard_units: int,
    across_only: bool, join: bytes,
) -> DataFrame:
    """Rows (doc_id, key, spans): unit ranges, end exclusive, that repeated windows cover.

    ``decide`` gets a salt's segments and returns the covered ranges, and, from salted shards, the
    stretches that are undecided, with their texts in ``rest``.
    """
    level = keyed(docs)
    decided = []
    for size, salted in ((k, True), (window, False)):
        found = materialize(segments(level, cut, size, window, across_only, join), "segments")
        groups = dealt(found, shard_units, salted).groupBy("shard", "salt")
        decided.append(materialize(groups.applyInArrow(decide, DECIDED), "decided"))
        rest = decided[-1].filter(F.col("rest").isNotNull())
        level = rest.select(
            "doc_id", "key", F.col("first").alias("base"), F.col("rest").alias("text")
        )
    every = decided[0].unionByName(decided[1]).filter(F.col("rest").isNull())
    return every.groupBy(*DOC).agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every document, also those without a doc_id, with its spans or null."""
    own = docs.select("doc_id", texts().alias("text")).withColumn("key", F.xxhash64("text"))
    return own.join(spans.hint("shuffle_hash"), DOC, "left")


def stretches(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last index of every run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)


def decided_rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["doc_id", "key", "first", "last", "rest"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """Which of a document's units the spans cover."""
    change = np.zeros(n + 1, np.int64)
    for s in spans or []:
        change[s["first"]] += 1
        change[s["last"]] -= 1
    return np.cumsum(change[:-1]) > 0
