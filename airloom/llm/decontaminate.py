"""Benchmark decontamination: size-partitioned MinHash containment, verified by exact shingles.

Items are partitioned by the number of their distinct shingles, in powers of two. An item's sketch
is its ``k`` smallest shingle hashes (bottom-k MinHash), with ``k`` set by its partition's largest
size: of ``s`` shingles at most ``(1 - containment) * s`` can be missing from a document that
contains the item, so more than that many sketch entries always include one that the document
has. A document therefore meets every item it contains, however short the item and long the
document, and a candidate is confirmed by counting the item's shingles in it exactly.

Words are runs of letters, digits and marks beyond ASCII, lower-cased; shingles are ``SHINGLE``
words, or the whole sequence of an item with fewer words, which only documents with exactly that
sequence contain. Items and documents without words match nothing, as do null texts. Repeated
rows give a pair once; a document table or item table that is empty gives none. Other columns are
ignored.

Items are broadcast if their table proves small; beyond ``BROADCAST_BYTES`` the sketches and the
confirmation are joins by shingle hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import documents, flat, materialize, slices, table, word_spans
from airloom.llm.hashing import grams, word_hashes
from airloom.session import broadcast_checked

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_BYTES = 32_000_000

PAIRS = "doc_id long, item_id long, n_found long, n_item long"
SHINGLES = "id long, h long"

_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_IN_WORD[128:] = True


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, at = flat(pc.utf8_lower(column))
    start, end, first = word_spans(data, at, _IN_WORD)
    words = word_hashes(data, start, end)
    every = grams(words, SHINGLE)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(every[a : b - SHINGLE + 1])
        else:
            yield grams(words[a:b], b - a) if b > a else every[:0]


def sketch_size(n: int, containment: float) -> int:
    """Entries for an item of ``n`` shingles: one more than its partition's items can lack."""
    largest = (1 << n.bit_length()) - 1
    return min(n, int((1 - containment) * largest + 1e-9) + 1)


def enough(found: int | np.ndarray, n: int | np.ndarray, containment: float):
    return found >= containment * n - 1e-9


class Index:
    """Sketches and full shingle sets of all items."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], containment: float) -> None:
        kept = [(i, s) for i, s in zip(ids, sets, strict=True) if len(s)]
        self.ids = [i for i, _ in kept]
        self.sets = [s for _, s in kept]
        # Sets are sorted by hash, so a sketch is the beginning of its set.
        sketches = [s[: sketch_size(len(s), containment)] for s in self.sets]
        owners = np.repeat(np.arange(len(kept)), [len(s) for s in sketches])
        hashes = np.concatenate([*sketches, np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        self.containment = containment

    def search(self, shingles: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Items that a set of shingles contains, with the numbers found and wanted."""
        if not len(self.hashes) or not len(shingles):
            return
        place = np.searchsorted(shingles, self.hashes)
        met = shingles[np.minimum(place, len(shingles) - 1)] == self.hashes
        for item in np.unique(self.owners[met]).tolist():
            wanted = self.sets[item]
            found = int(np.isin(wanted, shingles, assume_unique=True).sum())
            if enough(found, len(wanted), self.containment):
                yield self.ids[item], found, len(wanted)


def _broadcast_search(docs: DataFrame, items: DataFrame, containment: float) -> DataFrame:
    rows = items.toArrow()
    sets = list(shingle_sets(rows.column("text").combine_chunks())) if len(rows) else []
    index = Index(rows.column("item_id").to_pylist(), sets, containment)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                (doc, *hit)
                for doc, shingles in zip(
                    batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text")), strict=True
                )
                for hit in shared.value.search(shingles)
            ]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_found", "n_item"]
            )

    return docs.mapInArrow(search, PAIRS)


def _exploded(df: DataFrame, id_column: str, containment: float | None = None) -> DataFrame:
    """Rows (row, id, h, n, sketched): every distinct shingle of every text."""
    numbered = df.select(F.col(id_column).alias("id"), "text")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column("text")))
            sizes = [len(s) for s in sets]
            sketched = [
                np.arange(n) < (sketch_size(n, containment) if containment and n else n)
                for n in sizes
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("id").to_numpy(zero_copy_only=False), sizes), pa.int64()),
                    pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)),
                    pa.array(np.repeat(sizes, sizes), pa.int64()),
                    pa.array(np.concatenate([*sketched, np.zeros(0, bool)])),
                ],
                ["id", "h", "n", "sketched"],
            )

    return numbered.mapInArrow(explode, "id long, h long, n long, sketched boolean")


def _join_search(docs: DataFrame, items: DataFrame, containment: float) -> DataFrame:
    """The same by joins on shingle hashes, for items beyond the broadcast bound."""
    wanted = materialize(_exploded(items, "item_id", containment).distinct(), "item-shingles")
    wanted = wanted.withColumnsRenamed({"id": "item_id", "n": "n_item"})
    met = materialize(
        _exploded(docs, "doc_id").select(F.col("id").alias("doc_id"), "h").distinct().join(wanted, "h"),
        "met-shingles",
    )
    counts = met.groupBy("doc_id", "item_id", "n_item").agg(
        F.count("*").alias("n_found"), F.max("sketched").alias("candidate")
    )
    return counts.filter(
        F.col("candidate") & (F.col("n_found") >= containment * F.col("n_item") - 1e-9)
    ).select("doc_id", "item_id", "n_found", "n_item")


def contained(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs of a document and an item of which it has at least the given share of shingles."""
    items = items.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    search = _broadcast_search if total <= broadcast_bytes else _join_search
    return search(documents(docs), items, containment).distinct()


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = contained(docs, table(spark, folder, "benchmark")).select("doc_id").distinct()
    hit = broadcast_checked(materialize(found, "contaminated"))
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)


SQL = f"""
with texts as (
    select 0 as kind, doc_id as id, text from documents
    union all select 1, item_id, text from benchmark),
words as (
    select kind, id, regexp_extract_all(lower(text), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w
    from texts),
sets as (
    select kind, id, list_distinct(case when len(w) < {SHINGLE} then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - {SHINGLE - 2}),
                            lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) end) as s
    from words where len(w) > 0),
docs as (select id as doc_id, unnest(s) as h from sets where kind = 0),
items as (select id as item_id, unnest(s) as h, len(s) as n_item from sets where kind = 1)
select doc_id, item_id, count(*) as n_found, n_item
from docs join items using (h)
group by doc_id, item_id, n_item
having count(*) >= {CONTAINMENT} * n_item - 1e-9"""
