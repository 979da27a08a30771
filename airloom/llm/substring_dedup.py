"""Substring dedup: matching statistics of documents against suffix automata of reference shards.

``passages`` deals the stretches in which repeats are possible to bounded shards, reference
documents and the documents to be matched alike. A task builds its shard's automaton as it goes:
documents are streamed by doc_id, each is matched against the automaton of the shard's smaller
documents, and what it has that they have not is added as reference. The matching statistic of a
word is the longest match that ends there, followed up to the threshold; words of matches that
reach it are removed. Every salt of a hot shard gets the automaton's root documents, which is the
broadcast; automata of all shards in every task would make the work grow with the square of the
corpus.

Windows are judged on the input. A window in the same document does not count. Null texts and
texts without words stay as they are, with no words; documents shorter than the threshold lose
nothing. Rows without a doc_id are returned and take no part. Repeated rows lose the same words.
An empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import documents, flat, slices, table, word_spans
from airloom.llm.hashing import word_hashes
from airloom.llm.passages import (
    Units, covered, decided_rows, repeated_spans, stretches, with_spans,
)

THRESHOLD = 50
ANCHOR_WORDS = 12
SHARD_WORDS = 400_000


class Automaton:
    """Suffix automaton of word sequences, grown by one sequence at a time."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, edges: dict[int, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _suffix(self, p: int, word: int) -> int:
        """The state of the longest suffix of p's strings that ``word`` extends, extended."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            p = last
            if word in self.next[p]:
                last = self._suffix(p, word)
                continue
            last = self._state({}, 0, self.length[p] + 1)
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = last
                p = self.link[p]
            if p >= 0:
                self.link[last] = self._suffix(p, word)

    def statistics(self, words: list[int], most: int) -> list[int]:
        """Per word the length of the longest match that ends with it, up to ``most``."""
        state = size = 0
        out = []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size = min(size + 1, most)
                # Followed no further than needed, it may be a string of a shorter state.
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
            out.append(size)
        return out


def _cut(data: np.ndarray, at: np.ndarray) -> Units:
    start, end, first = word_spans(data, at)
    return word_hashes(data, start, end), start, end, first


def _decider(threshold: int):
    def decide(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        automaton, rows = Automaton(), []
        group = group.sort_by([("doc_id", "ascending"), ("key", "ascending"), ("base", "ascending")])
        pending: list[list[int]] = []
        before = None
        names = ("root", "doc_id", "key", "base", "text", "salts")
        for root, doc, key, base, text, salts in zip(*(group[c].to_pylist() for c in names), strict=True):
            if doc != before:
                for words in pending:
                    automaton.add(words)
                pending, before = [], doc
            raw = text.split(b" ")
            words = [numbers.setdefault(w, len(numbers)) for w in raw]
            reached = np.array(automaton.statistics(words, threshold)[threshold - 1 :]) >= threshold
            rows += [(doc, key, base + a, base + b + threshold, None) for a, b in stretches(reached)]
            for a, b in stretches(~reached):
                pending.append(words[a : b + threshold])
                if salts > 1 and doc != root:
                    rows.append((doc, key, base + a, base + b + threshold, b" ".join(raw[a : b + threshold])))
        return decided_rows(rows)

    return decide


def repeated(docs: DataFrame, threshold: int = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (doc_id, key, spans) of word ranges that windows of smaller documents cover."""
    k = min(ANCHOR_WORDS, threshold)
    return repeated_spans(docs, _cut, _decider(threshold), k, threshold, shard_words, True, b" ")


KEPT = "doc_id long, n_words long, n_removed long, kept string"


def dedup(docs: DataFrame, threshold: int = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every document without the words of repeated windows, the others joined by a blank."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = text.encode().split()
                gone = covered(spans, len(words))
                if spans:
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                total.append(len(gone))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    found = repeated(documents(docs), threshold, shard_words)
    return with_spans(docs, found).mapInArrow(remove, KEPT)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:


    out = dedup(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (
    select doc_id, unnest(range(1, len(w) - {THRESHOLD - 2})) as i, w from words where len(w) >= {THRESHOLD}),
texts as (
    select doc_id, i, md5(array_to_string(w[i:i + {THRESHOLD - 1}], ' ')) as s from windows),
firsts as (select s, min(doc_id) as first from texts group by s),
hit as (select t.doc_id, unnest(range(i, i + {THRESHOLD})) as place
        from texts t join firsts f using (s) where f.first < t.doc_id),
gone as (select distinct doc_id, place from hit),
kept as (
    select doc_id, string_agg(word, ' ' order by place) as text from (
        select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words) p
    where not exists (select 1 from gone g where g.doc_id = p.doc_id and g.place = p.place)
    group by doc_id),
counts as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from words left join counts using (doc_id) left join kept k using (doc_id)"""
