"""Runs of repeated words by a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least ``MIN_WORDS`` and ``MIN_EXPONENT``
times q words, which no neighbouring word extends. Basic factors are the stretches of a power of
two of words; equal ones have one name, made of the names of their halves. Within twice its length
a factor's occurrences form an arithmetic progression whose difference is its period, so successor
occurrences at most a factor's length away propose periods. Each period q is taken at its home,
the least factor length L with q <= L. Inside a run of that period every factor's successor is
exactly q away; so consecutive places with that distance, extended by the last factor and the
period, are the run itself, both ends exact, and no other length proposes it again.

Only factors that occur twice go on to the next length, so ordinary prose ends after a few.
Documents of a slice go together, their names kept apart. A word is dropped if any run has it
after its first q words.

A null text has no words. Repeated rows get a row each; an empty table gives none. Only doc_id and
text are read. Documents without a doc_id are taken as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import documents, flat, slices, table, word_spans
from airloom.llm.hashing import mixed, word_hashes
from airloom.llm.sql import crc32_sql

MIN_WORDS = 6
MIN_EXPONENT = 4

SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed binary"
)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

#: Given a doc_id and its number of words, which original word stands at each place, or None.
Change = Callable[[int | None, int], np.ndarray | None]


def runs(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period.

    Equal values are equal words of one document; ``of`` numbers the documents.
    """
    n = len(values)
    places = np.arange(n)
    names = np.unique(values, return_inverse=True)[1]
    factor, found = 1, []
    while len(places):
        order = np.argsort(names, kind="stable")
        at = places[order]
        same = names[order][1:] == names[order][:-1]
        gap = np.zeros(len(places), np.int64)
        gap[order[:-1]] = np.where(same, at[1:] - at[:-1], 0)
        found.append(_progressions(places, gap, factor))

        again = np.zeros(len(places), bool)
        again[order[:-1]] |= same
        again[order[1:]] |= same
        name = np.full(n + factor, -1)
        name[places[again]] = names[again]
        left = places[again]
        left = left[name[left + factor] >= 0]
        left = left[of[left + factor] == of[left]]
        pairs = name[left] * (n + 1) + name[left + factor]
        places, names = left, np.unique(pairs, return_inverse=True)[1]
        factor *= 2
    start, length, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _progressions(places: np.ndarray, gap: np.ndarray, factor: int) -> np.ndarray:
    """Stretches of places with one successor distance that is at home in this factor length."""
    home = (2 * gap > factor) & (gap <= factor)
    at, period = places[home], gap[home]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    start, period = at[first], period[first]
    length = at[last] - start + factor + period
    long = length >= np.maximum(MIN_WORDS, MIN_EXPONENT * period)
    return np.stack([start[long], length[long], period[long]])


def find(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """Per document its words, its runs and the text without their repetitions.

    ``change`` replaces words by others of the same document before runs are looked for.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            data, at = flat(batch.column("text"))
            begin, end, first = word_spans(data, at)
            count = np.diff(first)
            of = np.repeat(np.arange(len(ids)), count)
            source = np.arange(len(begin))
            changed = set()
            for i, n in enumerate(count.tolist()):
                places = change(ids[i], n) if change else None
                if places is not None:
                    source[first[i] : first[i + 1]] = first[i] + places
                    changed.add(i)
            values = word_hashes(data, begin, end)[source]
            start, length, period = runs(mixed(values + of.astype(np.uint64)), of)
            edge = np.zeros(len(begin) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0

            owner = of[start]
            changed.update(owner.tolist())
            cut = np.searchsorted(owner, np.arange(len(ids) + 1))
            texts = []
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                words = data[a:b].tobytes().split()
                if i in changed:
                    own = slice(first[i], first[i + 1])
                    words = [words[k] for k in (source[own][kept[own]] - first[i]).tolist()]
                texts.append(b" ".join(words))
            own_runs = pa.StructArray.from_arrays(
                [pa.array(start - first[owner]), pa.array(length), pa.array(period)], fields=list(RUN)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(count.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), own_runs),
                    pa.array(texts, pa.binary()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents(docs).mapInArrow(search, SCHEMA)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """A tenth of the documents become periodic from some word on."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents"), planted)
    # The longest run; of equal ones the first, then that of the smallest period.
    ranked = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-F.col("best.less") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )



SQL = f"""
with given as (
    select row_number() over () as r, doc_id, {crc32_sql("doc_id::varchar")} as h,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
    from documents),
cut as (select *, len(w) as n, case when len(w) > 0 then (h // 10) % len(w) end as a from given),
period as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from cut),
changed as (
    select r, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(
        range(n), lambda i: case when i < a then w[i + 1] else w[1 + a + (i - a) % p] end) else w end as w
    from period),
tok as (select r, n, unnest(range(n)) as i, unnest(w) as word from changed),
pairs as (
    select x.r, x.i, y.i - x.i as d from tok x join tok y
    on x.r = y.r and x.word = y.word and y.i > x.i and {MIN_EXPONENT} * (y.i - x.i) <= x.n),
islands as (select *, i - row_number() over (partition by r, d order by i) as island from pairs),
stretches as (
    select r, d, min(i) as start, count(*) + d as length from islands group by r, d, island
    having count(*) + d >= greatest({MIN_WORDS}, {MIN_EXPONENT} * d)),
found as (
    select * from stretches s where not exists (
        select 1 from stretches t where t.r = s.r and t.d < s.d
        and t.start <= s.start and t.start + t.length >= s.start + s.length)),
runs as (
    select r, count(*) as n_runs, arg_min(struct_pack(start, length, d), (-length, start, d)) as best,
           string_agg(start || ',' || length || ',' || d || chr(10), '' order by start, d) as lines
    from found group by r),
kept as (
    select r, string_agg(word, ' ' order by i) as kept from tok k where not exists (
        select 1 from found f where f.r = k.r and k.i >= f.start + f.d and k.i < f.start + f.length)
    group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length,
       best.d as period, 1000 * best.length // best.d as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from changed left join runs using (r) left join kept using (r)"""
