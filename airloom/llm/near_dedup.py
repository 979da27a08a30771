"""MinHash near-dedup with odd sketches.

A document's set is its distinct word shingles. Equal sets are one class, stood for by its
smallest doc_id. Bands of MinHashes put similar classes in common buckets. A second MinHash sample,
the smallest hash of each of ``BINS`` ranges, is folded into a parity bitmap, the odd sketch: the
population count of two sketches' XOR tells how many samples differ, and so the similarity, with
an error below 0.01. Candidates whose estimate is not ``DEVIATIONS`` such errors below the
threshold are confirmed on their full sets.

Only what is connected is asked for, so not all pairs of a bucket are made. First every member is
compared with its bucket's smallest. Buckets whose members are then not all connected go on: small
ones with the pairs between their components, large ones in blocks of bounded size, where the
estimates choose the best edges that would connect them, ``FORESTS`` times over; all candidates
that are still between components follow. What was tried is not tried again. So no link is lost
but for bands: a pair at 0.8 has none in common once in two million, at 0.85 in 10^9.

Null texts and texts without words have no set and no links. A doc_id stands for one document;
equal rows are linked to themselves and each get a row. An empty table gives no rows. Only doc_id
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import documents, flat, materialize, slices, table, word_spans
from airloom.llm.components import components
from airloom.llm.hashing import grams, mixed, word_hashes
from airloom.session import broadcast_checked

SHINGLE = 3
#: Links are pairs with 100 * intersection >= PERCENT * union.
PERCENT = 85
#: The pipeline's stage: longer shingles, a lower threshold.
STAGE_SHINGLE = 5
STAGE_PERCENT = 80
BANDS = 28
ROWS = 4
BINS = 4096
BITS = 4096
#: Deviations, and a constant, by which an estimate may fall below the threshold.
DEVIATIONS = 6
SLACK = 0.01
#: Text bytes of a slice of candidate pairs, both sides.
PAIR_BYTES = 1_000_000
SMALL = 32
BLOCK = 2000
FORESTS = 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))

SIGNATURE = (
    "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, samples int, sketch array<long>"
)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a short text is one shingle."""
    data, at = flat(column)
    data = _LOWER[data]
    start, end, first = word_spans(data, at)
    words = word_hashes(data, start, end)
    every = grams(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        else:
            yield grams(words[a:b], b - a) if b > a else every[:0]


def odd_sketch(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """Samples and parity bitmap of a sorted set: the smallest hash of each range of hashes."""
    ranges = hashes >> np.uint64(64 - BINS.bit_length() + 1)
    samples = hashes[np.flatnonzero(np.diff(ranges, prepend=~ranges[:1]))]
    place = (mixed(samples) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    parity = np.bincount(place, minlength=BITS) & 1
    return len(samples), np.packbits(parity.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column("text"), size))
            counts = np.array([len(s) for s in sets])
            full = np.flatnonzero(counts)
            every = np.concatenate([*sets, np.zeros(0, np.uint64)])
            begin = (np.cumsum(counts) - counts)[full]
            lows = np.zeros((BANDS * ROWS, len(full)), np.uint64)
            sums = np.zeros((2, len(sets)), np.uint64)
            if len(full):
                for i, seed in enumerate(_SEEDS):
                    lows[i] = np.minimum.reduceat((every ^ seed) * (seed | np.uint64(1)), begin)
                for i in range(2):
                    sums[i, full] = np.add.reduceat(mixed(every ^ _SEEDS[i]), begin)
            bands = np.zeros((BANDS, len(full)), np.uint64)
            for i in range(BANDS):
                bands[i] = np.uint64(i)
                for low in lows[i * ROWS : (i + 1) * ROWS]:
                    bands[i] = mixed(bands[i] * _SEEDS[0] + low)
            own: list = [[] for _ in sets]
            for i, column in zip(full.tolist(), bands.T.view(np.int64).tolist(), strict=True):
                own[i] = column
            sketches = [odd_sketch(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array(own, pa.list_(pa.int64())),
                    pa.array([n for n, _ in sketches], pa.int32()),
                    pa.array([s.tolist() for _, s in sketches], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "s1", "s2", "bands", "samples", "sketch"],
            )

    return documents(docs).mapInArrow(sign, SIGNATURE)


def _surplus(differing, samples, size_a, size_b, near: float, exp, log, sqrt):
    """By how much the estimated similarity of two sketches is above the least that a pair of
    similarity ``near`` can show; columns or arrays, with their functions.

    The differing bits tell how many of all ``samples`` are in one sketch only. Of the ranges that
    hold any of the two sets, a share that is the similarity has the same sample for both; their
    number follows from the size of the union. The errors are those of taking as many elements of
    the union as there are ranges, and of two samples falling on one bit.
    """

    def ranges(size):
        return (1 - exp(-size / BINS)) * BINS

    apart = log(1 - 2 * differing / BITS) * (-BITS / 2)
    union = (size_a + size_b) / (1 + near)
    held = ranges(union) * samples / (ranges(size_a) + ranges(size_b))
    estimate = (samples - apart) / 2 / held
    expected = samples - 2 * near * held
    folded = (exp(4 * expected / BITS) - 1) * (BITS / 4) - expected
    variance = near * (1 - near) / held * (1 - held / union) + folded / (4 * held * held)
    return estimate - near + SLACK + sqrt(variance) * DEVIATIONS


def _likely(pairs: DataFrame, sketches: DataFrame, near: float) -> DataFrame:
    """Pairs whose odd sketches are similar enough."""

    def side(name: str) -> DataFrame:
        return sketches.select(
            F.col("doc_id").alias(name),
            F.col("samples").alias(f"m_{name}"),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("sketch").alias(f"s_{name}"),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    bits = [F.bit_count(F.get("s_a", F.lit(i)).bitwiseXOR(F.get("s_b", F.lit(i)))) for i in range(BITS // 64)]
    differing = bits[0]
    for x in bits[1:]:
        differing = differing + x
    # Beyond half of the bits a sketch tells nothing; such pairs are far below any threshold.
    both = both.withColumn("d", differing.cast("double")).filter(2 * F.col("d") < BITS)
    surplus = _surplus(
        F.col("d"), F.col("m_a") + F.col("m_b"), F.col("n_a"), F.col("n_b"), near, F.exp, F.log,
        lambda x: F.sqrt(F.greatest(x, F.lit(0.0))),
    )
    return both.filter(surplus >= 0).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs that are similar enough on their full sets."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    ids = broadcast_checked(materialize(ids.distinct(), "candidates"))
    needed = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")

    def side(name: str) -> DataFrame:
        return needed.select(F.col("doc_id").alias(name), F.col("text").alias(f"text_{name}"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", "text_b", size=PAIR_BYTES):
            # A bucket's smallest is in many pairs; its set is made once.
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            first = {x: i for i, x in reversed(list(enumerate(a)))}
            left = batch.column("text_a").take(pa.array(first.values(), pa.int64()))
            sets = dict(zip(first, shingle_sets(left, size), strict=True))
            passed = []
            for x, y, other in zip(a, b, shingle_sets(batch.column("text_b"), size), strict=True):
                common = len(np.intersect1d(sets[x], other, assume_unique=True))
                if 100 * common >= percent * (len(sets[x]) + len(other) - common):
                    passed.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in passed], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(confirm, "a long, b long")


def _pairs_of_small(members: DataFrame) -> DataFrame:
    """All pairs between components of buckets with at most SMALL members."""
    few = members.filter(F.col("size") <= SMALL).select("b", "doc_id", "label")
    other = few.select(F.col("b").alias("bucket"), F.col("doc_id").alias("y"), F.col("label").alias("other"))
    met = few.join(
        other, (F.col("b") == F.col("bucket")) & (F.col("doc_id") < F.col("y")) & (F.col("label") != F.col("other"))
    )
    return met.select(F.col("doc_id").alias("a"), F.col("y").alias("b")).distinct()


def _surpluses(
    x: np.ndarray, sketches: np.ndarray, samples: np.ndarray, size: int, sizes: np.ndarray, near: float
) -> np.ndarray:
    """The same of one sketch with many."""
    # Counted unsigned: of negative numbers numpy counts the bits of their absolute value.
    differing = np.bitwise_count((sketches ^ x).view(np.uint64)).sum(axis=1, dtype=np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = _surplus(
            differing, samples, size, sizes, near, np.exp, np.log, lambda v: np.sqrt(np.maximum(v, 0))
        )
    return np.where(2 * differing < BITS, out, -1.0)


def _pairs_of_large(members: DataFrame, sketches: DataFrame, near: float, every: bool) -> DataFrame:
    """Likely pairs between components of larger buckets, block against block.

    A pair is looked at in the first bucket that both are in. Unless ``every``, only those that
    connect the components, the most similar first.
    """
    large = members.filter(F.col("size") > SMALL).join(sketches, "doc_id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    dealt = large.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"i": F.least("own", "with"), "j": F.greatest("own", "with")})

    def choose(group: pa.Table) -> pa.Table:
        doc, label, own = (group[c].to_numpy() for c in ("doc_id", "label", "own"))
        bits = np.array(group["sketch"].to_pylist(), np.int64)
        samples, sizes = (group[c].to_numpy().astype(np.int64) for c in ("samples", "n_shingles"))
        bands, bucket = np.array(group["bands"].to_pylist(), np.int64), group["b"][0].as_py()
        across = len(np.unique(own)) > 1
        found: list[tuple[float, int, int]] = []
        for k in range(len(doc)):
            after = slice(k + 1, None)
            both = samples[k] + samples[after]
            surplus = _surpluses(bits[k], bits[after], both, int(sizes[k]), sizes[after], near)
            ok = (surplus >= 0) & (label[after] != label[k])
            if across:
                ok &= own[after] != own[k]
            hits = np.flatnonzero(ok)
            first = (bands[after][hits] == bands[k]).argmax(axis=1)
            hits = hits[bands[k][first] == bucket]
            if not every and len(hits):
                # The best edge to each other component is enough for this round.
                order = hits[np.argsort(-surplus[hits], kind="stable")]
                hits = order[np.unique(label[after][order], return_index=True)[1]]
            found += [(float(surplus[h]), k, k + 1 + int(h)) for h in hits]
        parent = {x: x for x in np.unique(label).tolist()}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for _, k, h in sorted(found, reverse=True):
            x, y = top(int(label[k])), top(int(label[h]))
            if every or x != y:
                parent[max(x, y)] = min(x, y)
                out.append((min(int(doc[k]), int(doc[h])), max(int(doc[k]), int(doc[h]))))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return dealt.groupBy("b", "i", "j").applyInArrow(choose, "a long, b long").distinct()


def _crowded(reps: DataFrame) -> DataFrame:
    """Rows (b, doc_id, centre, size): members of buckets with two or more."""
    banded = reps.select("doc_id", F.explode("bands").alias("b"))
    buckets = banded.groupBy("b").agg(F.min("doc_id").alias("centre"), F.count("*").alias("size"))
    return banded.join(buckets.filter(F.col("size") > 1), "b")


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for every row of docs."""
    docs = documents(docs)
    near = percent / 100
    signed = materialize(signatures(docs, size), "signatures")
    sets = signed.filter(F.col("n_shingles") > 0)
    equal = sets.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    reps = sets.join(equal.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sketches = materialize(reps.select("doc_id", "n_shingles", "bands", "samples", "sketch"), "sketches")
    crowded = materialize(_crowded(sketches), "crowded")

    pairs = crowded.filter(F.col("doc_id") != F.col("centre"))
    pairs = pairs.select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    tried, links, rounds, every = None, None, 0, False
    while True:
        pairs = materialize(pairs, "pairs")
        if not pairs.isEmpty():
            likely = materialize(_likely(pairs, sketches, near), "likely")
            new = materialize(_confirmed(likely, docs, size, percent).distinct(), "links")
            tried = pairs if tried is None else tried.unionByName(pairs)
            links = new if links is None else links.unionByName(new)
            found = materialize(components(links), "components")
            label = F.coalesce("component", "doc_id").alias("label")
            members = crowded.join(found, F.col("doc_id") == F.col("node"), "left").select(
                "b", "doc_id", "size", label
            )
            members = materialize(members, "members")
            mixed_ = members.groupBy("b").agg(F.min("label").alias("x"), F.max("label").alias("y"))
            members = members.join(mixed_.filter(F.col("x") < F.col("y")).select("b"), "b", "left_semi")
            every = rounds >= FORESTS
        elif tried is None or every:
            break
        else:
            # The best edges were all tried; others of the same buckets may not have been.
            every = True
        pairs = _pairs_of_small(members).unionByName(_pairs_of_large(members, sketches, near, every))
        pairs = pairs.distinct().join(tried, ["a", "b"], "left_anti")
        rounds += 1
    component = F.col("rep")
    out = signed.join(equal, ["s1", "s2"], "left").withColumn("rep", F.when(F.col("n_shingles") > 0, F.col("rep")))
    if links is not None:
        out = out.join(found, F.col("rep") == F.col("node"), "left")
        component = F.coalesce("component", "rep")
    return out.select("doc_id", "n_shingles", F.coalesce(component, "doc_id").alias("component_id"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(table(spark, folder, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component: its smallest."""
    found = classes(docs, STAGE_SHINGLE, STAGE_PERCENT)
    copies = found.filter(F.col("doc_id") != F.col("component_id"))
    copies = broadcast_checked(materialize(copies.select("doc_id"), "copies"))
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


SQL = f"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents),
sets as (
    select doc_id, case when len(w) = 0 then [] else list_distinct(
        case when len(w) < {SHINGLE} then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - {SHINGLE - 2}),
                            lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) end) end as s
    from words),
shingles as (select doc_id, len(s) as n, unnest(s) as h from sets),
links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.h = b.h and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach as (
    select doc_id as node, doc_id as top from sets
    union
    select l.b, r.top from reach r join links l on l.a = r.node)
select doc_id, len(s)::bigint as n_shingles, min(top) as component_id, doc_id = min(top) as kept
from sets join reach on node = doc_id group by doc_id, s"""
