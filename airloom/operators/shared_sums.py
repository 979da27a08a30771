"""Small forests of many models from sums that the models share.

Models that leave out a part or a fold of the same rows mostly split alike. All models with the same
splits so far, a history, read the same sums: of rows and targets by (slot, node, column, bin), a slot
being the rows of one part and fold, and of rows by the leaf they reached in each earlier tree, since
a cell's summed prediction is the sum of its counts times a model's own leaf values. A model adds
the slots it trains on; nothing is subtracted that could cancel. So a pass over the rows costs as much
as there are histories, at worst one a model, and no row stores predictions.

With more parts than slots, a slot is a range of parts. The sums of the other ranges then go to the
tasks, which sum the parts of each range on their own and find the splits there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.operators import trees as T
from airloom.session import fresh_path, materialize

#: Numbers that one slot of one history may take, and all of them in a task.
SLOT_CELLS = 1 << 18
ROOM = 1 << 22
MAX_SLOTS = 256
#: Histories summed in one pass.
HISTORIES = 8
#: Rows that a task sums at once.
BLOCK = 200_000

#: Rows of a block of the table of bins, and of a partition.
PACKED_ROWS = 50_000
PART_ROWS = 1_000_000

_FOUND = "model int, node int, all_h double, all_g double, gain double, column int, cut int, right boolean, g double, h double"


def _cells(models: Sequence[T.Model], width: int) -> int:
    depth, rounds = max(m.setting.depth for m in models), max(m.setting.rounds for m in models)
    if depth > 16:
        return ROOM
    return (1 << (depth - 1)) * width * (2 + (rounds - 1) * ((2 << depth) - 1))


def fits(models: Sequence[T.Model], features: int) -> bool:
    """Whether these models are few and small enough for dense sums."""
    bins = sum({m.setting.bins for m in models})
    cells = _cells(models, features * (bins + 2))
    parts, folds = {m.part for m in models}, {m.fold for m in models}
    slots = (len(parts) + 1) * (len(folds) + 1)
    small = max(m.setting.rounds for m in models) <= T.FLUSH and cells <= SLOT_CELLS
    return small and (folds == {None} or (slots <= MAX_SLOTS and slots * cells <= ROOM))


class Slots:
    """Numbers of the rows' parts and folds, and the slots that each model leaves out."""

    def __init__(self, models: Sequence[T.Model], cells: int) -> None:
        self.parts = np.array(sorted({m.part for m in models if m.part is not None}), np.int64)
        self.folds = np.array(sorted({m.fold for m in models if m.fold is not None}), np.int64)
        most = max(16, min(MAX_SLOTS, ROOM // max(1, cells)))
        parts, folds = len(self.parts) + 1, len(self.folds) + 1
        #: Parts in a range.
        self.width = 1 if len(self.folds) or parts <= most else -(-parts // most)
        self.count = folds * (-(-parts // self.width))
        self.own_part = np.array([-1 if m.part is None else self.parts.searchsorted(m.part) for m in models])
        self.own_fold = np.array([-1 if m.fold is None else self.folds.searchsorted(m.fold) for m in models])

    @staticmethod
    def _number(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        at = of.searchsorted(values)
        return np.where(of.take(np.minimum(at, len(of) - 1)) == values, at, len(of)) if len(of) else np.zeros(len(values), np.int64)

    def number(self, part: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Rows of no model's part or fold are numbered last."""
        return self._number(part, self.parts) * (len(self.folds) + 1) + self._number(fold, self.folds)

    def trained(self, models: np.ndarray) -> np.ndarray:
        """A line per model: 1 at each slot it trains on, for ranges of one part."""
        part, fold = np.divmod(np.arange(self.count), len(self.folds) + 1)
        return ((part != self.own_part[models][:, None]) & (fold != self.own_fold[models][:, None])).astype(float)


def binned(
    given: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, part: Column, fold: Column,
    cuts: Sequence[np.ndarray], slots: Slots, draws: Sequence[Column],
) -> DataFrame:
    """Blocks of the rows that some model may train on: a row holds those of one range of slots, each
    column an array of their numbers. Blocks, not rows, are dealt. ``draws`` are made from ``__key``."""
    kept, names = ["__part", "__fold", "__y"], [f"__c{i}" for i in range(len(features))]
    ready = given.select(
        part.cast("int").alias("__part"), fold.cast("int").alias("__fold"),
        F.xxhash64(*[F.col(f"`{c}`") for c in keys]).alias("__key"), T._cell(target).alias("__y"),
        *[T._cell(c).alias(x) for c, x in zip(features, names, strict=True)],
    ).where("__part >= 0")
    dealt = max(given.sparkSession.sparkContext.defaultParallelism, -(-given.count() // PART_ROWS))
    drawn = [f"__d{i}" for i in range(len(draws))]
    ready = ready.select(*kept, *names, *[d.alias(x) for d, x in zip(draws, drawn, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, PACKED_ROWS):
            part, fold = (table.column(c).fill_null(-1).to_numpy().astype(np.int32) for c in ("__part", "__fold"))
            slot = slots.number(part, fold).astype(np.int32)
            bins = _bins([table.column(c) for c in names], cuts)
            draw = np.stack([table.column(c).to_numpy() for c in drawn], 1) if drawn else np.zeros((len(slot), 0))
            order = np.argsort(slot // slots.width, kind="stable") if slots.width > 1 else np.arange(len(slot))
            ranges, first = np.unique(slot[order] // slots.width, return_index=True) if slots.width > 1 else ([0], [0])
            for r, own in zip(ranges, np.split(order, first[1:]), strict=True):
                cells = [x[own].tobytes() for x in (part, fold, table.column("__y").to_numpy(), slot, bins, draw)]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *[pa.array([x], pa.binary()) for x in cells]], ["__range", *_PACKED])

    return ready.mapInArrow(run, "__range int, " + ", ".join(f"{c} binary" for c in _PACKED)).repartition(dealt)


_PACKED = {"__part": np.int32, "__fold": np.int32, "__y": np.float64, "__slot": np.int32, "__bins": np.int16, "__draw": np.float64}


def _unpacked(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The range and the columns of every block."""
    for batch in batches:
        ranges = batch.column("__range").to_pylist()
        for i, r in enumerate(ranges):
            yield r, [np.frombuffer(batch.column(c)[i].as_buffer(), _PACKED[c]) for c in names]


def _joined(blocks: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*blocks, strict=True)]


def _bins(cells: Sequence[pa.Array], cuts: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty((len(cells[0]), len(cuts)), np.int16)
    for i, of in enumerate(cuts):
        own = cells[i % len(cells)].to_numpy(zero_copy_only=False).astype(float)
        out[:, i] = np.where(np.isnan(own), -1, np.searchsorted(of, own, "right"))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, n = [], 0
    if n:
        yield pa.Table.from_batches(kept).combine_chunks()


class Level:
    """One level of one tree: what tasks need to sum it and to find its splits."""

    def __init__(self, models, widths, done: list[T.Round], now: T.Round, level: int, open_, allowed, centre: float) -> None:
        self.widths, self.level, self.centre = widths, level, centre
        self.nodes, self.leaves = 1 << level, now.column.shape[1]
        self.size = 2 + len(done) * self.leaves
        self.cells = self.nodes * sum(widths)
        self.done, self.now, self.open, self.allowed = done, now, open_, allowed
        self.mean, self.deviation, self.l1, self.l2, self.share = (
            np.array([float(x) for x in xs])
            for xs in zip(*[(m.mean, m.deviation, m.setting.l1, m.setting.l2, m.setting.row_share) for m in models], strict=True)
        )
        grown = np.flatnonzero(open_.any(axis=1))
        marks = [self.share[grown, None]]
        for t in [*done, now]:
            marks += [t.column[grown], t.cut[grown], t.left[grown]]
        _, first, which = np.unique(np.concatenate(marks, axis=1), axis=0, return_index=True, return_inverse=True)
        #: A model of each history, and the models of each.
        self.firsts = grown[first]
        order = np.argsort(which.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(which.ravel(), minlength=len(first)))[:-1]
        self.members = [grown[x] for x in np.split(order, ends)]

    def histories(self, these: Sequence[int]) -> Histories:
        at = self.firsts[list(these)]
        return Histories([t.only(at) for t in self.done], self.now.only(at), self.share[at], self.level, self.leaves, self.widths, self.size, self.centre)

    def splits(self, models: np.ndarray, sums: np.ndarray) -> list[np.ndarray]:
        """Columns of ``_FOUND`` for the open nodes of models of one history, from the sums (model,
        cell, number) of the rows they train on."""
        sums = sums.reshape(len(models), self.cells, self.size)
        h = sums[:, :, 0]
        g = -(sums[:, :, 1] - h * (self.mean[models] - self.centre)[:, None]) / self.deviation[models][:, None]
        for t, tree in enumerate(self.done):
            at = 2 + t * self.leaves
            g = g + np.einsum("mcl,ml->mc", sums[:, :, at : at + self.leaves], tree.value[models])
        l1, l2 = self.l1[models][:, None, None, None], self.l2[models][:, None, None, None]

        def worth(g, h):
            drawn = np.maximum(np.abs(g) - l1, 0)
            weight = h + l2
            return np.where(weight > 0, drawn * drawn / np.where(weight > 0, weight, 1), 0.0)

        gains, lefts, whole, at = [], [], None, 0
        for c, width in enumerate(self.widths):
            own_h, own_g = (x[:, at : at + self.nodes * width].reshape(len(models), self.nodes, width, 1) for x in (h, g))
            at += self.nodes * width
            all_h, all_g = own_h.sum(axis=2, keepdims=True), own_g.sum(axis=2, keepdims=True)
            whole = whole or (all_h[:, :, 0, 0], all_g[:, :, 0, 0])
            # Missing cells to the right, then to the left: of equal gains the first wins.
            gone = np.array([1.0, 0.0])
            left_h = own_h.cumsum(axis=2) - own_h[:, :, :1] * gone
            left_g = own_g.cumsum(axis=2) - own_g[:, :, :1] * gone
            rest_h, rest_g = all_h - left_h, all_g - left_g
            gain = worth(left_g, left_h) + worth(rest_g, rest_h) - worth(all_g, all_h)
            good = (own_h > 0) & (left_h >= T.MIN_SIDE) & (rest_h >= T.MIN_SIDE) & (gain > T.LEAST_GAIN)
            good &= self.allowed[models, c][:, None, None, None]
            gains.append(np.where(good, gain, -np.inf).reshape(len(models), self.nodes, -1))
            lefts.append((left_g.reshape(gains[-1].shape), left_h.reshape(gains[-1].shape)))
        gain = np.concatenate(gains, axis=2)
        best = gain.argmax(axis=2)

        def taken(x: np.ndarray) -> np.ndarray:
            return np.take_along_axis(x, best[:, :, None], axis=2)[:, :, 0]

        left_g, left_h = (taken(np.concatenate(x, axis=2)) for x in zip(*lefts, strict=True))
        begin = np.cumsum([0, *[2 * w for w in self.widths]])
        column = np.searchsorted(begin, best, "right") - 1
        cut, right = (best - begin[column]) // 2, (best - begin[column]) % 2 == 0
        first = self.nodes - 1
        m, node = np.nonzero(self.open[models])
        pick = (x[m, node] for x in (whole[0], whole[1], taken(gain), column, cut, right, left_g, left_h))
        return [models[m], node + first, *pick]


class Histories:
    """The structures that tasks walk to sum rows."""

    def __init__(self, done, now, share, level, leaves, widths, size, centre) -> None:
        self.done, self.now, self.share, self.level = done, now, share, level
        self.leaves, self.widths, self.size, self.centre = leaves, widths, size, centre

    def add(self, block: list[np.ndarray], slot: np.ndarray, slots: int, into: list[np.ndarray]) -> None:
        """Adds rows (__y, __bins, __draw) to the sums (slot, cell, number) of every history."""
        y, bins, draw = block[0] - self.centre, block[1].reshape(len(slot), -1), block[2]
        # The draws of all trees stand side by side; without any, all rows are used.
        draw = draw.reshape(len(slot), -1)[:, len(self.done)] if len(draw) else None
        nodes = 1 << self.level
        found = self.now.nodes(bins, self.level) - (nodes - 1)
        depth = (self.leaves + 1).bit_length() - 2
        reached = [t.nodes(bins, depth) for t in self.done]
        places = np.ascontiguousarray(bins.T).astype(np.int64) + 1
        for k, total in enumerate(into):
            used = found[k] >= 0
            if draw is not None:
                used &= draw < self.share[k]
            row = None if used.all() else np.flatnonzero(used)

            def own(x: np.ndarray, row=row) -> np.ndarray:
                return x if row is None else x.take(row)

            base = own(slot) * nodes + own(found[k])
            own_y, own_leaves = own(y), [own(r[k]) for r in reached]
            at = 0
            for place, width in zip(places, self.widths, strict=True):
                key, n = base * width + own(place), slots * nodes * width
                part = total[:, at : at + nodes * width]
                part[:, :, 0] += np.bincount(key, minlength=n).reshape(slots, -1)
                part[:, :, 1] += np.bincount(key, weights=own_y, minlength=n).reshape(slots, -1)
                for t, leaf in enumerate(own_leaves):
                    counts = np.bincount(key * self.leaves + leaf, minlength=n * self.leaves)
                    part[:, :, 2 + t * self.leaves : 2 + (t + 1) * self.leaves] += counts.reshape(slots, -1, self.leaves)
                at += nodes * width

    def empty(self, slots: int) -> np.ndarray:
        return np.zeros((slots, (1 << self.level) * sum(self.widths), self.size))


_USED = ["__slot", "__y", "__bins", "__draw"]


def _summed(state: DataFrame, work: Histories, slots: Slots, these: int) -> list[np.ndarray]:
    """Sums of every history by slot, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kept, n = [work.empty(slots.count) for _ in range(these)], [], 0

        def add() -> None:
            slot, *block = _joined(kept)
            work.add(block, slot.astype(np.int64) // slots.width, slots.count, total)
            kept.clear()

        for _, block in _unpacked(batches, _USED):
            kept.append(block)
            n += len(block[0])
            if n >= BLOCK:
                add()
                n = 0
        if n:
            add()
        for k, sums in enumerate(total):
            some = np.flatnonzero(sums[:, :, 0].any(axis=1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array([sums[s].tobytes() for s in some], pa.binary())],
                ["history", "slot", "sums"],
            )

    def added(group: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py()) for x in group.column("sums"))
        return pa.table([group.column("history")[:1], group.column("slot")[:1], pa.array([whole.tobytes()], pa.binary())], group.column_names)

    kind = "history int, slot int, sums binary"
    found = state.mapInArrow(run, kind).groupBy("history", "slot").applyInArrow(added, kind)
    out = [work.empty(slots.count) for _ in range(these)]
    for r in found.collect():
        out[r["history"]][r["slot"]] = np.frombuffer(r["sums"]).reshape(out[0].shape[1:])
    return out


def _others(sums: np.ndarray) -> np.ndarray:
    """For every slot the sums of all others: those before it and those after it."""
    out = np.zeros_like(sums)
    out[1:] = np.cumsum(sums[:-1], axis=0)
    out[:-1] += np.cumsum(sums[:0:-1], axis=0)[::-1]
    return out


def _by_range(state: DataFrame, level: Level, work: Histories, slots: Slots, these: list[int], sums: list[np.ndarray]) -> list:
    """The splits of models whose parts share a slot, found by the task that has the range."""
    spark = state.sparkSession
    rest = spark.sparkContext.broadcast([_others(s) for s in sums])
    members = [level.members[k] for k in these]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        kept: dict[int, list] = {}

        def add(r: int) -> None:
            slot, *block = _joined(kept.pop(r))
            work.add(block, slot.astype(np.int64) - r * slots.width, slots.width, total[r])

        for r, block in _unpacked(batches, _USED):
            if r not in total:
                total[r] = [work.empty(slots.width) for _ in these]
            kept.setdefault(r, []).append(block)
            if sum(len(b[0]) for b in kept[r]) >= BLOCK // 8:
                add(r)
        for r in list(kept):
            add(r)
        for r, own in total.items():
            for k, models in enumerate(members):
                part = slots.own_part[models]
                inside = models[(part >= 0) & (part // slots.width == r)]
                if len(inside):
                    trained = _others(own[k])[slots.own_part[inside] - r * slots.width] + rest.value[k][r]
                    yield _as_batch(level.splits(inside, trained))

    dealt = state.repartition(max(spark.sparkContext.defaultParallelism, slots.count // 8), "__range")
    found = [[c.to_numpy() for c in dealt.mapInArrow(run, _FOUND).toArrow().columns]]
    # Models that leave nothing out, and those of ranges without rows.
    for k, models in enumerate(members):
        left = np.setdiff1d(models, found[0][0])
        if len(left):
            part = slots.own_part[left]
            trained = np.where((part >= 0)[:, None, None], rest.value[k][part // slots.width], sums[k].sum(axis=0))
            found.append(level.splits(left, trained))
    rest.unpersist()
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def _as_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 3, pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 2]
    names = [x.split()[0] for x in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x).cast(k) for x, k in zip(columns, kinds, strict=True)], names)


def best_splits(state: DataFrame, level: Level, slots: Slots) -> list[np.ndarray]:
    """Columns of ``_FOUND`` for every open node of every model."""
    found: list[list[np.ndarray]] = []
    size = max(1, min(HISTORIES, 4 * ROOM // max(1, slots.count * level.cells * level.size)))
    for at in range(0, len(level.members), size):
        these = list(range(at, min(at + size, len(level.members))))
        work = level.histories(these)
        sums = _summed(state, work, slots, len(these))
        if slots.width > 1:
            found.append(_by_range(state, level, work, slots, these, sums))
            continue
        for k, own in zip(these, sums, strict=True):
            flat, models = own.reshape(slots.count, -1), level.members[k]
            step = max(1, ROOM // flat.shape[1])
            for i in range(0, len(models), step):
                some = models[i : i + step]
                found.append(level.splits(some, slots.trained(some) @ flat))
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else []


def take(now: T.Round, found: list[np.ndarray], level: int) -> np.ndarray:
    """Enters the splits of a level; which nodes of the next one are open."""
    first = (1 << (level + 1)) - 1
    open_ = np.zeros((len(now.column), 1 << (level + 1)), bool)
    if not found:
        return open_
    m, node, all_h, all_g, gain, column, cut, right, g, h = found
    if level == 0:
        now.g[m, 0], now.h[m, 0] = all_g, all_h
    some = gain > -np.inf
    m, node, gain, column, cut, right, g, h = (x[some] for x in (m, node, gain, column, cut, right, g, h))
    now.column[m, node], now.cut[m, node], now.left[m, node], now.gain[m, node] = column, cut, ~right.astype(bool), gain
    a, b = 2 * node + 1, 2 * node + 2
    now.g[m, a], now.h[m, a] = g, h
    now.g[m, b], now.h[m, b] = now.g[m, node] - g, now.h[m, node] - h
    open_[m, a - first] = open_[m, b - first] = True
    return open_


def _outputs(rounds: Sequence[T.Round], bins: np.ndarray, model: np.ndarray) -> np.ndarray:
    """What the trees of each row's own model add up to."""
    total = np.zeros(len(bins))
    begin = np.arange(len(bins)) * bins.shape[1]
    flat = np.ascontiguousarray(bins).ravel()
    for t in rounds:
        size = t.column.shape[1]
        root, at = model * size, np.zeros(len(bins), np.int64)
        for _ in range((size + 1).bit_length() - 2):
            column = t.column.ravel().take(root + at)
            own = flat.take(begin + np.maximum(column, 0))
            right = np.where(own < 0, ~t.left.ravel().take(root + at), own >= t.cut.ravel().take(root + at))
            at = np.where(column >= 0, 2 * at + 1 + right, at)
        total += t.value.ravel().take(root + at)
    return total


def grow(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, models: Sequence[T.Model],
    part: Column, fold: Column, stages: Sequence[int] = (), at_stage=None, held: bool = False,
) -> T.Forest:
    """As ``trees.grow``, for any number of models that fit."""
    spark = df.sparkSession
    kinds = sorted({m.setting.bins for m in models})
    cuts = [c for b in kinds for c in T.find_cuts(df, features, b)]
    widths = [len(c) + 2 for c in cuts]
    count, depth = len(models), max(m.setting.depth for m in models)
    rounds = max(m.setting.rounds for m in models)
    given = df.where(T._cell(target).isNotNull())
    slots = Slots(models, _cells(models, sum(widths)))
    draws = []
    if any(m.setting.row_share < 1 for m in models):
        draws = [T.draw_of(models[0].setting.seed, tree) for tree in range(rounds)]
    state = materialize(binned(given, keys, features, target, part, fold, cuts, slots, draws), "boosting")
    drawn = state.select("__range", *_USED)
    centre = float(np.median([m.mean for m in models]))
    path, done = fresh_path(spark, "trees"), []
    for tree in range(rounds):
        active = np.array([tree < m.setting.rounds for m in models])
        columns = {m.setting: T._drawn_columns(m.setting, tree, len(features), kinds) for m in models}
        allowed = np.stack([columns[m.setting] for m in models])
        now, open_ = T.Round.empty(count, depth), active[:, None].copy()
        for level in range(depth):
            open_ &= np.array([m.setting.depth > level for m in models])[:, None]
            if not open_.any():
                break
            found = best_splits(drawn, Level(models, widths, done, now, level, open_, allowed, centre), slots)
            open_ = take(now, found, level)
        now.close(models)
        now.value[~active] = 0.0
        nodes = zip(*now.rows(tree, active, len(features), cuts), strict=True)
        table = pa.table([pa.array(x, f.type) for x, f in zip(nodes, _TREES, strict=True)], schema=_TREES)
        spark.createDataFrame(table).coalesce(1).write.mode("append").parquet(path)
        done.append(now)
        if at_stage is not None and tree + 1 in stages:
            at_stage(tree + 1, (_held_out if held else _with_outputs)(state, list(done), models, len(cuts)))
    found = spark.read.schema(T.TREES).parquet(path)
    return T.Forest(list(models), list(features), found, given, df.columns, done, cuts)


_TREES = pa.schema([
    ("model", pa.int32()), ("tree", pa.int32()), ("place", pa.int32()), ("column", pa.int32()), ("threshold", pa.float64()),
    ("missing_left", pa.bool_()), ("child", pa.int32()), ("value", pa.float64()), ("gain", pa.float64()), ("cover", pa.float64()),
])


def _held_out(state: DataFrame, done: list[T.Round], models: Sequence[T.Model], columns: int) -> DataFrame:
    """Sums ``T.ERRORS`` of every model on the fold it leaves out. A row is walked by the models of its
    fold only, and once by those that split alike."""
    kept = ["__part", "__fold", "__y", "__bins"]
    mean, deviation = np.array([m.mean for m in models]), np.array([m.deviation for m in models])
    part = np.array([-9 if m.part is None else m.part for m in models])
    depth = (done[0].column.shape[1] + 1).bit_length() - 2
    marks = np.concatenate([x for t in done for x in (t.column, t.cut, t.left)], axis=1)
    alike = np.unique(marks, axis=0, return_inverse=True)[1].ravel()
    of_fold: dict[int, dict[int, list[int]]] = {}
    for i, m in enumerate(models):
        if m.fold is not None:
            of_fold.setdefault(m.fold, {}).setdefault(int(alike[i]), []).append(i)
    # One model's trees stand for those that split like them.
    walks = {f: [([t.only(np.array(own[:1])) for t in done], own) for own in those.values()] for f, those in of_fold.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, n = np.zeros(len(models)), np.zeros(len(models))
        for _, (own_part, fold, y, bins) in _unpacked(batches, kept):
            bins = bins.reshape(-1, columns)
            for f, those in walks.items():
                row = np.flatnonzero((fold == f) & (own_part >= 0))
                row_y, row_part, row_bins = y.take(row), own_part.take(row), bins.take(row, axis=0)
                for trees, own in those if len(row) else ():
                    reached = [t.nodes(row_bins, depth)[0] for t in trees]
                    for m in own:
                        gap = sum(t.value[m].take(at) for t, at in zip(done, reached, strict=True)) - (row_y - mean[m]) / deviation[m]
                        there = row_part != part[m]
                        e[m] += (gap * gap).sum(where=there)
                        n[m] += there.sum()
        yield T.as_errors(e, n)

    return state.select("__range", *kept).mapInArrow(run, T.ERRORS)


def _with_outputs(state: DataFrame, done: list[T.Round], models: Sequence[T.Model], columns: int) -> DataFrame:
    """Rows (__part, __fold, __y, __preds) with what all models' trees add up to."""
    kept, count = ["__part", "__fold", "__y", "__bins"], len(models)
    most = max(1, min(10_000, T.SLAB_CELLS // count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (*own, bins) in _unpacked(batches, kept):
            bins = bins.reshape(-1, columns)
            for at in range(0, len(bins), most):
                preds = sum(t.outputs(bins[at : at + most]) for t in done).T
                yield pa.RecordBatch.from_arrays([*[pa.array(x[at : at + most]) for x in own], T._binary(preds)], [*kept[:-1], "__preds"])

    return state.select("__range", *kept).mapInArrow(run, "__part int, __fold int, __y double, __preds binary")


def predictions(forest: T.Forest, out: str, own: Column | None) -> DataFrame:
    """The rows with every model's prediction, or with that of the model numbered ``own``."""
    done, cuts = forest.done, forest.cuts
    mean, deviation = (np.array([getattr(m, k) for m in forest.models]) for k in ("mean", "deviation"))
    cells = [T._cell(c) for c in forest.features]

    @F.arrow_udf("array<double>")
    def every(*cells: pa.Array) -> pa.Array:
        preds = sum(t.outputs(_bins(cells, cuts)) for t in done).T * deviation + mean
        return pa.ListArray.from_arrays(pa.array(np.arange(len(preds) + 1, dtype=np.int32) * len(mean)), pa.array(preds.ravel()))

    @F.arrow_udf("double")
    def one(model: pa.Array, *cells: pa.Array) -> pa.Array:
        model = model.to_numpy(zero_copy_only=False)
        return pa.array(_outputs(done, _bins(cells, cuts), model) * deviation[model] + mean[model])

    if own is None:
        return forest.rows.withColumn(out, every(*cells))
    inside = own.between(0, len(mean) - 1)
    model = F.when(inside, own).otherwise(0).cast("int")
    return forest.rows.withColumn(out, F.when(inside, one(model, *cells)))
