"""Regularised second-order boosted trees of squared error, many models in one run of jobs.

Rows are binned once. A row belongs to a part, and each model leaves one part out, so all folds of
all settings grow together: one job per tree level finds the splits of every open node of every
model. Tasks sum gradients and row counts per (model, node, column, bin) of a slab of rows; those
sums are added up by a partially aggregated shuffle, and windows over the bins of a node give the
gain of every split, with missing cells sent left or right. Only the best split of each node comes
to the driver. Predictions of all models for all rows, held-out ones too, are columns of the
table, written every ``FLUSH`` trees; between, tasks walk the trees not yet in them.

With G and H the sums of a side, its score is T(G)^2 / (H + l2), where T draws G towards zero by
l1; a split gains the scores of its sides less that of the node. Splits below ``min_gain`` are
taken back from the leaves up. A leaf is -rate * T(G) / (H + l2). Ties go to the first column, the
lowest cut, and missing cells to the right.

Forests of at most ``FLUSH`` small trees are grown from sums that the models share, see
``shared_sums``; both ways find the same trees.

Cells are compared with cuts: every value of a column with few, else its quantiles over all rows.
Scaling a feature would not change a tree; the target is scaled by each model's mean and deviation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators.splits import SEED
from airloom.session import broadcast_checked, fresh_path, materialize

#: Trees between two writes of the predictions.
FLUSH = 4
#: Rows times models of a file of predictions.
PART_CELLS = 16_000_000
#: Models that grow together; more go in turns.
MODELS_AT_ONCE = 256
#: Rows times models of a slab.
SLAB_CELLS = 2_000_000
#: Rows that each side of a split must have.
MIN_SIDE = 1.0
#: A smaller gain is rounding.
LEAST_GAIN = 1e-6
#: Trees of a model that one row of packed trees holds.
PACK = 64
#: Nodes of forests that tasks hold whole, as arrays.
WALKED = 1 << 18

TREES = (
    "model int, tree int, place int, column int, threshold double, missing_left boolean, "
    "child int, value double, gain double, cover double"
)


@dataclass(frozen=True)
class Boosting:
    """Training setting; the defaults are the chosen one."""

    rounds: int = 5000
    depth: int = 9
    rate: float = 0.01
    row_share: float = 0.7
    column_share: float = 0.7
    l1: float = 0.1
    l2: float = 0.1
    bins: int = 512
    min_gain: float = 1.0
    seed: int = SEED


@dataclass(frozen=True)
class Model:
    """A setting, the target's scale, and what it does not train on: a part, and a fold of the
    others. Negative parts are never trained on."""

    setting: Boosting
    mean: float = 0.0
    deviation: float = 1.0
    part: int | None = None
    fold: int | None = None


@dataclass(frozen=True)
class Forest:
    """Trained models: their trees as a table, and the rows with all models' predictions; without
    these, the trees as arrays and the cuts they stand for."""

    models: list[Model]
    features: list[str]
    trees: DataFrame
    rows: DataFrame
    columns: list[str]
    done: list[Round] | None = None
    cuts: list[np.ndarray] | None = None


def find_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature, at most ``bins - 1``; a cell's bin is the number of cuts it
    reaches."""
    cells = df.select(*[_cell(c).alias(f"c{i}") for i, c in enumerate(features)])
    names = cells.columns
    few = cells.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    # The estimate is within a few percent, so these sets are bounded.
    small = [c for c in names if (few[c] or 0) <= 1.5 * bins]
    found = cells.agg(*[F.collect_set(c).alias(c) for c in small]).first() if small else {}
    values = {c: sorted(found[c]) for c in small}
    large = [c for c in names if c not in values or len(values[c]) > bins]
    if large:
        shares = [i / bins for i in range(1, bins)]
        values.update(zip(large, cells.approxQuantile(large, shares, 0.25 / bins), strict=True))
        values.update({c: [None, *sorted(set(values[c]))] for c in large})
    return [np.array(values[c][1:], float) for c in names]


def _cell(column: str) -> Column:
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None))


@dataclass
class Round:
    """One tree of every model as arrays by node; node i has the children 2i + 1 and 2i + 2."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    g: np.ndarray
    h: np.ndarray

    @classmethod
    def empty(cls, models: int, depth: int) -> Round:
        shape = (models, (1 << (depth + 1)) - 1)
        zeros = [np.zeros(shape) for _ in range(4)]
        return cls(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape, bool), *zeros)

    def only(self, models: np.ndarray) -> Round:
        """The trees of some models."""
        return Round(*[getattr(self, f.name)[models] for f in fields(self)])

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of every row, a line per model, after so many levels."""
        cells = bins.ravel()
        begin = np.arange(len(bins)) * bins.shape[1]
        out = np.zeros((len(self.column), len(bins)), np.int64)
        for model, node in enumerate(out):
            columns, cuts, goes_right = self.column[model], self.cut[model], ~self.left[model]
            if columns[0] < 0 or not levels:
                continue
            # All rows are at the root, whose column and cut are numbers.
            own = bins[:, columns[0]]
            node[:] = 1 + np.where(own < 0, goes_right[0], own >= cuts[0])
            for _ in range(levels - 1):
                column = columns.take(node)
                inner = column >= 0
                own = cells.take(begin + np.maximum(column, 0))
                right = np.where(own < 0, goes_right.take(node), own >= cuts.take(node))
                node[:] = np.where(inner, 2 * node + 1 + right, node)
        return out

    def outputs(self, bins: np.ndarray) -> np.ndarray:
        """What every model's tree adds for every row, a line per model."""
        depth = (self.column.shape[1] + 1).bit_length() - 2
        return np.take_along_axis(self.value, self.nodes(bins, depth), axis=1)

    def close(self, models: Sequence[Model]) -> None:
        """Takes back weak splits from the leaves up and sets the leaves' values."""
        least = np.array([m.setting.min_gain for m in models])
        size = self.column.shape[1]
        for node in range(size // 2 - 1, -1, -1):
            leaves = (self.column[:, 2 * node + 1] < 0) & (self.column[:, 2 * node + 2] < 0)
            self.column[leaves & (self.gain[:, node] < least), node] = -1
        l1, l2, rate = (np.array([getattr(m.setting, k) for m in models])[:, None] for k in ("l1", "l2", "rate"))
        drawn = np.sign(self.g) * np.maximum(np.abs(self.g) - l1, 0)
        weight = self.h + l2
        self.value = np.where(weight > 0, -rate * drawn / np.where(weight > 0, weight, 1), 0.0)

    def rows(self, tree: int, active: np.ndarray, features: int, cuts: list[np.ndarray]) -> Iterator[tuple]:
        """Reachable nodes in order; ``child`` is the left child's place, the right one follows."""
        for model in np.flatnonzero(active).tolist():
            own, reached = self.column[model].tolist(), [0]
            for node in reached:
                if own[node] >= 0:
                    reached += [2 * node + 1, 2 * node + 2]
            child = 1
            for place, node in enumerate(reached):
                column, inner = own[node], own[node] >= 0
                threshold = None
                if inner:
                    of, k = cuts[column], int(self.cut[model, node])
                    threshold = -np.inf if k == 0 else float(of[k - 1]) if k <= len(of) else np.inf
                yield (
                    model, tree, place, column % features if inner else -1, threshold,
                    bool(self.left[model, node]), child if inner else -1,
                    float(self.value[model, node]), float(self.gain[model, node]) if inner else 0.0,
                    float(self.h[model, node]),
                )
                child += 2 * inner


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """Fixed-width binary cells as the rows of a matrix."""
    if not len(column):
        return np.zeros((0, width), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), width)


def _binary(matrix: np.ndarray) -> pa.Array:
    n, width = len(matrix), matrix.shape[1] * matrix.itemsize
    offsets = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(matrix))])


def _slabs(batches: Iterator[pa.RecordBatch], models: int) -> Iterator[pa.RecordBatch]:
    most = max(1, SLAB_CELLS // max(1, models))
    for batch in batches:
        for at in range(0, len(batch), most):
            yield batch.slice(at, most)


def binned(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, part: Column,
    fold: Column, cuts: list[np.ndarray], models: int,
) -> DataFrame:
    """The rows with ``__part``, ``__fold``, ``__key``, ``__y``, ``__bins`` and zero predictions."""
    cells = [f"__c{i}" for i in range(len(features))]
    kept = df.columns
    ready = df.select(
        *[F.col(f"`{c}`") for c in kept], part.cast("int").alias("__part"), fold.cast("int").alias("__fold"),
        F.xxhash64(*[F.col(f"`{c}`") for c in keys]).alias("__key"), _cell(target).alias("__y"),
        *[_cell(c).alias(x) for c, x in zip(features, cells, strict=True)],
    )
    inner = T.StructType([*ready.drop(*cells).schema.fields, *T.StructType.fromDDL("__bins binary, __preds binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((len(batch), len(cuts)), np.int16)
            for i, of in enumerate(cuts):
                own = batch.column(cells[i % len(cells)]).to_numpy(zero_copy_only=False).astype(float)
                bins[:, i] = np.where(np.isnan(own), -1, np.searchsorted(of, own, "right"))
            preds = np.zeros((len(batch), models))
            rest = [batch.column(c) for c in inner.names[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, _binary(bins), _binary(preds)], inner.names)

    return ready.mapInArrow(run, inner)


SUMS = "model int, node int, column int, bin int, g double, h double"


def _sums(
    state: DataFrame, models: list[Model], pending: list[Round], now: Round, level: int,
    open_: np.ndarray, allowed: np.ndarray, tree: int, widths: list[int],
) -> DataFrame:
    """Gradient and row sums of the open nodes of one level, by column and bin."""
    count, columns = len(models), len(widths)
    part = np.array([-9 if m.part is None else m.part for m in models])
    fold = np.array([-9 if m.fold is None else m.fold for m in models])
    mean, deviation = np.array([m.mean for m in models]), np.array([m.deviation for m in models])
    share = np.array([m.setting.row_share for m in models])
    first, nodes = (1 << level) - 1, 1 << level

    names = ["model", "node", "column", "bin", "g", "h"]
    kinds = [pa.int32()] * 4 + [pa.float64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slabs(batches, count):
            bins = _matrix(batch.column("__bins"), np.int16, columns).astype(np.int64)
            preds = _matrix(batch.column("__preds"), np.float64, count).T.copy()
            for trees in pending:
                preds += trees.outputs(bins)
            nodes_of = now.nodes(bins, level) - first
            own_part, own_fold, draw, y = (batch.column(c).to_numpy() for c in ("__part", "__fold", "__draw", "__y"))
            places = bins.T + 1
            found: list[tuple] = []
            for m in np.flatnonzero(open_.any(axis=1)).tolist():
                at = nodes_of[m]
                train = (own_part >= 0) & (own_part != part[m]) & (own_fold != fold[m]) & (draw < share[m]) & (at >= 0)
                train &= open_[m].take(np.maximum(at, 0))
                row = np.flatnonzero(train)
                g = preds[m].take(row) - (y.take(row) - mean[m]) / deviation[m]
                for c in np.flatnonzero(allowed[m]).tolist():
                    width = widths[c]
                    key = at.take(row) * width + places[c].take(row)
                    h, total = np.bincount(key), np.bincount(key, weights=g)
                    some = np.flatnonzero(h)
                    found.append((np.full(len(some), m), some // width + first, np.full(len(some), c), some % width - 1, total[some], h[some]))
            cells = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(x).cast(k) for x, k in zip(cells, kinds, strict=True)], names)

    draw = draw_of(models[0].setting.seed, tree)
    given = state.select("__part", "__fold", "__y", "__bins", "__preds", draw.alias("__draw"))
    return given.mapInArrow(run, SUMS)


def draw_of(seed: int, tree: int) -> Column:
    """A row's number below 1 for a tree; rows below a setting's share are used."""
    return F.shiftrightunsigned(F.xxhash64("__key", F.lit(seed), F.lit(tree)), 11) / 2.0**53


def score_of(g: Column, h: Column, l1: Column, l2: Column) -> Column:
    drawn = F.greatest(F.abs(g) - l1, F.lit(0.0))
    return F.when(h + l2 > 0, drawn * drawn / (h + l2)).otherwise(0.0)


def best_splits(sums: DataFrame, params: DataFrame) -> DataFrame:
    """One row per model and node: its sums, and its best split if there is one."""
    added = sums.groupBy("model", "node", "column", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    # After the shuffle by node all that follows stays where it is.
    dealt = added.repartition("model", "node").join(F.broadcast(params), "model")
    whole = Window.partitionBy("model", "node", "column")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = F.col("bin") < 0
    seen = dealt.select(
        "model", "node", "column", "bin", "l1", "l2",
        *[F.sum(c).over(whole).alias(f"all_{c}") for c in "gh"],
        *[F.coalesce(F.sum(F.when(gone, F.col(c))).over(whole), F.lit(0.0)).alias(f"gone_{c}") for c in "gh"],
        *[F.sum(c).over(upto).alias(f"upto_{c}") for c in "gh"],
    )

    def split(missing_left: bool) -> Column:
        g, h = (F.col(f"upto_{c}") - (F.lit(0.0) if missing_left else F.col(f"gone_{c}")) for c in "gh")
        rest_g, rest_h = F.col("all_g") - g, F.col("all_h") - h
        gain = score_of(g, h, F.col("l1"), F.col("l2")) + score_of(rest_g, rest_h, F.col("l1"), F.col("l2"))
        gain = gain - score_of(F.col("all_g"), F.col("all_h"), F.col("l1"), F.col("l2"))
        fields = F.struct(
            gain.alias("gain"), (-F.col("column")).alias("less_column"), (-(F.col("bin") + 1)).alias("less_cut"),
            F.lit(not missing_left).alias("right"), g.alias("g"), h.alias("h"),
        )
        return F.when((h >= MIN_SIDE) & (rest_h >= MIN_SIDE) & (gain > LEAST_GAIN), fields)

    return seen.groupBy("model", "node").agg(
        F.max(F.struct("all_h", "all_g")).alias("total"),
        F.max(F.greatest(split(True), split(False))).alias("best"),
    )


def grow(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, models: Sequence[Model],
    part: Column, fold: Column | None = None, stages: Sequence[int] = (), at_stage=None, held: bool = False,
) -> Forest:
    """Trains all models on the rows with a target; ``df`` should be a table.

    The driver holds the trees of ``FLUSH`` rounds and one row per open node; everything else is
    written. ``at_stage(rounds, rows)`` is called with the predictions after these numbers of
    rounds, or if ``held`` with sums ``ERRORS`` of the rows of each model's fold. At most ``MODELS_AT_ONCE`` models belong here, or any number that ``shared_sums`` takes.
    """
    from airloom.operators import shared_sums

    models, features, spark = list(models), list(features), df.sparkSession
    if shared_sums.fits(models, len(features)):
        fold = F.lit(-1) if fold is None else fold
        return shared_sums.grow(df, keys, features, target, models, part, fold, stages, at_stage, held)
    kinds = sorted({m.setting.bins for m in models})
    cuts = [c for b in kinds for c in find_cuts(df, features, b)]
    widths = [len(c) + 2 for c in cuts]
    count, depth = len(models), max(m.setting.depth for m in models)
    rounds = max(m.setting.rounds for m in models)
    given = df.where(_cell(target).isNotNull())
    # Predictions make rows wide, so the table gets partitions for its cells, dealt by key.
    cells = given.count() * count
    dealt = max(spark.sparkContext.defaultParallelism, -(-cells // PART_CELLS))
    given = given.repartition(dealt, *[F.col(f"`{c}`") for c in keys])
    fold = F.lit(-1) if fold is None else fold
    state = materialize(binned(given, keys, features, target, part, fold, cuts, count), "boosting")
    params = spark.createDataFrame(
        [(i, float(m.setting.l1), float(m.setting.l2)) for i, m in enumerate(models)], "model int, l1 double, l2 double"
    )
    path, pending, rows = fresh_path(spark, "trees"), [], []

    def flush(state: DataFrame) -> DataFrame:
        if rows:
            spark.createDataFrame(rows, TREES).coalesce(1).write.mode("append").parquet(path)
            rows.clear()
        if not pending:
            return state
        done = materialize(_advanced(state, list(pending), count, len(cuts)), "boosting")
        pending.clear()
        return done

    for tree in range(rounds):
        active = np.array([tree < m.setting.rounds for m in models])
        allowed = np.stack([_drawn_columns(m.setting, tree, len(features), kinds) for m in models])
        now = Round.empty(count, depth)
        open_ = active[:, None].copy()
        for level in range(depth):
            open_ &= np.array([m.setting.depth > level for m in models])[:, None]
            if not open_.any():
                break
            found = best_splits(_sums(state, models, pending, now, level, open_, allowed, tree, widths), params)
            open_ = _take(now, found.collect(), level)
        now.close(models)
        now.value[~active] = 0.0
        rows += now.rows(tree, active, len(features), cuts)
        pending.append(now)
        if len(pending) >= FLUSH or tree + 1 in stages or tree + 1 == rounds:
            state = flush(state)
        if at_stage is not None and tree + 1 in stages:
            at_stage(tree + 1, _held_out(state, models) if held else state)
    return Forest(models, features, spark.read.schema(TREES).parquet(path), state, df.columns)


def _drawn_columns(setting: Boosting, tree: int, features: int, kinds: list[int]) -> np.ndarray:
    """Columns a tree may use: a share of the features, those of its own bins."""
    n = max(1, int(setting.column_share * features))
    chosen = np.random.default_rng([setting.seed, tree]).permutation(features)[:n]
    out = np.zeros((len(kinds), features), bool)
    out[kinds.index(setting.bins), chosen] = True
    return out.ravel()


def _take(now: Round, found: list, level: int) -> np.ndarray:
    """Enters the splits of a level; which nodes of the next one are open."""
    first = (1 << (level + 1)) - 1
    open_ = np.zeros((len(now.column), 1 << (level + 1)), bool)
    for r in found:
        m, node, best = r["model"], r["node"], r["best"]
        if level == 0:
            now.g[m, 0], now.h[m, 0] = r["total"]["all_g"], r["total"]["all_h"]
        if best is None:
            continue
        now.column[m, node], now.cut[m, node] = -best["less_column"], -best["less_cut"]
        now.left[m, node], now.gain[m, node] = not best["right"], best["gain"]
        a, b = 2 * node + 1, 2 * node + 2
        now.g[m, a], now.h[m, a] = best["g"], best["h"]
        now.g[m, b], now.h[m, b] = now.g[m, node] - best["g"], now.h[m, node] - best["h"]
        open_[m, a - first] = open_[m, b - first] = True
    return open_


def _advanced(state: DataFrame, pending: list[Round], count: int, columns: int) -> DataFrame:
    names = state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slabs(batches, count):
            bins = _matrix(batch.column("__bins"), np.int16, columns)
            preds = _matrix(batch.column("__preds"), np.float64, count)
            for trees in pending:
                preds = preds + trees.outputs(bins).T
            rest = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*rest, _binary(preds)], names)

    return state.mapInArrow(run, state.schema)


#: Squared errors, of the scaled target, and numbers of rows; a model may have several lines.
ERRORS = "model int, e double, n double"


def as_errors(e: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(e)), pa.int32()), pa.array(e), pa.array(n)], ["model", "e", "n"])


def _held_out(state: DataFrame, models: list[Model]) -> DataFrame:
    """Sums ``ERRORS`` of every model on the fold it leaves out."""
    part, fold = (np.array([-9 if x is None else x for x in xs]) for xs in zip(*[(m.part, m.fold) for m in models], strict=True))
    mean, deviation = np.array([m.mean for m in models]), np.array([m.deviation for m in models])
    count = len(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(count), np.zeros(count)
        for batch in batches:
            preds = _matrix(batch.column("__preds"), np.float64, count)
            own = batch.column("__part").to_numpy()[:, None]
            held = (own >= 0) & (own != part) & (batch.column("__fold").to_numpy()[:, None] == fold)
            gap = preds - (batch.column("__y").to_numpy()[:, None] - mean) / deviation
            total += np.where(held, gap * gap, 0).sum(axis=0)
            n += held.sum(axis=0)
        yield as_errors(total, n)

    return state.select("__part", "__fold", "__y", "__preds").mapInArrow(run, ERRORS)


def predictions(forest: Forest, out: str, own: Column | None = None) -> DataFrame:
    """The rows with array ``out``: every model's prediction in the target's own unit. With ``own``
    it is a number, the prediction of the model of that place, null if there is none."""
    if forest.done is not None:
        from airloom.operators import shared_sums

        return shared_sums.predictions(forest, out, own)
    if own is not None:
        every = predictions(forest, "__every")
        return every.withColumn(out, F.get("__every", own)).drop("__every")
    names, count = forest.columns, len(forest.models)
    mean, deviation = (np.array([getattr(m, k) for m in forest.models]) for k in ("mean", "deviation"))
    kept = forest.rows.select(*[F.col(f"`{c}`") for c in names], "__part", "__fold", "__preds")
    schema = T.StructType(
        [*kept.schema.fields[:-1], T.StructField(out, T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slabs(batches, count):
            own = _matrix(batch.column("__preds"), np.float64, count) * deviation + mean
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * count)
            cells = pa.ListArray.from_arrays(offsets, pa.array(own.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], cells], schema.names)

    return kept.mapInArrow(run, schema)


def packed(trees: DataFrame) -> DataFrame:
    """Rows (model, pack, trees): up to ``PACK`` trees each, a tree an array of its nodes."""
    node = F.struct("place", "column", "threshold", "missing_left", "child", "value")
    whole = trees.groupBy("model", "tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    return whole.groupBy("model", F.floor(F.col("tree") / PACK).alias("pack")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("tree", "nodes"))), lambda t: t["nodes"]).alias("trees")
    )


def _walked(nodes: pa.Table, features: Sequence[str], model: Column, depth: int) -> Column:
    """What ``score`` adds, from all nodes at once."""
    nodes = nodes.sort_by([(c, "ascending") for c in ("model", "tree", "place")])
    of, tree, place, column, child = (nodes.column(c).to_numpy().astype(np.int64) for c in ("model", "tree", "place", "column", "child"))
    threshold = nodes.column("threshold").fill_null(0.0).to_numpy()
    goes_right, value = ~nodes.column("missing_left").to_numpy(), nodes.column("value").to_numpy()
    root = np.arange(len(of)) - place
    child = np.where(child < 0, -1, root + child)
    known = np.unique(of)
    # Where each model's trees begin, one line a tree; the last column is for rows of no model.
    begins = np.full((int(tree.max(initial=-1)) + 1, len(known) + 1), -1)
    tops = place == 0
    begins[tree[tops], known.searchsorted(of[tops])] = root[tops]

    @F.arrow_udf("double")
    def walk(own: pa.Array, *cells: pa.Array) -> pa.Array:
        own = own.fill_null(-1).to_numpy()
        which = known.searchsorted(own)
        if len(known):
            which = np.where(known.take(np.minimum(which, len(known) - 1)) == own, which, len(known))
        flat = np.concatenate([c.to_numpy(zero_copy_only=False).astype(float) for c in cells])
        rows, total = np.arange(len(own)), np.zeros(len(own))
        for begin in begins:
            at = begin.take(which)
            some = at >= 0
            at = np.maximum(at, 0)
            for _ in range(depth):
                cell = flat.take(np.maximum(column.take(at), 0) * len(own) + rows)
                right = np.where(np.isnan(cell), goes_right.take(at), cell >= threshold.take(at))
                below = child.take(at)
                at = np.where(below < 0, at, below + right)
            total += np.where(some, value.take(at), 0.0)
        return pa.array(total)

    return walk(model.cast("int"), *[_cell(c) for c in features])


def score(
    df: DataFrame, trees: DataFrame, features: Sequence[str], model: Column, depth: int, out: str
) -> DataFrame:
    """Adds the sum of the leaves that each row reaches in the trees of its own ``model``.

    One scan. Forests of at most ``WALKED`` nodes go to the tasks as arrays. Of larger ones, trees of all models are packed in node arrays, joined by model and walked by array
    expressions. Models of more than ``PACK`` trees come in several packs, added up per row.
    """
    nodes = trees.limit(WALKED + 1).toArrow()
    if len(nodes) <= WALKED:
        return df.withColumn(out, _walked(nodes, features, model, depth))
    packs = materialize(packed(trees), "packed-trees")
    several = not packs.where("pack > 0").isEmpty()
    cells = F.array(*[_cell(c) for c in features])

    def leaf(nodes: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(nodes, at)
            cell = F.get("__cells", node["column"])
            right = F.when(cell.isNull(), ~node["missing_left"]).otherwise(cell >= node["threshold"])
            return F.when(node["child"] < 0, at).otherwise(node["child"] + right.cast("int"))

        return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))["value"]

    side = broadcast_checked(packs.withColumnRenamed("model", "__model"))
    given = df.withColumn("__cells", cells).withColumn("__of", model.cast("int"))
    if several:
        given = materialize(given.withColumn("__id", F.expr("uuid()")), "scored")
    joined = given.join(side, F.col("__of") == F.col("__model"), "left")
    sums = F.aggregate("trees", F.lit(0.0), lambda total, nodes: total + leaf(nodes))
    scored = joined.withColumn(out, F.coalesce(sums, F.lit(0.0)))
    if several:
        total = scored.groupBy("__id").agg(F.sum(out).alias(out))
        scored = given.join(total, "__id")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], out)


IMPORTANCES = "model int, Feature string, Importance double"


def importances(trees: DataFrame, features: Sequence[str], models: int) -> DataFrame:
    """Mean gain of a feature's splits in each model, as a share of all features' means."""
    spark: SparkSession = trees.sparkSession
    names = F.posexplode(F.array(*[F.lit(f) for f in features])).alias("column", "Feature")
    every = spark.range(models).select(F.col("id").cast("int").alias("model"), names)
    mean = trees.where("child >= 0").groupBy("model", "column").agg(F.avg("gain").alias("mean"))
    own = every.join(mean, ["model", "column"], "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    total = F.sum("mean").over(Window.partitionBy("model"))
    share = F.when(total > 0, F.col("mean") / total).otherwise(0.0)
    return own.select("model", "Feature", share.alias("Importance"))
