"""Flow 3: train and score boosted trees under five hold-out protocols.

Folds are a part number on one written table. All folds, and in a search all settings, grow in one
run of jobs per ``MODELS_AT_ONCE`` models, whose number does not depend on how many folds there
are; held-out rows are predicted in the same table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators import trees
from airloom.operators.assemble import CALENDAR_COLUMNS, drop_calendar, drop_if_present, station_at_rounded
from airloom.operators.boosting import (
    Boosting,
    Fitted,
    Part,
    fit_parts,
    mean_importances,
    save_model,
    search,
)
from airloom.operators.metrics import score_table, season_scores
from airloom.operators.scaling import fit_scale, fold_scales
from airloom.operators.splits import BASE_FOLDS, FOLDS, random_split, season_split
from airloom.session import broadcast_checked, materialize
from airloom.sources.sinks import write_predictions

PREDICTED = "predicted"


@dataclass(frozen=True)
class Protocol:
    """What every protocol needs to know about the table."""

    target: str
    keys: Sequence[str]
    order_by: Sequence[str]
    features: Sequence[str]
    setting: Boosting = field(default_factory=Boosting)
    grid: dict = field(default_factory=dict)
    folds: int = FOLDS
    #: Orders rows for random and seasonal splits instead of the row hash.
    order: Column | None = None
    #: Columns that predictions keep besides those used.
    carried: Sequence[str] = ()


@dataclass(frozen=True)
class Evaluation:
    predictions: DataFrame
    importances: DataFrame
    scores: DataFrame


def _complete(df: DataFrame, protocol: Protocol, extra: Sequence[str] = ()) -> DataFrame:
    """Rows without a missing cell."""
    used = dict.fromkeys([*protocol.keys, *protocol.order_by, *protocol.features, protocol.target, *protocol.carried, *extra])
    return df.select(*[F.col(f"`{c}`") for c in used]).na.drop("any")


@dataclass(frozen=True)
class _Trained:
    """Held-out rows with their predictions, importances per part, and every part's model."""

    predictions: DataFrame
    importances: DataFrame
    features: list[str]
    settings: dict[Part, Boosting]
    #: Parts and trees of every run of jobs.
    runs: list[tuple[list[Part], DataFrame]]

    def model(self, part: Part) -> Fitted:
        """The model without a part; made when asked for, since there may be very many."""
        parts, found = next(r for r in self.runs if part in r[0])
        own = found.where(F.col("model") == parts.index(part)).withColumn("model", F.lit(0))
        return Fitted(own, self.features, self.settings[part].depth)


def _train(
    rows: DataFrame, protocol: Protocol, part: Column, scales: dict[Part, tuple[float, float]],
    held: Part = None, searched: bool = True,
) -> _Trained:
    """A model without each part, of one setting or the best of the grid.

    Predicted are the rows of each model's part, or of part ``held``.
    """
    given = rows.withColumn("__held", part.cast("int"))
    common = given, protocol.keys, protocol.features, protocol.target, F.col("__held"), scales
    settings = dict.fromkeys(scales, protocol.setting)
    if protocol.grid and searched:
        settings, _ = search(*common, protocol.setting, protocol.grid, protocol.folds, protocol.order)
    found, shares, runs = [], [], []
    for parts, forest in fit_parts(*common, settings):
        place, mine = F.lit(0), F.col("__held") == held
        if held is None:
            # Parts are numbered in order, and models of one run are consecutive.
            place = F.col("__held") - parts[0]
            mine = F.col("__held").between(parts[0], parts[-1])
        scored = trees.predictions(forest, PREDICTED, place).where(mine)
        found.append(scored.select(*[F.col(f"`{c}`") for c in [*rows.columns, PREDICTED]]))
        own = trees.importances(forest.trees, protocol.features, len(parts))
        base = parts[0] if parts[0] is not None else 0
        shares.append(own.withColumn("model", F.col("model") + base))
        runs.append((parts, forest.trees))
    union = [reduce(DataFrame.unionByName, frames) for frames in (found, shares)]
    return _Trained(materialize(union[0], "predictions"), union[1], list(protocol.features), settings, runs)


def _with_feature(protocol: Protocol, name: str) -> Protocol:
    return replace(protocol, features=[*[f for f in protocol.features if f != name], name])


def _without_calendar(protocol: Protocol) -> Protocol:
    kept = [f for f in protocol.features if f not in CALENDAR_COLUMNS]
    return replace(protocol, features=kept)


def random_protocol(df: DataFrame, protocol: Protocol, station: str, date: str) -> Evaluation:
    """A fifth of all rows held out; scores per station and overall, MAPE as a fraction.

    The year is a feature.
    """
    protocol = _with_feature(protocol, "Year")
    rows = _complete(df.withColumn("Year", F.year(date)), protocol, [station])
    split = random_split(rows, protocol.keys, order=protocol.order)
    trained = _holding_out(split, protocol)
    scores = score_table(
        trained.predictions, [station], protocol.order_by, station, "fraction", protocol.target, PREDICTED
    )
    return Evaluation(trained.predictions, _ranked(trained), scores)


def _holding_out(split: DataFrame, protocol: Protocol, searched: bool = True) -> _Trained:
    """One model of the rows that are not test rows."""
    scale = fit_scale(split.where("not is_test"), [protocol.target])[protocol.target]
    part = F.when(F.col("is_test"), F.lit(-1)).otherwise(F.lit(0))
    trained = _train(split, protocol, part, {None: scale}, held=-1, searched=searched)
    return replace(trained, predictions=trained.predictions.drop("is_test"))


def _ranked(trained: _Trained) -> DataFrame:
    return trained.importances.drop("model").orderBy(F.desc("Importance"), "Feature")


def season_protocol(df: DataFrame, protocol: Protocol, date: str) -> Evaluation:
    """A fifth of every season held out, one fixed setting; one row of scores per season.

    The month is a feature.
    """
    protocol = _with_feature(protocol, "Month")
    rows = _complete(df.withColumn("Month", F.month(date)), protocol, [date])
    split = materialize(season_split(rows, protocol.keys, date, order=protocol.order), "split")
    trained = _holding_out(split, protocol, searched=False)
    scores = season_scores(
        trained.predictions, protocol.order_by, "Season", protocol.target, PREDICTED
    )
    return Evaluation(trained.predictions, _ranked(trained), scores)


def _leave_one_out(
    rows: DataFrame, protocol: Protocol, fold: str, model_folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Predictions of every fold by a model of the other folds, and importances per fold.

    One row per fold comes to the driver. A fold that holds all rows has no model and is skipped;
    rows without a fold are trained on by all and predicted by none.
    """
    spark = rows.sparkSession
    saved = [*protocol.features, protocol.target] if model_folder else [protocol.target]
    stats: dict = {}
    for r in fold_scales(rows, [fold], saved).collect():
        if r[fold] is not None:
            stats.setdefault(r[fold], {})[r["column"]] = (r["train_mean"], r["train_std"])
    folds = sorted(v for v, own in stats.items() if protocol.target in own)
    kind = T.StructType([T.StructField("__fold_value", rows.schema[fold].dataType), T.StructField("__n", T.IntegerType())])
    numbers = spark.createDataFrame([(v, i) for i, v in enumerate(folds)], kind)
    side = broadcast_checked(numbers)
    numbered = rows.join(side, F.col(f"`{fold}`") == F.col("__fold_value"), "left").drop("__fold_value")
    numbered = numbered.withColumn("__n", F.coalesce("__n", F.lit(len(folds))))
    if side is numbers:
        # Joined by a shuffle, so once; a lookup may be repeated.
        numbered = materialize(numbered, "numbered")
    if not folds:
        shares = spark.createDataFrame([], "Feature string, Importance double, fold string")
        return rows.limit(0).withColumn(PREDICTED, F.lit(0.0)), shares
    scales = {i: stats[v][protocol.target] for i, v in enumerate(folds)}
    trained = _train(numbered, protocol, F.col("__n"), scales)
    if model_folder:
        for i, v in enumerate(folds):
            save_model(spark, trained.model(i), stats[v], protocol.target, f"{model_folder}/fold={i}")
    named = trained.importances.join(F.broadcast(numbers), F.col("model") == F.col("__n"))
    shares = named.select("Feature", "Importance", F.col("__fold_value").cast("string").alias("fold"))
    return trained.predictions.drop("__n"), shares


def station_protocol(
    df: DataFrame, protocol: Protocol, station: str, model_folder: str | None = None
) -> Evaluation:
    """Every station predicted from all others; mean importances; MAPE in percent.

    Calendar columns are no features.
    """
    protocol = _without_calendar(protocol)
    rows = materialize(_complete(df, protocol, [station]), "training")
    predictions, per_fold = _leave_one_out(rows, protocol, station, model_folder)
    scores = score_table(
        predictions, [station], protocol.order_by, station, "percent", protocol.target, PREDICTED
    )
    return Evaluation(predictions, mean_importances(per_fold), scores)


def year_protocol(
    df: DataFrame, protocol: Protocol, date: str, model_folder: str | None = None
) -> Evaluation:
    """Every year predicted from all others; importances per year; MAPE in percent.

    Calendar columns are no features.
    """
    protocol = _without_calendar(protocol)
    rows = materialize(_complete(df.withColumn("Year", F.year(date)), protocol, ["Year"]), "training")
    predictions, per_fold = _leave_one_out(rows, protocol, "Year", model_folder)
    scores = score_table(
        predictions, ["Year"], protocol.order_by, "Year", "percent", protocol.target, PREDICTED
    )
    return Evaluation(
        predictions, per_fold.withColumnRenamed("fold", "Year"), scores
    )


def base_model(df: DataFrame, protocol: Protocol, dropped: Sequence[str], folder: str) -> DataFrame:
    """Model of every row with a target, gaps in features allowed; saved below ``folder``.

    Returns the fitted rows with their predictions.
    """
    ready = drop_if_present(drop_calendar(df), dropped).na.drop(subset=[protocol.target])
    features = [f for f in protocol.features if f not in dropped]
    protocol = replace(protocol, features=features, folds=BASE_FOLDS)
    ready = materialize(ready, "base")
    scale = fit_scale(ready, [*features, protocol.target])
    trained = _train(ready, protocol, F.lit(0), {None: scale[protocol.target]}, held=0)
    save_model(df.sparkSession, trained.model(None), scale, protocol.target, folder)
    return trained.predictions


def save_predictions(
    predictions: DataFrame, path: str, protocol: Protocol, dimension: DataFrame, order: str
) -> None:
    """Predictions as a file: name of the station at their rounded coordinates, keys, actual and
    predicted value, then the rest. Rows whose coordinates no station has are left out."""
    named = station_at_rounded(predictions, dimension, order)
    write_predictions(named, path, ["Station_Name", *protocol.keys], protocol.target, PREDICTED)


def scores_at_stations(
    predictions: DataFrame, protocol: Protocol, dimension: DataFrame, order: str, unit: str = "fraction"
) -> DataFrame:
    """Rows (Metric, Value, Station, Longitude, Latitude): scores per pair of coordinates with the
    name of its station, and overall ones without coordinates."""
    place = ["Longitude", "Latitude"]
    labelled = predictions.withColumn("Station", F.concat_ws(" ", *place))
    found = score_table(
        labelled, [*place, "Station"], protocol.order_by, "Station", unit, protocol.target, PREDICTED
    )
    overall = F.col("Station") == "Overall"
    named = station_at_rounded(found.where(~overall), dimension, order).drop("Station")
    named = named.withColumnRenamed("Station_Name", "Station")
    columns = ["Metric", "Value", "Station", *place]
    return named.select(*columns).unionByName(found.where(overall).select(*columns))
