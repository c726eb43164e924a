"""The recommendation workflow: split, train every model twice, blend, write star values."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blending import align, best_subset, evaluate_subsets, weigh_all
from ..operators.cocluster import CoClustering
from ..operators.factors import LibraryAls
from ..operators.means import EntityMean, Recommender, global_mean
from ..operators.neighbours import Neighbours, SlopeOne
from ..operators.splits import parts, split_per_user
from ..operators.strata import SequentialFactors
from ..session import cut_lineage, scratch_path
from ..sources.ratings import denormalise, read_predictions, write_predictions
from .stages import Manifest, digest, settings

# fixed values: the twelve models with the settings they are blended with
MODELS: dict[str, Callable[[], Recommender]] = {
    "ALS": lambda: LibraryAls(rank=10, epochs=100, lam=0.009),
    "Co-Clustering": lambda: CoClustering(user_clusters=2, item_clusters=7, epochs=150),
    "Item-Mean": lambda: EntityMean("item", fallback=True),
    "Item-based-KNN": lambda: Neighbours(90, "item"),
    "Item-based-KNN-baseline": lambda: Neighbours(90, "item", "baseline"),
    "Slope-One": lambda: SlopeOne(),
    "SVD": lambda: SequentialFactors(rank=10, epochs=400, gamma=0.0002, reg=0.009),
    "SVD++": lambda: SequentialFactors(rank=10, epochs=400, gamma=0.0002, reg=0.009, implicit=True),
    "User-Mean": lambda: EntityMean("user", fallback=True),
    "User-based-KNN": lambda: Neighbours(900, "user"),
    "User-based-KNN-baseline": lambda: Neighbours(400, "user", "baseline"),
    "Z-Score": lambda: Neighbours(90, "item", "zscore"),
}


def predict_all(train: DataFrame, pairs: DataFrame, models: Mapping[str, Callable[[], Recommender]],
                manifest: Manifest | None = None) -> DataFrame:
    """Long ``model, user, item, prediction`` table of every model trained on ``train``.

    It is written out, partitioned by model, so that each model is trained once and a blend reads
    only its members. With a ``manifest`` each model is a stage of its own, and one that a former run has written for the
    same settings, ratings and pairs isn't trained again.
    """
    spark = train.sparkSession
    train, pairs = cut_lineage(train), cut_lineage(pairs.select("user", "item"))
    if manifest is not None:
        given = f"{digest(train.select('user', 'item', 'rating'))}|{digest(pairs)}"
        tables = [manifest.table(f"predict {name}", f"{settings(build())}|{given}", lambda build=build: build().fit(train).transform(
            pairs).select("user", "item", "prediction")).select(F.lit(name).alias("model"), "*") for name, build in models.items()]
        return reduce(DataFrame.unionByName, tables)
    made = [build().fit(train).transform(pairs).select(F.lit(name).alias("model"), "user", "item", "prediction")
            for name, build in models.items()]
    path = scratch_path(spark, "predictions")
    write_predictions(reduce(DataFrame.unionByName, made), path)
    return read_predictions(spark, path)


@dataclass
class Blend:
    """The best subset, its error on ``scored`` test cells, and how many test cells some model left out.

    ``fallen_back`` counts the wanted pairs that the best subset doesn't predict in full: they are answered by the best
    subset of the models that do, and ``unanswered`` ones among them, which no model predicts, by the mean rating.
    """

    members: list[str]
    weights: list[float]
    rmse: float
    scored: int
    incomplete: int
    fallen_back: int
    unanswered: int
    subsets: DataFrame
    submission: DataFrame


def blend(testing: DataFrame, test_predictions: DataFrame, wanted: DataFrame, wanted_predictions: DataFrame,
          models: list[str], mean: float, lam: float = 0.001) -> Blend:
    """The best subset on the held-out ratings, applied to the wanted pairs: one row for each distinct pair, none NULL.

    Rows are matched by (user, item). Test cells that some model leaves out are counted as incomplete. ``mean`` answers
    a wanted pair that no model predicts.
    """
    wide = cut_lineage(align(test_predictions, models).join(testing.select("user", "item", "rating"), ["user", "item"]))
    evaluated = cut_lineage(evaluate_subsets(wide, models, lam=lam))
    top = best_subset(evaluated).first()
    pairs = wanted.select("user", "item").distinct().join(align(wanted_predictions, models), ["user", "item"], "left")
    stars = cut_lineage(weigh_all(cut_lineage(pairs), models, evaluated, mean))
    missed = stars.agg(F.count_if(F.col("mask") != top["mask"]).alias("fallen"), F.count_if(F.col("mask") == 0).alias("none")).first()
    return Blend(top["members"], top["weights"], top["rmse"], top["n"], testing.count() - top["n"], missed["fallen"],
                 missed["none"], evaluated, stars.drop("mask"))


def recommend(ratings: DataFrame, wanted: DataFrame, models: Mapping[str, Callable[[], Recommender]] | None = None,
              ratio: float = 0.9, seed: int = 988, lam: float = 0.001, folder: str | None = None) -> tuple[Blend, DataFrame]:
    """The blend and the final upstream table ``Id, Prediction`` for the wanted pairs.

    With a ``folder``, the models' predictions are stages of a ``Manifest`` there: a run that is started again with the
    same inputs trains only what is missing. Remove it with ``Manifest(spark, folder).remove()`` after use.
    """
    manifest = Manifest(ratings.sparkSession, folder) if folder else None
    models = models or MODELS
    ratings, wanted = cut_lineage(ratings), cut_lineage(wanted.select("user", "item").distinct())  # read by every model
    train, test = parts(cut_lineage(split_per_user(ratings, ratio, seed)))
    on_test = predict_all(train, test, models, manifest)
    on_wanted = predict_all(ratings, wanted, models, manifest)
    chosen = blend(test, on_test, wanted, on_wanted, list(models), global_mean(ratings), lam)
    return chosen, denormalise(chosen.submission, "prediction")
