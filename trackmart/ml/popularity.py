"""Feature preparation, forest training, scoring and evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart import schemas
from trackmart.functions.columns import cast_columns, fill_nulls, select_existing
from trackmart.operators.filters import require
from trackmart.operators.quality import stack_tagged
from trackmart.session import written

# Model names, settings and the split share.
FULL = "Full model"
AUDIO = "Audio only model"
TREES, DEPTH, BINS, SEED = 50, 8, 128, 42
TRAIN_SHARE = 0.8


@dataclass(frozen=True)
class FeatureSet:
    """Numeric inputs and an optional category."""

    numeric: Sequence[str]
    category: str | None = None

    def names(self) -> list[str]:
        return [*self.numeric, *([f"{self.category}_index"] if self.category else [])]


FULL_FEATURES = FeatureSet([*schemas.AUDIO_FEATURES, *schemas.CONTEXT_FEATURES], "genre")
AUDIO_FEATURES = FeatureSet(schemas.AUDIO_FEATURES)


@dataclass(frozen=True)
class ForestSettings:
    trees: int = TREES
    depth: int = DEPTH
    bins: int = BINS
    seed: int = SEED


@dataclass(frozen=True)
class FittedModel:
    stages: PipelineModel
    features: FeatureSet
    target: str
    settings: ForestSettings = field(default_factory=ForestSettings)


def prepare(df: DataFrame, features: FeatureSet, target: str = "popularity") -> DataFrame:
    """Target present and whole, inputs as doubles, missing category as unknown."""
    numeric = [c for c in features.numeric if c in df.columns]
    typed = cast_columns(df, {target: "int", **{c: "double" for c in numeric if c != target}})
    kept = require(typed, [target])
    return fill_nulls(kept, {features.category: "unknown"}) if features.category else kept


def available(df: DataFrame, features: FeatureSet) -> FeatureSet:
    return FeatureSet([c for c in features.numeric if c in df.columns], features.category)


def category_index(df: DataFrame, column: str) -> StringIndexerModel:
    """Labels by falling frequency, ties alphabetical, unseen ones in a last bucket."""
    indexer = StringIndexer(
        inputCol=column, outputCol=f"{column}_index", handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )
    return indexer.fit(df)


def mean_imputer(columns: Sequence[str]) -> Imputer:
    return Imputer(
        inputCols=list(columns), outputCols=[f"{c}_imp" for c in columns], strategy="mean"
    )


def is_train(keys: Sequence[str], share: float = TRAIN_SHARE) -> Column:
    """Whether a row trains, by the first four hex digits of a hash of the key columns.

    A row is on the same side whatever the partitioning, retries or engine.
    """
    limit = f"{int(share * 16**4 + 0.5):04x}"
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, 4) < limit


def hash_split(
    df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a stored table, by ``is_train``.

    Each side reads ``df`` again; mark the rows with ``is_train`` where one pass will do.
    """
    return df.filter(is_train(keys, share)), df.filter(~is_train(keys, share))


def assembler(
    inputs: Sequence[str], output: str = "features", invalid: str = "skip"
) -> VectorAssembler:
    """Inputs as one vector; by default a row with a missing one is left out."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=invalid)


def fit_popularity(
    train: DataFrame,
    features: FeatureSet = FULL_FEATURES,
    target: str = "popularity",
    settings: ForestSettings = ForestSettings(),
) -> FittedModel:
    """Index, impute, assemble and grow the forest on prepared rows.

    The category is nominal, so every label needs a bin of its own, plus one for
    unseen labels.
    """
    used = available(train, features)
    stages, bins = [], settings.bins
    if used.category:
        index = category_index(train, used.category)
        bins = max(bins, len(index.labels) + 1)
        stages.append(index)
    stages += [
        mean_imputer(used.numeric),
        # None is missing once imputed. A look for missing ones would write every input out twice,
        # and the code of a row outgrow what the JVM compiles.
        assembler([f"{c}_imp" for c in used.numeric] + used.names()[len(used.numeric):],
                  invalid="keep"),
    ]
    inputs = Pipeline(stages=stages).fit(train)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol=f"predicted_{target}",
        numTrees=settings.trees, maxDepth=settings.depth, maxBins=bins, seed=settings.seed,
        cacheNodeIds=True, maxMemoryInMB=512,
    )
    # The forest reads its rows three times before it keeps them: written once as vectors.
    vectors = written(inputs.transform(train).select(target, "features"), "vectors")
    stages = PipelineModel([*inputs.stages, forest.fit(vectors)])
    return FittedModel(stages, used, target, settings)


def score(model: FittedModel, df: DataFrame) -> DataFrame:
    """Rows with the prediction appended, helper columns removed."""
    scored = model.stages.transform(df)
    return scored.select(*df.columns, f"predicted_{model.target}")


def prediction_table(scored: DataFrame) -> DataFrame:
    return select_existing(scored, schemas.PREDICTION_COLUMNS)


def _error(target: str, prediction: str) -> Column:
    return F.col(target).cast("double") - F.col(prediction)


def regression_metrics(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """RMSE, MAE and R2 as (metric, value) rows, from one pass over the rows.

    The spread of the target is summed around its mean by Spark's variance, which
    stays exact where a difference of squares would not.
    """
    error = _error(target, prediction)
    sums = df.agg(
        F.count(error).alias("n"),
        F.sum(error * error).alias("sse"),
        F.sum(F.abs(error)).alias("sae"),
        F.var_pop(F.when(error.isNotNull(), F.col(target).cast("double"))).alias("spread"),
    )
    total = F.col("spread") * F.col("n")
    r2 = F.when(total > 0, 1 - F.col("sse") / total)
    return sums.select(F.explode(F.create_map(
        F.lit("RMSE"), F.sqrt(F.col("sse") / F.nullif(F.col("n"), F.lit(0))),
        F.lit("MAE"), F.col("sae") / F.nullif(F.col("n"), F.lit(0)),
        F.lit("R2"), r2,
    )).alias("metric", "value"))


def importance_table(model: FittedModel, spark: SparkSession) -> DataFrame:
    """(feature, importance, rank), most important first; as many rows as features."""
    weights = model.stages.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(model.features.names(), weights), key=lambda p: -p[1])
    rows = [(name, float(weight), i) for i, (name, weight) in enumerate(pairs, 1)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def stack_models(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Per-model result tables as one, with ``model_name``."""
    return stack_tagged(tables)


def compare_models(metrics: DataFrame, full: str = FULL, reduced: str = AUDIO) -> DataFrame:
    """Metrics side by side, and how much the reduced model loses."""
    def of(model: str) -> Column:
        return F.max(F.when(F.col("model_name") == model, F.col("value")))

    compared = metrics.groupBy("metric").agg(
        of(full).alias("full_value"), of(reduced).alias("reduced_value")
    )
    return compared.withColumn("drop", F.col("full_value") - F.col("reduced_value"))


def mean_predictor(train: DataFrame, df: DataFrame, target: str) -> DataFrame:
    """Baseline: the training mean for every row."""
    return df.withColumn("prediction", train.agg(F.avg(target)).scalar())


def category_mean_predictor(
    train: DataFrame, df: DataFrame, target: str, category: str
) -> DataFrame:
    """Baseline: the training mean of the row's category.

    The means are written first: with their true size known, Spark broadcasts
    them instead of shuffling every row by its few categories.
    """
    means = train.groupBy(category).agg(F.avg(target).alias("prediction"))
    return df.join(written(means, "category_means"), category, "left")
