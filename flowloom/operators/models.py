"""Tree models on Spark ML: training, scoring, importance, cascade and registry."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.contracts import CLASS_NAMES
from flowloom.functions import at_least
from flowloom.operators.decisions import class_name
from flowloom.session import literal_table, shared_dir

_WORK = ["_features", "rawPrediction", "probability", "prediction"]

# Published settings of the boosted binary learner.
BOOSTING = {"maxIter": 3000, "stepSize": 0.05, "maxDepth": 8}


def _fit(train: DataFrame, features: Sequence[str], learner) -> PipelineModel:
    """Assemble by name and fit; the fitted pipeline carries its own feature list."""
    shared_dir(train.sparkSession)  # tree learners checkpoint their node ids and residuals there
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    return Pipeline(stages=[assembler, learner]).fit(train)


def train_boosted(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str = "y", seed: int = 42, patience: int = 100,
    first_rounds: int = 64, **params
) -> PipelineModel:
    """Boosted binary trees up to the round of the lowest validation loss.

    Rounds are doubled from `first_rounds` on until the best one lies `patience` rounds back or
    maxIter is reached, then the trees up to the best round are fitted. Without validation
    rows all rounds stay.
    """
    settings = {**BOOSTING, **params}
    last = settings.pop("maxIter")

    def fit(rounds: int) -> PipelineModel:
        learner = GBTClassifier(
            featuresCol="_features", labelCol=label, seed=seed, cacheNodeIds=True, checkpointInterval=10, maxIter=rounds, **settings)
        return _fit(train, features, learner)

    if val.isEmpty():
        return fit(last)
    rounds = min(last, first_rounds)
    while True:
        model = fit(rounds)
        losses = validation_losses(model, val)
        best = losses.index(min(losses)) + 1
        if rounds == last or best + patience <= rounds:
            return model if best == rounds else fit(best)
        rounds = min(last, 2 * rounds)


def validation_losses(model: PipelineModel, val: DataFrame) -> list[float]:
    """Loss on the validation rows after each round."""
    assembler, trees = model.stages
    return list(trees.evaluateEachIteration(assembler.transform(val)))


def train_forest(
    train: DataFrame, features: Sequence[str], label: str = "y", weight: str | None = None, seed: int = 42, **params
) -> PipelineModel:
    """Random forest, binary or multiclass, with optional row weights."""
    learner = RandomForestClassifier(
        featuresCol="_features", labelCol=label, seed=seed, cacheNodeIds=True, checkpointInterval=10, **params
    )
    if weight:
        learner = learner.setWeightCol(weight)
    return _fit(train, features, learner)


def score_binary(df: DataFrame, model: PipelineModel, out: str = "p") -> DataFrame:
    """Add the attack probability to the rows it belongs to."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(*_WORK)


def score_classes(df: DataFrame, model: PipelineModel, out: str = "probs") -> DataFrame:
    """Add the class probabilities as an array."""
    return model.transform(df).withColumn(out, vector_to_array("probability")).drop(*_WORK)


def feature_importance(model: PipelineModel, spark: SparkSession, n: int | None = None) -> DataFrame:
    """Importance per feature, highest first."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray().tolist()
    table = literal_table(spark, list(zip(names, weights)), "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), "feature")
    return ordered.limit(n) if n else ordered


def cascade_score(
    df: DataFrame, gate: PipelineModel, classes: PipelineModel, threshold: float, names: Sequence[str] = CLASS_NAMES
) -> DataFrame:
    """Gate every row, send only the rows at or above its threshold through the class model.

    Rows whose class features are incomplete keep the gate's plain answer.
    """
    gated = score_binary(df, gate)
    hit = at_least(F.col("p"), threshold)
    inputs = classes.stages[0].getInputCols()
    ready = F.lit(True)
    for c in inputs:
        ready = ready & F.col(f"`{c}`").isNotNull() & ~F.isnan(f"`{c}`")
    told = score_classes(gated.where(hit & ready), classes)
    told = told.withColumn("attack_class", class_name(F.col("probs"), names)).drop("probs")
    rest = gated.where(~(hit & ready)).withColumn("attack_class", F.when(hit, "Attack").otherwise("Benign"))
    return told.unionByName(rest)


@dataclass(frozen=True)
class ModelEntry:
    """Registry row: what a saved model is for and how its score is used."""

    id: str
    version: str
    preprocessor: str
    model_type: str
    threshold: float = 0.5
    is_gate: bool = False
    cascade_next: str | None = None
    classes: str = ""  # comma-separated class names in id order


_ENTRY_SCHEMA = (
    "id string, version string, preprocessor string, model_type string, threshold double, "
    "is_gate boolean, cascade_next string, classes string, files string, published bigint"
)


def publish(spark: SparkSession, root: str, entry: ModelEntry, model: PipelineModel) -> str:
    """Add a version of a model below a shared root folder and return the folder of its files.

    The model is written to a folder of its own first, the entry that names it last, as one file that appears whole: a reader finds
    the old newest version or the new one. Nothing is overwritten, so publishers may run side by side.
    """
    folder = f"{entry.id}/files/{uuid.uuid4().hex}"
    model.write().save(f"{root}/{folder}")
    row = literal_table(spark, [(*asdict(entry).values(), folder, time.time_ns() // 1000)], _ENTRY_SCHEMA)
    row.coalesce(1).write.json(f"{root}/{entry.id}/entries/{uuid.uuid4().hex}")
    return f"{root}/{folder}"


def registry(spark: SparkSession, root: str, as_of: int | None = None) -> DataFrame:
    """Every version of every model; with `as_of` (microseconds since 1970) those published by then."""
    entries = spark.read.schema(_ENTRY_SCHEMA).json(f"{root}/*/entries/*")
    return entries.where(F.col("published") <= as_of) if as_of is not None else entries


def newest(entries: DataFrame) -> DataFrame:
    """The entry of each model that was published last."""
    cells = F.struct(*entries.columns)
    return entries.groupBy("id").agg(F.max_by(cells, F.struct("published", "files")).alias("e")).select("e.*")


def load_model(spark: SparkSession, root: str, model_id: str, version: str | None = None, as_of: int | None = None) -> tuple[ModelEntry, PipelineModel]:
    """The newest entry of a model, of one version if given, and its files; an unknown one is an error."""
    entries = registry(spark, root, as_of).where(F.col("id") == model_id)
    row = newest(entries.where(F.col("version") == version) if version is not None else entries).first()
    if row is None:
        raise LookupError(f"no model {model_id!r}" + (f" of version {version!r}" if version is not None else "") + f" below {root}")
    cells = row.asDict()
    cells.pop("published")
    return ModelEntry(**{k: v for k, v in cells.items() if k != "files"}), PipelineModel.load(f"{root}/{row.files}")


def cascade_chain(spark: SparkSession, root: str, start: str, as_of: int | None = None) -> list[tuple[ModelEntry, PipelineModel]]:
    """The models from `start` on along `cascade_next`; a circle is an error."""
    chain: list[tuple[ModelEntry, PipelineModel]] = []
    at: str | None = start
    while at is not None:
        if at in (e.id for e, _ in chain):
            raise ValueError(f"the cascade from {start!r} comes back to {at!r}")
        chain.append(load_model(spark, root, at, as_of=as_of))
        at = chain[-1][0].cascade_next
    return chain


def run_cascade(
    df: DataFrame, chain: Sequence[tuple[ModelEntry, PipelineModel]], preprocessors: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None
) -> DataFrame:
    """Add `attack_class`, the name the chain's last reached model gives, and `decided_by`, its id.

    A binary model stops the rows under its threshold as Benign and hands on the others, each node to rows prepared by its own
    preprocessor. Rows that reach no further model, or whose features for it are incomplete, are a plain Attack.
    """
    names = [*df.columns, "attack_class", "decided_by"]
    done, rest = [], df
    for n, (entry, model) in enumerate(chain):
        ready = F.lit(True)
        rest = (preprocessors or {}).get(entry.preprocessor, lambda d: d)(rest)
        for c in model.stages[0].getInputCols():
            ready = ready & F.col(f"`{c}`").isNotNull() & ~F.isnan(f"`{c}`")
        halted = rest.where(~ready).withColumns({"attack_class": F.lit("Attack" if n else None).cast("string"), "decided_by": F.lit(chain[n - 1][0].id if n else None).cast("string")})
        done.append(halted.select(names))
        if entry.model_type == "binary":
            scored = score_binary(rest.where(ready), model, "_p").withColumn("_hit", at_least(F.col("_p"), entry.threshold)).drop("_p")
            done.append(scored.where(~F.col("_hit")).withColumns({"attack_class": F.lit("Benign"), "decided_by": F.lit(entry.id)}).select(names))
            rest = scored.where("_hit").drop("_hit")
            if n == len(chain) - 1:
                done.append(rest.withColumns({"attack_class": F.lit("Attack"), "decided_by": F.lit(entry.id)}).select(names))
        else:
            told = score_classes(rest.where(ready), model, "_probs")
            known = entry.classes.split(",") if entry.classes else CLASS_NAMES
            done.append(told.withColumns({"attack_class": class_name(F.col("_probs"), known), "decided_by": F.lit(entry.id)}).select(names))
            break
    return reduce(DataFrame.unionByName, done)


def with_threshold(entry: ModelEntry, threshold: float) -> ModelEntry:
    return ModelEntry(**{**asdict(entry), "threshold": threshold})


def parse_threshold(text: str) -> float:
    """Threshold from JSON: an object with `threshold` or `best_threshold`, or a bare number; 0.5 by default."""
    raw = json.loads(text)
    if isinstance(raw, Mapping):
        raw = raw.get("threshold", raw.get("best_threshold", 0.5))
    return float(raw)
