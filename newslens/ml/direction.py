"""The rise/fall classifier: training, scoring, evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.strings import article_text
from newslens.ml.transformers import Vectorizer
from newslens.operators.evaluation import in_training
from newslens.operators.prices import forward_label
from newslens.settings import stored


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    scored: DataFrame  # the held-out rows with their prediction

    def accuracy(self) -> float:
        return MulticlassClassificationEvaluator(
            labelCol="indexed_label", predictionCol="prediction", metricName="accuracy"
        ).evaluate(self.scored)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def split(labelled: DataFrame, by_id: str | None, fraction: float, seed: int | None):
    """Rows at random, so two rows of one article may part; or, with ``by_id``, whole
    articles by a fixed rule."""
    if by_id is None:
        return labelled.randomSplit([fraction, 1 - fraction], seed)
    training = in_training(F.col(by_id), fraction)
    return labelled.where(training), labelled.where(~training)


def train(
    labelled: DataFrame,
    embeddings: str = "embeddings",
    by_id: str | None = None,
    fraction: float = fv.TRAIN_FRACTION,
    rounds: int = fv.BOOSTING_ROUNDS,
    seed: int | None = None,
) -> Trained:
    """Fit boosted trees on ``embeddings`` (array of vectors) and ``label``.

    The table is written once and read by every pass, so texts are embedded once
    and a random split is the same in each of them. The label index is fitted on
    all rows: 0 is the most frequent label.
    """
    data = stored(labelled, "training")
    indexer = StringIndexer(inputCol="label", outputCol="indexed_label").fit(data)
    training, held_out = split(data, by_id, fraction, seed)
    stages = [
        SQLTransformer(statement=f"SELECT *, explode({embeddings}) AS features FROM __THIS__"),
        indexer,
        GBTClassifier(
            labelCol="indexed_label", featuresCol="features", maxIter=rounds, seed=seed or 0
        ),
        IndexToString(inputCol="prediction", outputCol="direction", labels=indexer.labels),
    ]
    model = Pipeline(stages=stages).fit(training)
    return Trained(model, model.transform(held_out))


def with_embeddings(articles: DataFrame, vectorizer: Vectorizer | None = None) -> DataFrame:
    """Add ``embeddings`` of headline, description and summary."""
    vectorizer = vectorizer or Vectorizer()
    vectorizer = vectorizer.copy().setParams(inputCol="article_text", outputCol="embeddings")
    text = article_text(F.col("headline"), F.col("description"), F.col("summary"))
    return vectorizer.transform(articles.withColumn("article_text", text)).drop("article_text")


def train_direction_model(
    priced: DataFrame, vectorizer: Vectorizer | None = None, tie: str = "both", **options
) -> Trained:
    """From ``(id, date_published, headline, description, summary, prices)``.

    Articles are embedded before their prices are exploded, so an article with
    two equally near bars is embedded once.
    """
    labelled = forward_label(with_embeddings(priced, vectorizer), tie=tie)
    usable = labelled.where(F.col("embeddings").isNotNull())
    return train(usable.select("id", "embeddings", "label"), **options)


def predict_direction(
    articles: DataFrame, model: PipelineModel | str, vectorizer: Vectorizer | None = None
) -> DataFrame:
    """``(id, prediction)``: one row per embedding of each article."""
    fitted = PipelineModel.load(model) if isinstance(model, str) else model
    scored = fitted.transform(with_embeddings(articles, vectorizer))
    return scored.select("id", F.col("direction").alias("prediction"))
