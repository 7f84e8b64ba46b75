"""Text stages for ML pipelines: entities, embeddings, summaries.

Each works without model files and takes a trained model through ``setModel``.
The built-in behaviour is a gazetteer, hashed term frequencies and an extractive
summary; none of them is a neural network and none should be read as one.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens import schemas
from newslens.functions.text import sentences, words
from newslens.ml.models import LoadModel, model_column
from newslens.operators.beams import summarize_beams
from newslens.operators.entities import extract_entities
from newslens.operators.skew import lookup_join
from newslens.operators.summaries import summarize_extractive

DEFAULT_MODEL_FOLDER = "assets/models"
_KEY = "__text_key"


def _param(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class TextStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer from one text column to one output column.

    Params are keyword arguments of the constructor and have a ``setX`` and a
    ``getX`` method each; they are saved and loaded with a pipeline. A model set
    with ``setModel`` is code and is not saved.
    """

    emrfsModelPath = _param("emrfsModelPath", "Folder URI of the model files.", TypeConverters.toString)
    defaults: dict = {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        names = [n for n in dir(cls) if isinstance(getattr(cls, n, None), Param)]
        for name in names:
            suffix = name[0].upper() + name[1:]
            cls._accessors(name, suffix)

    @classmethod
    def _accessors(cls, name: str, suffix: str) -> None:
        def setter(self, value):
            return self.setParams(**{name: value})

        def getter(self):
            return self.getOrDefault(name)

        setattr(cls, f"set{suffix}", setter)
        setattr(cls, f"get{suffix}", getter)

    def __init__(self, **params):
        super().__init__()
        self.model: LoadModel | None = None
        self._setDefault(inputCol="input", outputCol="output", emrfsModelPath=None, **self.defaults)
        self.setParams(**params)

    def setParams(self, **params):
        return self._set(**{k: v for k, v in params.items() if v is not None})

    def setModel(self, load: LoadModel):
        self.model = load
        return self

    def model_uri(self, name: str) -> str:
        folder = self.getOrDefault("emrfsModelPath") or DEFAULT_MODEL_FOLDER
        return f"{folder.rstrip('/')}/{name}"

    def _per_text(self, df: DataFrame, work) -> DataFrame:
        """Run ``work(distinct texts with a key) -> (key, output)`` and join it back by
        the text's hash, so equal texts are worked on once."""
        text, output = self.getInputCol(), self.getOutputCol()
        keyed = df.withColumn(_KEY, F.sha2(F.col(text), 256))
        distinct = (
            keyed.where(F.col(text).isNotNull())
            .select(_KEY, F.col(text).alias("text"))
            .dropDuplicates([_KEY])
        )
        done = work(distinct).select(_KEY, F.col(output))
        others = [c for c, t in df.dtypes if c != text and not t.startswith("map")]
        return lookup_join(keyed, done, [_KEY], others or [_KEY]).drop(_KEY)


class NamedEntityRecognizer(TextStage):
    """Text to ``array<struct<entity_group, score, word, start, end>>``.

    Finds the names of the table ``entity_names`` (Parquet, column ``name``) in the
    model folder, or of a DataFrame given to ``setNames``. With
    ``cleanAnnotations=False`` the sentences and words stay as columns.
    """

    cleanAnnotations = _param(
        "cleanAnnotations", "Whether to leave out helper columns.", TypeConverters.toBoolean
    )
    defaults = {"cleanAnnotations": True}

    def setNames(self, names: DataFrame):
        self.names = names
        return self

    def _transform(self, df: DataFrame) -> DataFrame:
        text, output = F.col(self.getInputCol()), self.getOutputCol()
        if self.model:
            tagged = df.withColumn(
                output, model_column(self.model, T.ArrayType(schemas.ENTITY), input=text)
            )
        else:
            names = getattr(self, "names", None)
            if names is None:
                names = df.sparkSession.read.parquet(self.model_uri("entity_names"))
            tagged = extract_entities(df, names, {self.getInputCol(): output})
        if self.getOrDefault("cleanAnnotations"):
            return tagged
        return tagged.withColumn("sentence", sentences(text)).withColumn("token", words(text))


def word_bucket(word: Column, buckets: int) -> Column:
    """The first seven hexadecimal digits of the word's MD5, modulo ``buckets``: a rule
    that any engine can repeat."""
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, 7), 16, 10).cast("long") % buckets


class Vectorizer(TextStage):
    """Text to ``array<vector>`` with one vector: unit-length counts of words by
    :func:`word_bucket`.

    The size is fixed by ``numFeatures``, so nothing is fitted or collected. With
    ``cleanAnnotations=False`` the words stay as the column ``token``.
    """

    cleanAnnotations = NamedEntityRecognizer.cleanAnnotations
    numFeatures = _param("numFeatures", "Length of the vectors.", TypeConverters.toInt)
    defaults = {"cleanAnnotations": True, "numFeatures": 256}

    def _transform(self, df: DataFrame) -> DataFrame:
        text, output = self.getInputCol(), self.getOutputCol()
        if self.model:
            vectors = model_column(self.model, T.ArrayType(VectorUDT()), input=F.col(text))
            return df.withColumn(output, vectors)
        size = self.getOrDefault("numFeatures")
        counter = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(size)], inputCol="__buckets", outputCol="__counts"
        )
        unit = Normalizer(inputCol="__counts", outputCol="__unit", p=2.0)
        vectorized = df.withColumn("token", words(F.coalesce(F.col(text), F.lit(""))))
        vectorized = vectorized.withColumn(
            "__buckets", F.transform("token", lambda w: word_bucket(w, size).cast("string"))
        )
        vectorized = unit.transform(counter.transform(vectorized))
        embedding = F.when(F.col(text).isNotNull(), F.array("__unit"))
        vectorized = vectorized.withColumn(output, embedding).drop(
            "__buckets", "__counts", "__unit"
        )
        return vectorized.drop("token") if self.getOrDefault("cleanAnnotations") else vectorized


class Summarizer(TextStage):
    """Text to a shorter text of ``minLength`` to ``maxLength`` words.

    One beam takes the best sentences in turn; more search sets of sentences, where
    ``lengthPenalty`` above 0 favours long summaries. A model is given all four.
    """

    minLength = _param("minLength", "Least length of a summary.", TypeConverters.toInt)
    maxLength = _param("maxLength", "Greatest length of a summary.", TypeConverters.toInt)
    lengthPenalty = _param("lengthPenalty", "Exponential length penalty.", TypeConverters.toFloat)
    numBeams = _param("numBeams", "Beams of a beam search; 1 is none.", TypeConverters.toInt)
    defaults = {"minLength": 0, "maxLength": 20, "lengthPenalty": 1.0, "numBeams": 1}

    def _transform(self, df: DataFrame) -> DataFrame:
        text, output = self.getInputCol(), self.getOutputCol()
        least, most = self.getOrDefault("minLength"), self.getOrDefault("maxLength")
        if self.model:
            summary = model_column(
                self.model,
                "string",
                input=F.col(text),
                min_length=F.lit(least),
                max_length=F.lit(most),
                length_penalty=F.lit(self.getOrDefault("lengthPenalty")),
                num_beams=F.lit(self.getOrDefault("numBeams")),
            )
            return df.withColumn(output, summary)
        beams, penalty = self.getOrDefault("numBeams"), self.getOrDefault("lengthPenalty")

        def work(texts: DataFrame) -> DataFrame:
            if beams > 1:
                return summarize_beams(texts, _KEY, "text", output, least, most, beams, penalty)
            return summarize_extractive(texts, _KEY, "text", output, least, most)

        return self._per_text(df, work)
