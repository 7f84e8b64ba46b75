"""Organisations in texts, by a gazetteer of names.

The default recogniser. Texts are searched for all names at once (:mod:`newslens.operators.gazetteer`);
of nested hits the longest stays. A trained model can take its place
(:class:`newslens.ml.transformers.NamedEntityRecognizer`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import fixed_values as fv
from newslens.functions.text import words
from newslens.operators.gazetteer import name_files, name_spans


def normalized_names(names: DataFrame, name: str = "name") -> DataFrame:
    """``gram``: distinct names as lower-case words joined by one space."""
    grams = names.select(F.array_join(words(F.col(name)), " ").alias("gram"))
    return grams.where(F.col("gram") != "").distinct()


def _entities(text: Column, spans: Column) -> Column:
    def entity(span: Column) -> Column:
        word = F.substring(text, span["start"] + 1, span["end"] - span["start"] + 1)
        return F.struct(
            F.lit(fv.ORGANISATION).alias("entity_group"),
            F.lit("1.0").alias("score"),
            word.alias("word"),
            span["start"].alias("start"),
            span["end"].alias("end"),
        )

    return F.transform(spans, entity)


def extract_entities(texts: DataFrame, names: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the entities of each text column, in order, as the mapped output column.

    The array is empty when there are none and NULL for a NULL text. Rows stay where they
    are: all columns are searched in one pass, without a join or a shuffle.
    """
    find = name_spans(name_files(normalized_names(names)))
    found = texts.withColumns({f"__spans_{i}": find(F.col(c)) for i, c in enumerate(columns)})
    tagged = {
        output: F.when(F.col(text).isNotNull(), _entities(F.col(text), F.col(f"__spans_{i}")))
        for i, (text, output) in enumerate(columns.items())
    }
    return found.withColumns(tagged).drop(*[f"__spans_{i}" for i in range(len(columns))])


def entities_of_group(entities: Column, group: str = fv.ORGANISATION) -> Column:
    return F.filter(entities, lambda e: e["entity_group"] == group)


def entity_words(entities: Column) -> Column:
    return F.transform(entities, lambda e: e["word"])


def organisations(*entities: Column) -> Column:
    """Distinct organisation words of several entity columns, in order of first
    mention; NULL when any column is NULL."""
    return F.array_distinct(F.concat(*[entity_words(entities_of_group(e)) for e in entities]))
