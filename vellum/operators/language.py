"""Language tags for titles with a predictor the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# texts -> (labels, scores), each text's best first
Predictor = Callable[[pd.Series, int], tuple[list[list[str]], list[list[float]]]]


def tag_language(df: DataFrame, column: str, predictor: Predictor, k: int = 2) -> DataFrame:
    """Add ``lang_1 .. lang_k`` and ``score_1 .. score_k``. A missing title is English with score 1.

    The predictor sees whole Arrow batches, newlines as spaces; rows without a title never reach Python.
    """
    fields = ", ".join(f"lang_{i} STRING, score_{i} DOUBLE" for i in range(1, k + 1))

    @F.pandas_udf(fields)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            labels, scores = predictor(texts, k)
            columns = {}
            for i in range(k):
                columns[f"lang_{i + 1}"] = [row[i] if i < len(row) else None for row in labels]
                columns[f"score_{i + 1}"] = [row[i] if i < len(row) else None for row in scores]
            yield pd.DataFrame(columns)

    text = F.regexp_replace(F.col(column), "\n", " ")
    tagged = df.where(F.col(column).isNotNull()).withColumn("_tag", predict(text)).select(*df.columns, "_tag.*")
    unknown = [F.lit("en").alias("lang_1"), F.lit(1.0).alias("score_1")]
    for i in range(2, k + 1):
        unknown += [F.lit(None).cast("string").alias(f"lang_{i}"), F.lit(None).cast("double").alias(f"score_{i}")]
    return tagged.unionByName(df.where(F.col(column).isNull()).select(*df.columns, *unknown))
