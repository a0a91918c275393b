"""Query source: a table (or stream) of questions.

Normalisation: strip Unicode whitespace; drop blank questions and the stop words
``exit`` / ``quit`` (case-insensitive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import STOP_WORDS
from quarry.functions.text import has_text, py_strip


def normalise_queries(queries: DataFrame, text: str = "text") -> DataFrame:
    stripped = py_strip(F.col(text))
    return (queries.withColumn(text, stripped)
                   .filter(has_text(text))
                   .filter(~F.lower(F.col(text)).isin(*STOP_WORDS)))
