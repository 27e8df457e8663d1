"""Vectorised UDFs over prose; their types are objects, which need no session."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import types as K
from pyspark.sql.functions import pandas_udf

from tarnbeck.functions import prose


TEXT, TEXTS = K.StringType(), K.ArrayType(K.StringType())


def _rows(**fields: K.DataType) -> K.StructType:
    return K.StructType([K.StructField(k, v) for k, v in fields.items()])


def _udf(kind: K.DataType, f):
    """f over each value that isn't null."""

    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else f(x))

    return pandas_udf(run, kind)


clean_udf = _udf(TEXT, prose.clean)
spacing_udf = _udf(TEXT, prose.markdown_spacing)
repair_udf = _udf(TEXT, prose.repair)
wrap_marks_udf = _udf(TEXT, prose.wrap_marks)
wrap_words_udf = _udf(TEXT, prose.wrap_words)
first_json_udf = _udf(TEXT, prose.first_json)
split_json_udf = _udf(TEXTS, prose.split_json)


@pandas_udf(_rows(is_text=K.BooleanType(), text=TEXT, encoding=TEXT))
def read_text_udf(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([prose.read_text(bytes(x) if x is not None else b"") for x in content], columns=["is_text", "text", "encoding"])


def chunk_udf(most: int, lookback: int = 100):
    return _udf(TEXTS, lambda x: prose.chunk(x, most, lookback))


def split_udf(size: int = 1000, overlap: int = 100):
    return _udf(K.ArrayType(_rows(start=K.IntegerType(), text=TEXT)), lambda x: [{"start": a, "text": t} for a, t in prose.split_recursive(x, size, overlap)])


headers_udf = _udf(K.ArrayType(_rows(headings=TEXT, text=TEXT)), lambda x: [{"headings": h, "text": t} for h, t in prose.split_headers(x)])
