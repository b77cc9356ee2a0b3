"""Embedding (E1, E2) and 2-D projection.

The default embedder is offline and JVM-side: ``RegexTokenizer`` ->
``HashingTF`` (murmur3 feature hashing) -> ``Normalizer`` (unit L2 norm) from
Spark ML, turned into ``ARRAY<FLOAT>`` with ``vector_to_array``.  Because it
is a fixed function of the text (no fitting), chunks and queries embedded in
different jobs land in the same space -- the property the reference gets by
using one model for indexing and for search.

A user model plugs in through :func:`embed_with`, a ``mapInPandas`` wrapper:
the model is built once per Python worker and receives Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

DEFAULT_DIM = 256


def hashed_embedding(df: DataFrame, text_col: str = "text", out: str = "embedding",
                     dim: int = DEFAULT_DIM) -> DataFrame:
    """Unit-norm hashed bag of lower-cased words."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern="[^\\p{L}\\p{N}]+",
                         toLowercase=True, minTokenLength=1)
    tf = HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=dim)
    norm = Normalizer(inputCol="__tf", outputCol="__vec", p=2.0)
    model = Pipeline(stages=[tok, tf, norm]).fit(df.limit(0))
    res = model.transform(df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))))
    return (res.withColumn(out, vector_to_array("__vec", "float32"))
            .drop("__tok", "__tf", "__vec"))


def embed_with(df: DataFrame, make_model: Callable[[], Callable[[list[str]], np.ndarray]],
               text_col: str = "text", out: str = "embedding") -> DataFrame:
    """E1 plug-in: ``make_model()`` is called once per worker task and returns
    ``texts -> (n, d) matrix``; rows stream through in Arrow batches."""
    schema = StructType(list(df.schema.fields) + [StructField(out, ArrayType(FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for pdf in batches:
            mat = np.asarray(model(pdf[text_col].fillna("").tolist()), dtype=np.float32)
            pdf[out] = list(mat)
            yield pdf
    return df.mapInPandas(run, schema)


def pca_points(vectors: DataFrame, id_col: str = "corpus_id", label_col: str = "source",
               vec_col: str = "embedding", k: int = 2) -> DataFrame:
    """Project vectors to k dimensions with Spark ML PCA (a distributed
    d x d covariance, d small), each axis signed so that its largest loading
    is positive (a deterministic orientation)."""
    v = vectors.withColumn("__v", array_to_vector(F.col(vec_col)))
    pca = PCA(k=k, inputCol="__v", outputCol="__p").fit(v)
    pc = pca.pc.toArray()                       # d x k model parameter
    signs = np.sign(pc[np.abs(pc).argmax(axis=0), range(k)])
    signs[signs == 0] = 1.0
    proj = pca.transform(v).withColumn("__a", vector_to_array("__p"))
    cols = [(F.col("__a")[i] * F.lit(float(signs[i]))).alias(n) for i, n in enumerate(["x", "y", "z"][:k])]
    return proj.select(id_col, label_col, *cols)
