"""Names and ids of the user's tables: names compared as Spark does, ids of any type that has an order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanworks.operators.ordered import running


def same_name(df: DataFrame, a: str, b: str) -> bool:
    """Whether two column names are one to this session."""
    return a == b if str(df.sparkSession.conf.get("spark.sql.caseSensitive")).lower() == "true" else a.lower() == b.lower()


def other_columns(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` that bear none of these names."""
    return [c for c in df.columns if not any(same_name(df, c, n) for n in names)]


def ids_of(df: DataFrame, id_col: str) -> DataFrame | None:
    """(number, id): for ids that are no whole numbers their numbers from 0 in order, none for whole numbers.

    Ids are numbered by running sums over ranges of them, so that no task gathers all."""
    if isinstance(df.schema[id_col].dataType, T.IntegralType):
        return None
    named = df.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    return running(named, [], ["id"], number="number").select("number", "id").checkpoint()


def with_numbers(df: DataFrame, id_col: str, ids: DataFrame | None) -> tuple[DataFrame, str]:
    """``df`` and the name of its column of whole-number ids: the ids themselves, or a column beside them."""
    if ids is None:
        return df, id_col
    name = f"id_{uuid.uuid4().hex}"
    return df.join(ids.select(F.col("id").alias(f"{name}_of"), F.col("number").alias(name)), F.col(id_col) == F.col(f"{name}_of"), "left").drop(f"{name}_of"), name


def named_again(df: DataFrame, ids: DataFrame | None, kind: str, *columns: str) -> DataFrame:
    """Numbers in these columns are replaced by their ids; whole numbers get back their own type."""
    if ids is None:
        return df.withColumns({c: F.col(c).cast(kind) for c in columns})
    out = df
    for c in columns:
        name = f"id_{uuid.uuid4().hex}"
        out = out.join(ids.toDF(f"{name}_no", name), F.col(c) == F.col(f"{name}_no"), "left").withColumn(c, F.col(name)).drop(f"{name}_no", name)
    return out.select(*df.columns)
