"""P1 project_mouse / P2 project_keydown: select the declared columns.

Unknown payload fields (``stream``, ``_pad``, ``canvasId`` under the live
schema) are dropped; a declared column missing from the input becomes a typed
NULL. Being a projection, Catalyst prunes it down into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cursorlake.schemas import schema_for_kind


def project(df: DataFrame, kind: str, family: str = "sink",
            extra: list[tuple[str, T.DataType]] | None = None) -> DataFrame:
    schema = schema_for_kind(kind, family, extra)
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def project_mouse(df: DataFrame, family: str = "sink", extra=None) -> DataFrame:
    return project(df, "mouse", family, extra)


def project_keydown(df: DataFrame, family: str = "sink", extra=None) -> DataFrame:
    return project(df, "keydown", family, extra)
