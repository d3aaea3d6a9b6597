"""One-hot encoding with levels fitted once, and alignment to a model's feature list."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns to encode, identifiers and diagnostics that are no model input,
# and the values that stand for an absent column and for NULL.
CATEGORICAL_COLUMNS = [
    "contract_type", "payment_method", "internet_service", "rsrq_quality", "rsrp_quality",
    "drop_rate_bucket", "outage_bucket", "tenure_bucket", "monthly_charge_bucket",
]
NON_FEATURES = [
    "churned", "subscriber_id", "snapshot_date", "churn_probability", "churn_probability_true",
    "c_custkey",
]
ABSENT_VALUE, NULL_VALUE = 0, -999


def level_name(column: str, level: str) -> str:
    """A column name without characters that SQL or a file format would have to quote."""
    text = level.replace("<", "lt_").replace("%", "pct").replace("+", "_plus")
    return f"{column}_{re.sub(r'[^0-9A-Za-z_]', '_', text)}"


def fit_levels(
    df: DataFrame, columns: Iterable[str] = CATEGORICAL_COLUMNS, max_levels: int = 200
) -> dict[str, list[str]]:
    """Distinct levels per column in one pass; refuses a column set that is not categorical."""
    present = [c for c in columns if c in df.columns]
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level")) for c in present])
    )
    found = df.select(pairs.alias("p")).select("p.*").dropna().distinct()
    limit = max_levels * len(present)
    rows = found.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} levels: these columns are not categorical")
    levels: dict[str, list[str]] = {c: [] for c in present}
    for row in rows:
        levels[row["name"]].append(row["level"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], keep_source: bool = False) -> DataFrame:
    """One 0/1 column per level, none dropped; an unseen level gives zeros throughout."""
    present = [c for c in levels if c in df.columns]
    encoded = {
        level_name(c, level): F.coalesce((F.col(c) == F.lit(level)).cast("int"), F.lit(0))
        for c in present
        for level in levels[c]
    }
    out = df.withColumns(encoded)
    return out if keep_source else out.drop(*present)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_list(df: DataFrame, exclude: Iterable[str] = NON_FEATURES) -> list[str]:
    """Numeric columns without identifier, target and diagnostics, in schema order."""
    dropped = set(exclude)
    return [c for c in numeric_columns(df) if c not in dropped]


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly `features`, as doubles: an absent column becomes 0, NULL becomes -999."""
    have = set(df.columns)
    aligned = [
        (F.coalesce(F.col(c).cast("double"), F.lit(float(NULL_VALUE))) if c in have else F.lit(float(ABSENT_VALUE))).alias(c)
        for c in features
    ]
    return df.select(*keep, *aligned)


def project_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


class _LevelParams(Params):
    levels = Param(Params._dummy(), "levels", "levels per column, as JSON", TypeConverters.toString)
    keepSource = Param(Params._dummy(), "keepSource", "keep the source columns", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(levels="{}", keepSource=True)


class OneHotLevels(Estimator, _LevelParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the levels; the fitted model applies the very same ones in batch and in a stream."""

    def _fit(self, dataset: DataFrame) -> OneHotLevelsModel:
        model = OneHotLevelsModel()
        model._set(levels=json.dumps(fit_levels(dataset)))
        return model


class OneHotLevelsModel(Model, _LevelParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        levels = json.loads(self.getOrDefault("levels"))
        return one_hot(dataset, levels, keep_source=self.getOrDefault("keepSource"))
