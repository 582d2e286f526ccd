"""Model inputs: 17 numeric columns from 12 mart columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed


def dummy_columns() -> list[tuple[str, str, str]]:
    """(column, word, name) of every dummy: words in alphabetical order, the first one dropped.

    The vocabulary is frozen, so a word that is missing from a batch cannot shift the columns.
    """
    return [
        (column, word, f"{column}_{word}")
        for column, words in fixed.CATEGORY_FEATURES.items()
        for word in sorted(words)[1:]
    ]


FEATURES = (
    fixed.NUMERIC_FEATURES + fixed.BOOLEAN_FEATURES + [name for _, _, name in dummy_columns()]
)


def feature_matrix(mart: DataFrame, key: str = "order_id", label: str = "is_fraud") -> DataFrame:
    """Key, label (if there is one) and the 17 inputs as doubles. A null input makes a fit fail."""
    return mart.select(
        key,
        *[label for c in mart.columns if c == label],
        *[F.col(name).cast("double").alias(name) for name in fixed.NUMERIC_FEATURES],
        *[F.col(name).cast("int").cast("double").alias(name) for name in fixed.BOOLEAN_FEATURES],
        *[
            F.when(F.col(column) == word, F.lit(1.0)).otherwise(F.lit(0.0)).alias(name)
            for column, word, name in dummy_columns()
        ],
    )


def assembler(output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol=output, handleInvalid="error")


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per input, as fitted on a training set."""

    mean: dict[str, float]
    deviation: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            name: (F.col(f"`{name}`") - F.lit(self.mean[name])) / F.lit(self.deviation[name])
            for name in self.mean
        }
        return df.select(*[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns])


def fit_scaler(train: DataFrame, names: list[str] = FEATURES) -> Scaler:
    """Fitted on the training rows only; one aggregate, of which one row of numbers comes back."""
    row = train.agg(
        *[F.avg(F.col(f"`{n}`")).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.stddev_pop(F.col(f"`{n}`")).alias(f"s{i}") for i, n in enumerate(names)],
    ).first()
    return Scaler(
        mean={n: row[f"m{i}"] for i, n in enumerate(names)},
        deviation={n: row[f"s{i}"] or 1.0 for i, n in enumerate(names)},
    )


def class_weights(train: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Per class: rows, the balanced weight n / (2 n_c), and the boosting weight (neg / pos, or 1)."""
    counts = train.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(label) == 0, F.lit(1))).alias("n0"),
        F.count(F.when(F.col(label) == 1, F.lit(1))).alias("n1"),
    )
    n0, n1 = (F.nullif(F.col(c), F.lit(0)) for c in ("n0", "n1"))
    return counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias(label),
                    F.col("n0").alias("orders"),
                    (F.col("n") / (n0 * 2)).alias("balanced_weight"),
                    F.lit(1.0).alias("boost_weight"),
                ),
                F.struct(
                    F.lit(1).alias(label),
                    F.col("n1").alias("orders"),
                    (F.col("n") / (n1 * 2)).alias("balanced_weight"),
                    (F.col("n0") / n1).alias("boost_weight"),
                ),
            )
        )
    )


def with_weight(train: DataFrame, kind: str, label: str = "is_fraud", output: str = "weight") -> DataFrame:
    """The training rows with their class weight; the weights come in by a two-row broadcast."""
    weights = class_weights(train, label).select(label, F.col(kind).alias(output))
    return train.join(F.broadcast(weights), label)


__all__ = [
    "FEATURES",
    "Scaler",
    "assembler",
    "class_weights",
    "dummy_columns",
    "feature_matrix",
    "fit_scaler",
    "with_weight",
]
