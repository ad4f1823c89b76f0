"""Feature preparation: index, encode, impute, assemble, scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    OneHotEncoderModel,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.config import FeatureSet
from delaykit.sources.sinks import staged

PLAN_CELLS = 1 << 14  # entries of all labels of all columns that a plan holds; of more, by the encoders


def cardinality(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Estimated distinct values per categorical.

    An indexer keeps its labels in one model; a caller can see here which columns (a tail
    number, say) would make it large.
    """
    if not columns:
        return {}
    return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()


def preparation_stages(
    features: FeatureSet,
    one_hot: bool = True,
    impute: bool = False,
    scale: bool = False,
) -> list:
    """Stages in order. Rows with unseen categories or missing numbers are skipped."""
    stages: list = []
    categoricals, numerics = list(features.categoricals), list(features.numerics)
    inputs: list[str] = []
    if categoricals:
        indexed = [f"{c}_idx" for c in categoricals]
        stages.append(
            StringIndexer(inputCols=categoricals, outputCols=indexed, handleInvalid="skip")
        )
        inputs = indexed
        if one_hot:
            inputs = [f"{c}_class" for c in categoricals]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=inputs))
    if impute and numerics:
        stages.append(Imputer(strategy="mean", inputCols=numerics, outputCols=numerics))
    stages.append(
        VectorAssembler(inputCols=inputs + numerics, outputCol="features", handleInvalid="skip")
    )
    if scale:
        stages.append(scaler_stage())
    return stages


def scaler_stage() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=True)


def build_pipeline(
    train: DataFrame,
    features: FeatureSet,
    one_hot: bool = True,
    impute: bool = False,
    scale: bool = False,
) -> PipelineModel:
    """Fit the preparation on training rows only."""
    needed = train.select(*features.columns)
    return Pipeline(stages=preparation_stages(features, one_hot, impute, scale)).fit(needed)


def _parts(pipeline: PipelineModel):
    """(stages that number labels and fill holes, encoders, the assembler) of a fitted preparation."""
    stages = list(pipeline.stages)
    last = next(i for i, stage in enumerate(stages) if isinstance(stage, VectorAssembler))
    encoders = [s for s in stages[:last] if isinstance(s, OneHotEncoderModel)]
    return [s for s in stages[:last] if s not in encoders], encoders, stages[last]


def numbered(pipeline: PipelineModel, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows that a fitted preparation keeps, with the columns (named beside them) that :func:`vectors`
    takes: labels as numbers, numbers without holes."""
    first, encoders, assembler = _parts(pipeline)
    made = {c for s in encoders for c in s.getOutputCols()}
    labels = {c for s in first if isinstance(s, StringIndexerModel) for c in s.getOutputCols()}
    inputs = [c for s in encoders for c in s.getInputCols()] + [c for c in assembler.getInputCols() if c not in made]
    for stage in first:
        rows = stage.transform(rows)
    numbers = [c for c in inputs if c not in labels]  # an indexer that skips leaves no null
    return (rows.na.drop(subset=numbers) if numbers else rows), inputs


def _dense(encoders: Sequence[OneHotEncoderModel], assembler: VectorAssembler, rows: DataFrame) -> tuple[Column, int] | None:
    """(the assembler's entries as one array, their number), or None where only the stages can tell."""
    sizes = {}
    if not encoders:
        return None  # the assembler alone is one call a row
    for stage in encoders:
        if stage.getHandleInvalid() != "error" or not stage.getDropLast():
            return None
        sizes |= {out: (c, n) for c, out, n in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes)}
    parts, width, cells = [], 0, 0
    for name in assembler.getInputCols():
        if name in sizes:
            column, n = sizes[name]
            lines = ", ".join("array(" + ", ".join("1D" if i == j else "0D" for j in range(n - 1)) + ")" for i in range(n))
            parts.append(F.get(F.expr(f"array({lines})"), F.col(f"`{column}`").cast("int")))  # the last label has no entry
            width, cells = width + n - 1, cells + n * (n - 1)
        elif isinstance(rows.schema[name].dataType, T.NumericType):
            parts.append(F.array(F.col(f"`{name}`").cast("double")))
            width += 1
        else:
            return None
    return (F.concat(*parts), width) if cells <= PLAN_CELLS else None


def vectors(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`numbered` with ``features``, as the whole preparation makes them.

    The encoders would make a vector of every label of a row, and the assembler take them apart again. So the
    entries are laid out as one array by the plan, and the assembler makes the vector of it.
    """
    _, encoders, assembler = _parts(pipeline)
    whole = rows
    for stage in encoders:
        whole = stage.transform(whole)
    whole = assembler.copy().setHandleInvalid("error").transform(whole)
    laid = _dense(encoders, assembler, rows)
    if laid is None:
        return whole
    out, (entries, width) = assembler.getOutputCol(), laid
    flat = rows.withColumn("__flat", array_to_vector(entries).alias("__flat", metadata={"ml_attr": {"num_attrs": width}}))
    made = VectorAssembler(inputCols=["__flat"], outputCol=out, handleInvalid="error").transform(flat)
    return made.withColumn(out, F.col(out).alias(out, metadata=whole.schema[out].metadata)).drop("__flat")


def transformed(pipeline: PipelineModel, rows: DataFrame, shown: Sequence[str], in_steps: bool = False) -> DataFrame:
    """``pipeline.transform(rows)``, the columns ``shown`` and ``features``. ``in_steps`` writes the rows between
    :func:`numbered` and :func:`vectors`, for tables of many rows: both together are too long for their code to
    be compiled."""
    known, inputs = numbered(pipeline, rows)
    known = known.select(*dict.fromkeys([*shown, *inputs]))
    return vectors(pipeline, staged(known, "numbered") if in_steps else known).select(*shown, "features")


def feature_names(prepared: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries, in vector order, from the column's ML attributes."""
    groups = prepared.schema[column].metadata["ml_attr"]["attrs"]
    entries = [entry for group in groups.values() for entry in group]
    return [e["name"] for e in sorted(entries, key=lambda e: e["idx"])]
