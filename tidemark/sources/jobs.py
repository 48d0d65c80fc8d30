"""Declarative bulk load: read, reshape in Python, reshape in SQL, spread, write."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.mapping import Stage, run_stages
from tidemark.sources.writers import load


@dataclass(frozen=True)
class LoadSpec:
    """One bulk load.

    transform  DataFrame -> DataFrame, runs first
    sql        query over the view `_input`, runs on what `transform` returns
    stages     load pipeline that the rows go through last
    clear      drop the earlier rows of this source first
    """

    source: str
    format: str
    path: str
    schema: str | None = None
    read_options: dict[str, str] = field(default_factory=dict)
    transform: Callable[[DataFrame], DataFrame] | None = None
    sql: str | None = None
    stages: Sequence[Stage] = ()
    output_partitions: int | None = None
    batch_size: int | None = None
    clear: bool = True
    output: str | None = None


def prepare(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The rows the load would write."""
    reader = spark.read.format(spec.format).options(**spec.read_options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    df = reader.load(spec.path)
    if spec.transform:
        df = df.transform(spec.transform)
    if spec.sql:
        # a view name of its own per load, so that two loads in one session do not see each other's rows
        view = f"_input_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        df = spark.sql(re.sub(r"\b_input\b", view, spec.sql))
    df = run_stages(df, spec.stages)
    if spec.output_partitions:
        df = df.repartition(spec.output_partitions)
    return df


def bulk_load(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """Run the load and return the table it wrote, with the column `data_source`."""
    if not spec.output:
        raise ValueError("the load has no output path")
    load(prepare(spark, spec), spec.output, spec.source, spec.clear, spec.batch_size)
    return spark.read.parquet(spec.output)
