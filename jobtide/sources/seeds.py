"""Seed tables shipped with the package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from jobtide.schemas import RATES

RATES_CSV = Path(__file__).parent.parent / "data" / "exchange_rates.csv"


def read_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Exchange rates with declared types; lines starting with # are comments.

    The packaged copy is a few rows handed over by the driver, as executors do not share its disk.
    """
    if path is not None:
        return spark.read.schema(RATES).csv(path, header=True, comment="#", mode="FAILFAST")
    lines = RATES_CSV.read_text(encoding="utf-8").splitlines()
    text = spark.createDataFrame([(line,) for line in lines if not line.startswith("#")][1:], "line string")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATES)
    return text.selectExpr(f"from_csv(line, '{columns}', map('mode', 'FAILFAST')) r").select("r.*")
