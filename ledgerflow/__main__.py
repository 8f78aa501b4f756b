"""``python -m ledgerflow RAW OUT [--settings FILE]``: the whole batch, from raw CSV files to exports."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerflow.plans.pipeline import run_pipeline
from ledgerflow.settings import Settings, read_settings


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerflow", description="Raw transaction tables to star model, reports and exports.")
    parser.add_argument("raw", help="folder of the raw CSV files")
    parser.add_argument("out", help="folder the results go to")
    parser.add_argument("--settings", help="JSON file of run settings")
    given = parser.parse_args(arguments)
    settings = read_settings(given.settings) if given.settings else Settings()
    spark = SparkSession.builder.appName("ledgerflow").getOrCreate()
    for row in run_pipeline(spark, given.raw, given.out, settings).collect():
        print(f"{row.metric}: {row.value}")


if __name__ == "__main__":
    main()
