"""Run one job of the chain: see shopsieve/jobs.py."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from shopsieve.jobs import arguments, main

if __name__ == "__main__":
    arguments().parse_args()
    main(SparkSession.builder.appName(f"shopsieve {sys.argv[1]}").getOrCreate(), sys.argv[1:])
