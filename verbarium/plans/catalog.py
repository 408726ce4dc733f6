"""All queries of the library and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verbarium.plans import composed, lexical, problems

QUERIES = {**problems.QUERIES, **lexical.QUERIES, **composed.QUERIES}
ORACLE = {**problems.ORACLE, **lexical.ORACLE, **composed.ORACLE}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.paradigms(spark, sf)
