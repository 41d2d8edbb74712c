"""Shared literals of the tests."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.operators.validate import record_schema

AT = F.lit("2026-07-19T12:00:00Z").cast("timestamp")
STAMP = datetime(2026, 7, 19, 12)


def records(spark, kind, rows):
    return spark.createDataFrame([("1.0", kind, source, content, STAMP) for source, content in rows], record_schema(kind))


def gemini(text):
    return json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}}]})


def chat(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})
