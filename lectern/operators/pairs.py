"""Prompt and response pairs from conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prompt_response(turns: DataFrame, key: str = "conv_id", order: str = "turn", prompt: str = "user", response: str = "assistant") -> DataFrame:
    """key, order, prompt, response: each prompt turn that a response turn follows at once."""
    w = Window.partitionBy(key).orderBy(order)
    rows = turns.select(key, order, "role", "text", F.lead("role").over(w).alias("_next"), F.lead("text").over(w).alias("_answer"))
    return rows.where((F.col("role") == prompt) & (F.col("_next") == response)).select(key, order, F.col("text").alias("prompt"), F.col("_answer").alias("response"))
