"""Batch jobs over chat logs: context windows and tool-call flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee import schemas
from marquee.operators.dedup import top_n_per_group


def chat_context(turns: DataFrame, n: int = K.CONTEXT_TURNS) -> DataFrame:
    """(conv_id, messages): the last ``n`` turns of each conversation, then only user and assistant ones, oldest first.

    A turn of another role uses up one of the ``n`` places; a conversation with no other turns left has an empty list.
    """
    last = top_n_per_group(turns, ["conv_id"], [F.col("turn").desc()], n)
    message = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content"))
    kept = F.collect_list(F.when(F.col("role").isin(*K.CONTEXT_ROLES), message))
    return last.groupBy("conv_id").agg(F.array_sort(kept).alias("messages"))


def tool_calls(responses: DataFrame, keys: list[str], response_col: str = "response") -> DataFrame:
    """One row per tool call of each logged model response; a response without calls gives one row with NULL call fields.

    Only the first choice counts. A missing content is empty; arguments that are not a JSON object become an empty map;
    ``known`` tells whether the tool exists.
    """
    message = F.get(F.from_json(response_col, schemas.RESPONSE_PAYLOAD)["choices"], F.lit(0))["message"]
    calls = (
        responses.select(*keys, message.alias("m"))
        .select(*keys, F.coalesce("m.content", F.lit("")).alias("content"), F.posexplode_outer("m.tool_calls").alias("call_pos", "c"))
    )
    name = F.col("c.function.name")
    arguments = F.from_json(F.col("c.function.arguments"), "map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    return calls.select(
        *keys,
        "content",
        "call_pos",
        F.col("c.id").alias("call_id"),
        name.alias("tool"),
        F.coalesce(arguments, empty).alias("arguments"),
        F.when(F.col("call_pos").isNotNull(), F.coalesce(name.isin(*K.TOOL_NAMES), F.lit(False))).alias("known"),
    )


def cut_observation(df: DataFrame, col: str = "content") -> DataFrame:
    """Tool output as the model sees it."""
    return df.withColumn(col, F.left(F.col(col), F.lit(K.OBSERVATION_CHARS)))
