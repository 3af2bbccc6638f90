"""Chat-log jobs over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import chatlog
from marquee.plans import views as V
from marquee.plans.registry import query


@query(
    "chat_context",
    """SELECT conv_id, count(*) FILTER (role IN ('user', 'assistant')) AS n_messages,
       md5(coalesce(string_agg(role || ':' || text, '|' ORDER BY turn) FILTER (role IN ('user', 'assistant')), '')) AS messages_md5
       FROM (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 6)
       GROUP BY conv_id""",
)
def chat_context(spark, sf):
    context = chatlog.chat_context(V.load(spark, sf, "conversations"))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return context.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"), F.md5(F.array_join(lines, "|")).alias("messages_md5")
    )


@query(
    "tool_call_log",
    """SELECT conv_id, turn, call_pos, tool, query, known, md5(substr(CASE WHEN role = 'system' THEN '' ELSE text END, 1, 2000)) AS content_md5
       FROM (
         SELECT *, 0 AS call_pos, 'search_movies_semantic' AS tool, role AS query, 1 AS known FROM conversations WHERE role <> 'user'
         UNION ALL SELECT *, 1, 'no_such_tool', '', 0 FROM conversations WHERE role <> 'user'
         UNION ALL SELECT *, -1, '', '', -1 FROM conversations WHERE role = 'user')""",
)
def tool_call_log(spark, sf):
    """Each turn as a model response: users' without calls, others' with a good call and a broken call to an unknown tool."""

    def call(pos: int, tool: str, arguments):
        function = F.struct(F.lit(tool).alias("name"), arguments.alias("arguments"))
        return F.struct(F.concat_ws("-", F.lit("c"), "turn", F.lit(pos)).alias("id"), function.alias("function"))

    good = F.to_json(F.struct(F.col("role").alias("query")))
    calls = F.array(call(0, "search_movies_semantic", good), call(1, "no_such_tool", F.lit("{broken")))
    message = F.struct(
        F.when(F.col("role") != "system", F.col("text")).alias("content"),
        F.when(F.col("role") != "user", calls).alias("tool_calls"),
    )
    responses = V.load(spark, sf, "conversations").select(
        "conv_id", "turn", F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices"))).alias("response")
    )
    log = chatlog.cut_observation(chatlog.tool_calls(responses, ["conv_id", "turn"]))
    return log.select(
        "conv_id",
        "turn",
        F.coalesce("call_pos", F.lit(-1)).alias("call_pos"),
        F.coalesce("tool", F.lit("")).alias("tool"),
        F.coalesce(F.col("arguments")["query"], F.lit("")).alias("query"),
        F.coalesce(F.col("known").cast("int"), F.lit(-1)).alias("known"),
        F.md5("content").alias("content_md5"),
    )
