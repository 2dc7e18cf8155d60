"""Multi-party perspective rotation: every participant's view of a dialogue, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The markers that open and close one turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", context_roles: tuple[str, ...] = ("system", "tool"), part_turns: int = 64) -> DataFrame:
    """For every participant, the dialogue with that speaker as assistant: ``conv, speaker, part, text, spans, n_own``.

    Speakers are the distinct roles of a conversation but for ``context_roles``; a null role speaks as "unknown". The
    speaker's turns are headed ``assistant``, other participants' ``user name=<role>``, context turns by their role.
    ``spans`` are the half-open character ranges, counted from the start of the whole rendering, of the speaker's own
    contents with their end marker: the training mask; everything else is masked out.

    A rendering is cut into parts of ``part_turns`` turn numbers, which put together in order are the whole; ordinary
    dialogues have one. So no task holds a conversation of unbounded length: offsets come from sums over parts. Turns are
    ordered by number (null last), then role and text; ties and repeated rows all stay. A null text renders as empty. A
    conversation of context turns alone has no participant and no row. A null conversation id is one conversation. Other
    columns are left out; an empty table gives an empty one.
    """
    t = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("unknown")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    t = t.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit((1 << 62) // part_turns)))
    spoken = ~F.col("role").isin(*context_roles)
    sides = t.where(spoken).select(F.col("conv").alias("its"), F.col("role").alias("speaker")).distinct()
    views = t.join(sides, F.col("conv").eqNullSafe(F.col("its"))).drop("its")
    own = F.col("role") == F.col("speaker")
    head = F.when(own, F.lit("assistant")).when(F.col("role").isin(*context_roles), F.col("role")).otherwise(F.concat(F.lit("user name="), F.col("role")))
    views = views.select("conv", "speaker", "part", "turn", "role", "body", own.alias("own"), F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"))
    seg = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "body", "head", "own")
    parts = views.groupBy("conv", "speaker", "part").agg(F.sort_array(F.collect_list(seg)).alias("segs"))
    end = F.length(F.lit(CLOSE))
    step = lambda a, s: F.struct(
        (a["at"] + F.length(s["head"]) + F.length(s["body"]) + end).alias("at"),
        F.when(s["own"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(s["head"])).alias("start"), (a["at"] + F.length(s["head"]) + F.length(s["body"]) + end - 1).alias("end"))))).otherwise(a["spans"]).alias("spans"),
    )
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    parts = parts.withColumn("done", F.aggregate("segs", zero, step))
    parts = parts.withColumn("body", F.array_join(F.transform("segs", lambda s: F.concat(s["head"], s["body"], F.lit(CLOSE))), ""))
    before = Window.partitionBy("conv", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "speaker", "part", "body", "done", F.coalesce(F.sum(F.col("done.at").cast("long")).over(before), F.lit(0)).cast("long").alias("from"), (F.row_number().over(Window.partitionBy("conv", "speaker").orderBy("part")) - 1).alias("nth"))
    spans = F.transform("done.spans", lambda s: F.struct((s["start"] + F.col("from")).alias("start"), (s["end"] + F.col("from")).alias("end")))
    return parts.select(F.col("conv").alias(conv), "speaker", F.col("nth").cast("int").alias("part"), F.col("body").alias("text"), spans.alias("spans"), F.size("done.spans").alias("n_own"))


#: What the registered query returns, in SQL (turn numbers there are below one part).
ORACLE = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body FROM conversations),
sides AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role NOT IN ('system', 'tool')),
v AS (SELECT t.*, speaker, role = speaker AS own, '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role IN ('system', 'tool') THEN role ELSE 'user name=' || role END || chr(10) AS head FROM t JOIN sides USING (conv_id)),
o AS (SELECT *, sum(length(head) + length(body) + 11) OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, body ROWS UNBOUNDED PRECEDING) AS stop FROM v)
SELECT conv_id, speaker, CAST(0 AS INTEGER) AS part, string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY turn, role, body) AS text,
  string_agg(CASE WHEN own THEN (stop - length(body) - 11) || '-' || (stop - 1) END, ',' ORDER BY turn, role, body) AS spans, CAST(sum(CAST(own AS INTEGER)) AS INTEGER) AS n_own
FROM o GROUP BY conv_id, speaker
"""
