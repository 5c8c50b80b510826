"""Multi-party perspective rotation.

Every speaker of a conversation is once the assistant: the dialogue is
rendered with that speaker's turns as ``assistant``, all others as named
users, and the loss mask covers the assistant's words (and end marks) only.
System turns stay system turns in every rendering and are no participant.

A rendering is cut into parts of ``TURNS`` turns, so no conversation, however
long, is gathered in one task; ordinary ones are a single part. Turns are
numbered by a window per conversation; conversations of more than ``LONG``
turns are numbered by a distributed sort instead, with the same numbers.

Defined results: turns are ordered by turn (nulls first), speaker, text; a
null text is empty; a null or blank speaker is the named user ``unknown`` and
no participant; a conversation without participants has no rendering; repeated
rows are turns of their own; a null conversation id is a conversation of its
own; other columns are ignored. ``<|`` in a text loses its force (``< |``),
and names are escaped one to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.ids import with_dense_ids

TURNS = 1_024
LONG = 10_000
SYSTEM = ("system",)
END = "<|end|>"


def _number(turns: DataFrame, long: int) -> DataFrame:
    """Adds pos, the 0-based place of each turn in its conversation."""
    order = ["turn", "speaker", "text"]
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long).select(F.col("conv_id").alias("l_conv"))
    is_long = turns.conv_id.eqNullSafe(sizes.l_conv)
    w = Window.partitionBy("conv_id").orderBy(*order)
    short = turns.join(sizes, is_long, "left_anti").withColumn("pos", F.row_number().over(w).cast("long") - 1)
    if sizes.isEmpty():
        return short
    rest = with_dense_ids(turns.join(sizes, is_long, "left_semi"), ["conv_id", *order], "at")
    first = rest.groupBy("conv_id").agg(F.min("at").alias("first")).withColumnRenamed("conv_id", "f_conv")
    rest = rest.join(first, rest.conv_id.eqNullSafe(first.f_conv)).withColumn("pos", F.col("at") - F.col("first"))
    return short.unionByName(rest.select(*short.columns))


def _escaped(name: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("|", "\\x7c")):
        name = F.replace(name, F.lit(plain), F.lit(safe))
    return name


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
           system: tuple[str, ...] = SYSTEM, turns_per_part: int = TURNS, long: int = LONG) -> DataFrame:
    """conv_id, perspective, part, n_turns, n_targets, rendered, mask
    (array of [first, end) character spans that count for the loss)."""
    blank = F.trim(F.coalesce(F.col(speaker_col).cast("string"), F.lit("")))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.when(blank != "", F.col(speaker_col).cast("string")).alias("speaker"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    people = (rows.where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*system))
              .select(F.col("conv_id").alias("p_conv"), F.col("speaker").alias("perspective")).distinct())
    numbered = _number(rows, long).withColumn("part", F.floor(F.col("pos") / turns_per_part).cast("long"))
    seen = numbered.join(people, numbered.conv_id.eqNullSafe(people.p_conv))
    target = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    name = _escaped(F.coalesce(F.col("speaker"), F.lit("unknown")))
    head = (F.when(target, F.lit("<|assistant|>\n")).when(F.col("speaker").isin(*system), F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit('<|user name="'), name, F.lit('"|>\n'))))
    body = F.concat(F.replace(F.col("text"), F.lit("<|"), F.lit("< |")), F.lit(END))
    grouped = (seen.select("conv_id", "perspective", "part", F.struct("pos", head.alias("head"), body.alias("body"), target.alias("target")).alias("t"))
               .groupBy("conv_id", "perspective", "part").agg(F.sort_array(F.collect_list("t")).alias("t")))
    size = lambda x: F.length(x["head"]) + F.length(x["body"]) + 1
    spans = F.aggregate(
        "t", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,end:int>>").alias("spans")),
        lambda a, x: F.struct((a["at"] + size(x)).alias("at"), F.when(x["target"], F.concat(a["spans"], F.array(F.struct(
            (a["at"] + F.length(x["head"])).alias("first"), (a["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end")))))
            .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    return grouped.select("conv_id", "perspective", "part", F.size("t").cast("long").alias("n_turns"),
                          F.size(F.filter("t", lambda x: x["target"])).cast("long").alias("n_targets"),
                          F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("rendered"),
                          spans.alias("mask"))


def flat(result: DataFrame) -> DataFrame:
    """The result with the mask as text: ``first-end,first-end``."""
    return result.withColumn("mask", F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["first"].cast("string"), s["end"].cast("string"))), ","))


SQL = r"""
WITH t AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos,
                  replace(coalesce(text, ''), '<|', '< |') || '<|end|>' AS body FROM conversations),
s AS (SELECT t.conv_id, p.perspective, pos // 1024 AS part, pos, role = perspective AS target, body,
             CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                  ELSE '<|user name="' || role || '"|>' END || chr(10) AS head
      FROM t JOIN (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system') p USING (conv_id)),
o AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY pos
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS first FROM s)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (WHERE target) AS n_targets,
       string_agg(head || body || chr(10), '' ORDER BY pos) AS rendered,
       coalesce(string_agg(CAST(CAST(first AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(first + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
                FILTER (WHERE target), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""
