"""Preference formatting of conversation pairs.

A pair holds two conversations, chosen and rejected, as arrays of turns (role, text).  The longest
common prefix of turns is rendered once as the prompt; what follows is rendered on each side as a
completion with its loss mask: the spans (start, length in code points) of assistant texts.  A
completion that begins inside an assistant turn does not occur, since whole turns are compared; when
the first turn after the prefix is the assistant's on both sides, its header belongs to the prompt.

All of it is array expressions inside one row; the only shuffle gathers the turns of a conversation.

Defined cases: a null text is empty and a null role is "user"; turns are ordered by number, then role
and text, and a repeated row counts once; equal conversations have the whole conversation as prompt and two
empty completions; a missing side is an empty conversation; control marks inside texts are broken up
so that they cannot end a turn; a text of any length is one cell of its row; an empty table gives an empty
table; extra columns are kept by ``format_pairs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

TURN = "struct<role:string,text:string>"
END = "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    return rows.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), _safe(turn["role"]), F.lit("|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _safe(t["text"]), F.lit(END))), "")


def _spans(turns: Column) -> Column:
    """Spans of the assistant texts in the rendering of ``turns``."""
    step = F.aggregate(
        turns, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(F.concat(_header(t), _safe(t["text"]), F.lit(END)))).cast("long").alias("at"),
            F.when(t["role"] == "assistant", F.array_append(acc["spans"], F.struct(
                (acc["at"] + F.char_length(_header(t))).cast("long").alias("start"),
                F.char_length(F.concat(_safe(t["text"]), F.lit(END))).cast("long").alias("length")))).otherwise(acc["spans"]).alias("spans")))
    return step["spans"]


def _common(a: Column, b: Column) -> Column:
    """Number of equal leading turns."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.filter(F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z, i: F.when(
        (i < shorter) & z["x"].eqNullSafe(z["y"]), F.lit(None).cast("int")).otherwise(i)), lambda i: i.isNotNull())
    return F.coalesce(F.get(differs, F.lit(0)), shorter)


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """All columns but the two conversations, plus n_common, prompt, and for each side the completion
    text and its assistant spans (a column of the same name is replaced).  A completion's opening assistant
    header, the same on both sides, is moved to the prompt (spans are relative to the completion)."""
    empty, opening = F.array().cast(f"array<{TURN}>"), "<|assistant|>\n"
    made = ("n_common", "prompt", "chosen_text", "chosen_spans", "rejected_text", "rejected_spans")
    keep = [c for c in pairs.columns if c not in (chosen, rejected) and c.lower() not in made]
    df, name = pairs, {}
    for base in ("__a", "__b", "__n", "__rest_a", "__rest_b", "__cut"):
        name[base] = fresh(df, base)
        if base in ("__a", "__b"):
            column = F.coalesce(chosen if base == "__a" else rejected, empty)
        elif base == "__n":
            column = _common(F.col(name["__a"]), F.col(name["__b"]))
        elif base == "__cut":
            both = [F.get(F.col(name[r]), F.lit(0))["role"] == "assistant" for r in ("__rest_a", "__rest_b")]
            column = F.when(both[0] & both[1], len(opening)).otherwise(0)
        else:
            whole = F.col(name["__" + base[-1]])
            column = F.when(F.size(whole) > 0, F.slice(whole, F.col(name["__n"]) + 1, F.size(whole))).otherwise(empty)
        df = df.withColumn(name[base], column)
    a, n, cut = (F.col(name[x]) for x in ("__a", "__n", "__cut"))
    out = [n.cast("long").alias("n_common"),
           F.concat(_render(F.slice(a, F.lit(1), n)), F.when(cut > 0, opening).otherwise("")).alias("prompt")]
    for rest, side in (("__rest_a", "chosen"), ("__rest_b", "rejected")):
        text = _render(F.col(name[rest]))
        out += [F.substring(text, cut + 1, F.char_length(text)).alias(f"{side}_text"),
                F.transform(_spans(F.col(name[rest])), lambda x: F.struct(
                    (x["start"] - cut).cast("long").alias("start"), x["length"].alias("length"))).alias(f"{side}_spans")]
    return df.select(*keep, *out)


def reply_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from a plain conversation table: chosen is a conversation with all its turns, rejected the same
    up to its last assistant turn, that reply exchanged for the last reply of the conversation whose id
    follows.  Without an assistant turn both are the whole conversation; without a following reply
    rejected ends before the conversation's own.  An id that is no number is followed by none."""
    conv = conversations(turns)
    last = F.array_max(F.transform(F.col("turns"), lambda t, i: F.when(t["role"] == "assistant", i)))
    conv = conv.withColumn("last", last).withColumn("number", F.col("conv_id").cast("string").try_cast("long"))
    reply = F.get("turns", F.col("last"))
    follow = conv.where("last is not null and number is not null").select(F.try_subtract("number", F.lit(1)).alias("number"), reply.alias("other"))
    before = F.slice("turns", F.lit(1), F.col("last"))
    whole = F.col("last").isNull()
    return conv.join(follow, "number", "left").select(
        "conv_id", F.col("turns").alias("chosen"),
        F.when(whole, F.col("turns")).when(F.col("other").isNull(), before).otherwise(F.concat(before, F.array("other"))).alias("rejected"))


# DuckDB statement of ``format_pairs(reply_pairs(conversations))`` as the query prints it; it searches the common prefix.
SQL = r"""
WITH r AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM r),
l AS (SELECT conv_id, max(k) FILTER (role = 'assistant') AS last FROM t GROUP BY conv_id),
reply AS (SELECT t.conv_id, t.role, t.text FROM t JOIN l ON t.conv_id = l.conv_id AND t.k = l.last),
side AS (SELECT 'a' AS s, conv_id, k, role, text FROM t
         UNION ALL SELECT 'b', t.conv_id, k, role, text FROM t JOIN l ON l.conv_id = t.conv_id WHERE last IS NULL OR k < last
         UNION ALL SELECT 'b', l.conv_id, last, role, text FROM l JOIN reply ON reply.conv_id = l.conv_id + 1 WHERE last IS NOT NULL),
size AS (SELECT conv_id, count(*) FILTER (s = 'a') AS na, count(*) FILTER (s = 'b') AS nb FROM side GROUP BY conv_id),
differs AS (SELECT a.conv_id, min(a.k) AS k FROM side a JOIN side b ON a.conv_id = b.conv_id AND a.k = b.k AND a.s = 'a' AND b.s = 'b'
            WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.conv_id),
c AS (SELECT size.conv_id, coalesce(differs.k - 1, least(na, nb)) AS n FROM size LEFT JOIN differs ON differs.conv_id = size.conv_id),
x AS (SELECT c.conv_id, n, count(*) FILTER (side.role = 'assistant') = 2 AS opens
      FROM c LEFT JOIN side ON side.conv_id = c.conv_id AND side.k = n + 1 GROUP BY c.conv_id, n),
u AS (SELECT s, side.conv_id, k, k > n AS rest, opens, role = 'assistant' AS own,
             '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
      FROM side JOIN x ON x.conv_id = side.conv_id),
w AS (SELECT *, coalesce(sum(length(head || body)) OVER (PARTITION BY s, conv_id, rest ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + length(head) - CASE WHEN opens THEN 14 ELSE 0 END AS pos FROM u),
g AS (SELECT conv_id, any_value(opens) AS opens,
             coalesce(string_agg(head || body, '' ORDER BY k) FILTER (s = 'a' AND NOT rest), '') AS prompt,
             coalesce(string_agg(head || body, '' ORDER BY k) FILTER (s = 'a' AND rest), '') AS a,
             coalesce(string_agg(head || body, '' ORDER BY k) FILTER (s = 'b' AND rest), '') AS b,
             coalesce(string_agg(CAST(pos AS BIGINT) || '+' || length(body), ',' ORDER BY k) FILTER (s = 'a' AND rest AND own), '') AS am,
             coalesce(string_agg(CAST(pos AS BIGINT) || '+' || length(body), ',' ORDER BY k) FILTER (s = 'b' AND rest AND own), '') AS bm
      FROM w GROUP BY conv_id)
SELECT g.conv_id, CAST(n AS BIGINT) AS n_common, prompt || CASE WHEN g.opens THEN '<|assistant|>' || chr(10) ELSE '' END AS prompt,
       CASE WHEN g.opens THEN substr(a, 15) ELSE a END AS chosen_text, CASE WHEN g.opens THEN substr(b, 15) ELSE b END AS rejected_text,
       am AS chosen_mask, bm AS rejected_mask
FROM g JOIN x ON x.conv_id = g.conv_id
"""
