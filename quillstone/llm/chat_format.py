"""Chat formatting with Spark expressions only.

Turns of a conversation are collected and sorted as structs, adjacent turns of one role are merged,
and each merged turn becomes ``<s>[INST]role[/INST]part<sep>part</s>``. Control strings in a role or
a text get a backslash after their first character and backslashes are doubled, so the output can be
read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, PART, CLOSE = "<s>[INST]", "[/INST]", "<sep>", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<sep>")


def _escaped(token: str) -> str:
    return f"{token[0]}\\{token[1:]}"


def escape(text: Column) -> Column:
    """text without control strings. Runs of backslashes become even, so a single one marks an escape."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for token in CONTROL:
        out = F.replace(out, F.lit(token), F.lit(_escaped(token)))
    return out


def unescape(text: Column) -> Column:
    out = text
    for token in CONTROL:
        out = F.replace(out, F.lit(_escaped(token)), F.lit(token))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _segment(text: Column, train: Column) -> Column:
    return F.struct(text.alias("text"), train.alias("train"))


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", train_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, segments, formatted.

    formatted is the concatenation of segments' texts; segments' ``train`` flags are the loss mask,
    true on the texts of train_role and false on markers and other roles. A null text or role counts
    as empty. Turns sort by (turn, role, text), null turns first, and repeated rows are repeated
    turns. Rows without a conversation id form one conversation. Only the four columns are read.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    starts = sorted_turns.withColumn(
        "starts",
        F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])),
    )
    merged = starts.select(
        "conv_id",
        F.transform(
            "starts",
            lambda s, i: F.struct(
                F.get("turns", s)["role"].alias("role"),
                F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", i + 1), F.size("turns")) - s), lambda t: escape(t["text"])).alias("parts"),
            ),
        ).alias("merged"),
    )

    def segments(m: Column) -> Column:
        train = m["role"] == train_role
        mark = lambda text: _segment(text, F.lit(False))
        parts = F.flatten(F.transform(m["parts"], lambda p, i: F.when(i == 0, F.array(_segment(p, train))).otherwise(F.array(mark(F.lit(PART)), _segment(p, train)))))
        return F.concat(F.array(mark(F.concat(F.lit(OPEN), escape(m["role"]), F.lit(BODY)))), parts, F.array(mark(F.lit(CLOSE))))

    out = merged.select("conv_id", F.flatten(F.transform("merged", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text, as they were before merging) and loss_text of formatted chats."""

    def turns(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, BODY, 1)
        parts = F.split(F.substr(body, F.length(role) + len(BODY) + 1), PART, -1)
        return F.transform(parts, lambda p: F.struct(unescape(role).alias("role"), unescape(p).alias("text")))

    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda p: p != "")
    loss = F.transform(F.filter("segments", lambda s: s["train"]), lambda s: unescape(s["text"]))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(pieces, turns)).alias("turns"), F.array_join(loss, "").alias("loss_text"))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """The digest columns of op9, all read back from the output."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESC = r"replace(replace(replace(replace(replace(replace({0}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<sep>', '<\sep>')"
OP9_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) v(a, b, c, d)
), e AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS first FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_ESC.format('text')}) + CASE WHEN first THEN 20 + length({_ESC.format('role')}) ELSE 5 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
