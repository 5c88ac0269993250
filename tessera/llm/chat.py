r"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes its own example: all turns before it as context,
then that reply, the only text under the loss mask.  Turns after the last reply
(or all turns of a conversation without one) form one last example without a
target, so that no turn is lost.

Template (markers are parameters of nothing else; they are the control strings)::

    user       [INST] text [/INST]
    assistant  <s>text</s>
    any other  [ROLE]role[/ROLE]text</s>

Escaping: inside a role or text one backslash is put after the first character
of every control string and of every control string that already holds
backslashes there (``[INST]`` -> ``[\INST]`` -> ``[\\INST]``), which is undone
by taking one away.  Escaped text holds no control string, so the formatted
text can be split at its markers.

Defined cases: null text or role counts as empty; turns are ordered by turn
(null first), then role, then text, so ties and repeated rows have one order;
rows with a null conversation id form one conversation; an empty table gives an
empty result; other columns are not read.

A conversation is one value here, as a document is elsewhere: its digest needs
its turns in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_CONTROL = r"([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)"
_ESCAPED = r"([\[<])\\(\\*)(/?INST\]|/?ROLE\]|/?s>)"
_TURN = r"(?s)\[INST\] (.*?) \[/INST\]|<s>(.*?)</s>|\[ROLE\](.*?)\[/ROLE\](.*?)</s>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2$3")


def format_turn(role: Column, text: Column) -> Column:
    return (F.when(role == "user", F.concat(F.lit("[INST] "), escape(text), F.lit(" [/INST]")))
            .when(role == "assistant", F.concat(F.lit("<s>"), escape(text), F.lit("</s>")))
            .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"), escape(text), F.lit("</s>"))))


def parse_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted text."""
    def one(x: Column) -> Column:
        part = lambda g: unescape(F.regexp_extract(x, _TURN, g))
        return (F.when(x.startswith("[INST] "), F.struct(F.lit("user").alias("role"), part(1).alias("text")))
                .when(x.startswith("<s>"), F.struct(F.lit("assistant").alias("role"), part(2).alias("text")))
                .otherwise(F.struct(part(3).alias("role"), part(4).alias("text"))))
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), 0), one)


def expand_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, example, text, loss_start, loss_chars, is_last``: one row per target.

    ``loss_start`` (0-based) and ``loss_chars`` give the span of ``text``, in code
    points, under the loss mask; both are null in an example without a target.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    convs = (turns.select(F.col(conv_col).alias("conv_id"), F.struct(
                F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
             .select("conv_id", F.transform("ts", lambda t: F.struct(
                 (t["role"] == "assistant").alias("reply"),
                 format_turn(t["role"], t["text"]).alias("f"))).alias("fs")))
    fs = F.col("fs")
    ends = F.filter(F.sequence(F.lit(1), F.size(fs)),
                    lambda i: F.get(fs, i - 1)["reply"] | (i == F.size(fs)))
    one = (convs.withColumn("ends", ends)
           .select("conv_id", "fs", F.posexplode("ends").alias("example", "end"))
           .withColumn("last", F.get(fs, F.col("end") - 1)))
    context = F.array_join(F.transform(F.slice(fs, F.lit(1), F.col("end") - 1), lambda x: x["f"]), "")
    ex = one.select("conv_id", "example", context.alias("context"), F.col("last.f").alias("reply"),
                    F.col("last.reply").alias("target"), (F.col("end") == F.size(fs)).alias("is_last"))
    return ex.select(
        "conv_id", "example", F.concat("context", "reply").alias("text"),
        F.when(F.col("target"), F.length("context") + F.length(F.lit("<s>"))).alias("loss_start"),
        F.when(F.col("target"), F.length("reply") - F.length(F.lit("<s></s>"))).alias("loss_chars"),
        "is_last")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts and masks alone: its turns, the
    unescaped text under the loss masks in order, and the formatted length."""
    loss = F.when(F.col("loss_start").isNotNull(),
                  unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_chars"))))
    per = examples.select("conv_id", "example", loss.alias("loss"), F.length("text").cast("long").alias("chars"),
                          F.when(F.col("is_last"), F.col("text")).alias("whole"))
    return (per.groupBy("conv_id").agg(
                F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"),
                F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("l"))
            .select("conv_id", parse_turns(F.col("whole")).alias("turns"),
                    F.array_join(F.transform("l", lambda x: x["loss"]), "").alias("loss_text"), "formatted_chars"))


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)', '\1\\\2\3', 'g')) AS n,
    length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)', '\1\\\2\3', 'g')) AS m FROM c),
f AS (SELECT *, CASE role WHEN 'user' THEN n + 15 WHEN 'assistant' THEN n + 7 ELSE n + m + 17 END AS chars,
    row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS k FROM e
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM f)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
    sum(CASE WHEN role = 'assistant' OR i = k THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""
