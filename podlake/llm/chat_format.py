r"""Chat formatting (operator 7): render conversations and read them back.

Grammar of the output, one turn after the other::

    turn   = "### " role ":" LF text LF "</turn>" LF
    marker = "### " or "</turn>", not preceded by a backslash

A text that holds a marker, or a marker with backslashes before it, would be
read as template. The round trip finds such turns: each turn is rendered
plainly, reparsed by the deterministic parser and compared to its source; a
turn that does not come back identical is escaped (one backslash before each
marker and its backslashes) and compared again. Unescaping takes exactly one
backslash off, so any text comes back. In a role, a backslash, a line feed and
the markers are escaped the same way. After rendering, the whole conversation is
parsed again, and every figure below is taken from what the parser recovers.

Everything is a built-in function; there is one shuffle, by conversation. A
conversation is one output string, so its turns meet in one row by definition.

Defined results: null text and role are empty; rows without a conv_id form one
conversation with a null id; turns order by (turn, role, text), null turns
first, and repeated rows are kept; an empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings (fixed values).
OPEN = "### "
CLOSE = "</turn>"

ESCAPE = r"(\\*)(### |</turn>)"
UNESCAPE = r"\\(\\*)(### |</turn>)"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPE, r"\\$1$2")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, UNESCAPE, "$1$2")


def role_out(c: Column) -> Column:
    """A role on one line: backslash and line feed written as pairs."""
    return escaped(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def role_in(c: Column) -> Column:
    return F.replace(F.replace(unescaped(c), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def turn_out(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), role_out(role), F.lit(":\n"), body, F.lit("\n" + CLOSE + "\n"))


def parsed(out: Column) -> Column:
    """The parser: array of (role, text) recovered from a rendered string."""
    pieces = F.split(out, "\n" + CLOSE + "\n", -1)
    turns = F.filter(pieces, lambda x: x != "")

    def turn(x):
        cut = F.instr(x, "\n")
        return F.struct(role_in(F.substring(x, F.lit(5), cut - 6)).alias("role"),
                        unescaped(F.substring(x, cut + 1, F.char_length(x))).alias("text"))

    return F.transform(turns, turn)


def rendered_turn(role: Column, text: Column) -> Column:
    """The plain rendering where it holds no marker and comes back identical,
    else the escaped one."""
    plain = turn_out(role, text)
    back = F.get(parsed(plain), 0)
    same = (back["role"] == role) & (back["text"] == text)
    free = ~F.contains(text, F.lit(OPEN)) & ~F.contains(text, F.lit(CLOSE))
    return F.when(free & same, plain).otherwise(turn_out(role, escaped(text)))


def format_conversations(rows: DataFrame) -> DataFrame:
    """The operator: conv_id, formatted (string), source and turns (arrays of
    (role, text): what went in and what the parser recovers), identical (boolean)."""
    t = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("out", rendered_turn(F.col("role"), F.col("text")))
    convs = t.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("all"))
    convs = convs.select(
        "conv_id", F.array_join(F.transform("all", lambda x: x["out"]), "").alias("formatted"),
        F.transform("all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
        .alias("source"))
    convs = convs.withColumn("turns", parsed(F.col("formatted")))
    return convs.withColumn("identical", F.col("turns") == F.col("source"))


def op7_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = (spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text"))
    own = spark.sql(r"""SELECT bigint(-7) AS conv_id, bigint(t) AS turn, r AS role,
                        replace('!### Assistant: </turn> ok', '!', char(92)) AS text
                        FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)""")
    convs = format_conversations(rows.unionByName(own))
    said = F.array_join(F.transform(F.filter("turns", lambda x: x["role"] == "assistant"),
                                    lambda x: x["text"]), "")
    convs = convs.withColumn("said", said)
    return convs.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(
            x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("said").cast("long").alias("loss_chars"),
        F.sha2("said", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "identical")


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), outs AS (
  SELECT *, 4 + length(role) + 2 + 9
         + length(text) + len(regexp_extract_all(text, '### |</turn>')) AS n_out
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n_out)::BIGINT AS formatted_chars, true AS identical
FROM outs GROUP BY conv_id
"""
