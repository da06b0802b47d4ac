"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``.  Inside roles and texts ``%``, ``<`` and ``[`` become
``%25``, ``%3C`` and ``%5B`` (a line break in a role ``%0A``), so neither these marks nor the control strings of other
templates can stand in a text, and the text can be read back exactly.

Every assistant turn becomes one example: all turns up to it, and a loss mask over that reply's text alone.  If the
last turn is not an assistant's, one more example without a loss holds the whole conversation, so that no turn is lost.
Contexts repeat earlier turns by design; the output grows with the square of one conversation's turns, not of the table.

Cases: null roles and texts are empty; turns are ordered by (turn, role, text), null turns first, repeated rows are
repeated turns; rows with a null conv_id are one conversation; an empty table gives no example; extra columns are
dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Order matters: the escape character goes first, and comes back last.
ESCAPES = (("%", "%25"), ("<", "%3C"), ("[", "%5B"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("%0A"), F.lit("\n")))


def format_conversations(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length): loss positions count code points from 1; no loss has length 0."""
    empty = F.lit("")
    rows = conversations.select(
        "conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t")
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n"))
    whole = whole.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == target_role).alias("is_target"),
        F.transform("turns", lambda t: F.concat(head(t), escape(t["text"]), F.lit(CLOSE))).alias("parts"),
        F.transform("turns", lambda t: F.length(head(t))).alias("head"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("body"),
    )
    last = F.size("parts")
    picked = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | F.element_at(F.col("is_target"), i))
    one = whole.withColumn("example", F.explode(picked))
    i = F.col("example")
    before = F.array_join(F.slice("parts", F.lit(1), i - 1), "")
    targeted = F.element_at("is_target", i)
    return one.select(
        "conv_id",
        "example",
        F.concat(before, F.element_at("parts", i)).alias("text"),
        F.when(targeted, F.length(before) + F.element_at("head", i) + 1).otherwise(F.lit(1)).alias("loss_start"),
        F.when(targeted, F.element_at("body", i)).otherwise(F.lit(0)).alias("loss_length"),
        targeted.alias("trainable"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted text says: the turns of a conversation's longest example, and all text under the loss masks."""
    under = unescape(F.col("text").substr(F.col("loss_start"), F.col("loss_length")))
    found = examples.select("conv_id", "example", "text", F.when(F.col("trainable"), F.struct("example", under.alias("loss"))).alias("l"))
    whole = found.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.sort_array(F.collect_list("l")).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    pieces = F.filter(F.split("full", F.lit(r"<\|im_end\|>\n"), -1), lambda p: p != "")
    role = lambda p: F.substring_index(p.substr(F.lit(len(OPEN) + 1), F.length(p)), "\n", 1)
    body = lambda p: p.substr(F.length(role(p)) + len(OPEN) + 2, F.length(p))
    said = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    turns = F.transform(pieces, lambda p: F.concat(_unescape_role(role(p)), F.lit("\n"), unescape(body(p)), F.lit("\n")))
    return whole.select(
        "conv_id",
        F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"),
        F.sha2(said, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.sql(
        "SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)"
    )
    return read_back(format_conversations(c.unionByName(more)))


OP9_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         24 + length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '[', '%5B'), chr(10), '%0A'))
            + length(replace(replace(replace(text, '%', '%25'), '<', '%3C'), '[', '%5B')) AS chars
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, max(n)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (WHERE role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
