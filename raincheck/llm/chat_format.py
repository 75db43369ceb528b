r"""Chat formatting by a grammar that is read back and compared.

Operator 4 [native]. A conversation is rendered as turns

    ### Role: body </turn>\n

and read by a deterministic grammar: the text splits at every close mark, each
piece is a header ``### `` role ``: `` and a body, and in role and body a
backslash before ``\ # < :`` stands for that character; any other backslash is
itself. Control strings inside a text, ``###`` at the beginning of a line and
``</turn`` anywhere, always get a backslash, so both stand in a formatted text as
marks only. A turn is first rendered like this and read back; when what is read
differs from the source (the text has backslashes of its own that would be read
as escapes), all its conflicting characters are escaped and it is rendered
again. That form always reads back, which the operator checks for every
conversation before it returns it (an error is raised otherwise).

The role is written with its first letter in upper case when that is
reversible (a-z first letter); the exact role is kept by an escape otherwise.

Defined results: null text or role: empty; null conv_id: one conversation of
its own; a null turn comes first; turns sort by (turn, role, text), so repeated
rows stay, side by side; an empty table gives no rows; other columns are not
read. The turns of one conversation form one document and are gathered in one
row, as the output is one text per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLOSE = " </turn>\n"
LOSS_ROLE = "assistant"
#: The extra conversation of the query's contract.
EXTRA_ID = -7
EXTRA_TEXT = r"\### Assistant: </turn> ok"

_HEADER = r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): (.*)$"


def escape(c: Column) -> Column:
    """Backslash, ``###`` and ``</turn`` cannot be met in what this returns,
    other than as escapes."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("###"), F.lit("\\#\\#\\#"))
    return F.replace(c, F.lit("</turn"), F.lit("\\</turn"))


def guard(c: Column) -> Column:
    """Backslashes before the control strings alone."""
    c = F.regexp_replace(c, r"(^|\n)###", r"$1\\###")
    return F.replace(c, F.lit("</turn"), F.lit("\\</turn"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\:"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\#<:])", "$1")


def show_role(c: Column) -> Column:
    """assistant -> Assistant; a role that does not begin with a-z gets a leading ``:``-escape."""
    first = F.substring(c, 1, 1)
    plain = first.rlike("^[a-z]$")
    return F.when(plain, F.concat(F.upper(first), escape_role(F.expr("substring(role, 2)")))) \
        .otherwise(F.concat(F.lit("\\:"), escape_role(c)))


def read_role(c: Column) -> Column:
    rest = unescape(c)
    return F.when(c.startswith("\\:"), F.substr(rest, F.lit(2))) \
        .otherwise(F.concat(F.lower(F.substring(rest, 1, 1)), F.substr(rest, F.lit(2))))


def render(head: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), head, F.lit(": "), body, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns (role, text) that the grammar reads from a formatted text."""
    pieces = F.split(formatted, "\\Q" + CLOSE + "\\E")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)   # after the last close mark: nothing
    return F.transform(turns, lambda p: F.struct(
        read_role(F.regexp_extract(p, _HEADER, 1)).alias("role"),
        unescape(F.regexp_extract(p, _HEADER, 2)).alias("text")))


def conflicts(text: Column) -> Column:
    """Whether a turn with only its control strings escaped reads back as
    anything but the turn."""
    raw = parse(render(F.lit("X"), guard(text)))
    return (F.size(raw) != 1) | (F.get(raw, F.lit(0))["text"] != text)


def format_chats(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted text, the turns read back
    from it, and the loss mask (code-point spans of the bodies to learn)."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("head", show_role(F.col("role")))
    # Only a text with a backslash can be read back as another, so others skip the parse.
    suspect = F.contains("text", F.lit("\\"))
    rows = rows.withColumn("body", F.when(suspect & conflicts(F.col("text")), escape(F.col("text")))
                           .otherwise(guard(F.col("text"))))
    # Where a turn's body begins: what the turns before it take, and its own header.
    before = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text") \
        .rowsBetween(Window.unboundedPreceding, -1)
    lead, n = F.length("head") + 6, F.length("body")
    rows = rows.withColumn("start", (F.coalesce(F.sum(lead + n + len(CLOSE)).over(before), F.lit(0)) + lead).cast("int"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "start", "head", "body"))).alias("t"))
    out = grouped.select(
        "conv_id",
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
        F.array_join(F.transform("t", lambda t: render(t["head"], t["body"])), "").alias("formatted"),
        F.transform(F.filter("t", lambda t: t["role"] == loss_role), lambda t: F.struct(
            t["start"].alias("start"), F.length(t["body"]).alias("n"))).alias("loss_spans"))
    out = out.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns") == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a formatted conversation does not read back as its source")).cast("string"))
    return out.select("conv_id", checked.alias("formatted"), "turns", "loss_spans")


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["n"]))), "")


def query(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(LOSS_ROLE)).alias("role"),
        F.lit(EXTRA_TEXT).alias("text"))
    chats = format_chats(turns.unionByName(extra))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chats = chats.withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    return chats.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


# What the grammar writes, from its definition: control strings escaped, and
# everything where a text's own backslashes would be read as escapes.
ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, regexp_matches(text, '\\[\\#<:]') AS conflict,
    length(replace(regexp_replace(text, '(^|\n)###', '\1\\###', 'g'), '</turn', '\</turn')) AS guarded,
    length(replace(replace(replace(text, '\', '\\'), '###', '\#\#\#'), '</turn', '\</turn')) AS escaped,
    length(replace(replace(replace(replace(role, '\', '\\'), '###', '\#\#\#'), '</turn', '\</turn'), ':', '\:'))
      + CASE WHEN regexp_matches(role, '^[a-z]') THEN 0 ELSE 2 END AS head
  FROM turns
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(4 + head + 2 + CASE WHEN conflict THEN escaped ELSE guarded END + 9) AS formatted_chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
