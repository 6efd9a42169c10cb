r"""Chat formatting by event-sourced reconstruction, in DataFrame operations alone.

A log holds events of conversations: ``message`` opens a message of its turn,
``delta`` appends to the turn's last message, ``edit`` and ``regenerate`` put
their text in its place. Events are partitioned by conversation, sorted by turn
and sequence, and folded into final messages, which a template renders:

    <s>ROLE\nTEXT</s>

A backslash, ``<`` and ``[`` in texts and roles (and a line end in roles) are
escaped, so no text can hold a control string. The mask gives, for every turn,
how many characters precede its text and how many of the text carry loss
(assistant texts alone).

Events are folded in blocks of TURNS turns and SEQS sequence numbers, and what
a block leaves is events again: a whole message, or an edit or delta for the
message that an earlier block opened. Those few are folded a second time by the
same rule. So neither a conversation's events nor the deltas of one long turn
need meet in one task; only a conversation's final messages do, as its string must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.tables import table

TURNS, SEQS = 256, 64
OPEN, CLOSE = "<s>", "</s>"
#: What is escaped, and the digit that stands for it behind a backslash; the backslash itself first.
ESCAPES = (("\\", "0"), ("<", "1"), ("[", "2"), ("\n", "3"))
LOSS_ROLE = "assistant"


def escape(text: Column, line_ends: bool = False) -> Column:
    for c, digit in ESCAPES if line_ends else ESCAPES[:3]:
        text = F.replace(text, F.lit(c), F.lit("\\" + digit))
    return text


def unescape(text: Column) -> Column:
    for c, digit in reversed(ESCAPES):
        text = F.replace(text, F.lit("\\" + digit), F.lit(c))
    return text


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of whole messages (conv_id, turn, role, text) as the log of how they came about; null roles and texts are empty.

    By a hash, a message is streamed in deltas, or drafted and edited, or drafted
    and regenerated in deltas, so no final text stands in the log as it is.
    Messages of one turn follow one another by role and text.
    """
    said = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) - 1
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    text, n = F.col("text"), F.length("text")
    size = F.greatest(F.lit(16), F.ceil(n / 8)).cast("int")
    pieces = F.filter(F.transform(F.sequence(F.lit(0), F.floor(n / size).cast("int")), lambda i: event("delta", F.substring(text, i * size + 1, size))), lambda e: e["text"] != "")
    draft = [event("message", F.reverse("text")), event("delta", F.lit("?"))]
    half = F.floor(n / 2).cast("int")
    edited = F.array(*draft, event("edit", F.substring(text, F.lit(1), half)), event("delta", F.substring(text, half + 1, n)))
    way = F.pmod(F.xxhash64("role", "text"), F.lit(3))
    events = F.when(way == 0, F.concat(F.array(event("message", F.lit(""))), pieces)).when(way == 1, edited).otherwise(F.concat(F.array(*draft, event("regenerate", F.lit(""))), pieces))
    each = said.withColumn("place", place).select("conv_id", "turn", "role", "place", F.posexplode(events).alias("at", "e"))
    return each.select("conv_id", "turn", (F.col("place") * SEQS + F.col("at")).cast("long").alias("seq"), "e.kind", "role", "e.text")


def _fold(events: Column) -> Column:
    """Sorted events (turn, kind, role, text) as fewer, in time that grows with the events alone.

    A message starts with an event that says so, or that comes first of its
    turn. Of its events the last that isn't a delta replaces all before it, and
    the deltas behind it are appended. Where the first doesn't say so, what is
    left is an edit or delta for a message that may have started elsewhere.
    """
    at = F.sequence(F.lit(0), F.size(events) - 1)

    def opens(i: Column) -> Column:
        e, before = F.get(events, i), F.get(events, i - 1)
        return (i == 0) | e["kind"].eqNullSafe(F.lit("message")) | ~e["turn"].eqNullSafe(before["turn"])

    starts = F.filter(at, opens)
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(events)))

    def message(start: Column, end: Column) -> Column:
        own = F.slice(events, start + 1, end - start)
        last = F.coalesce(F.array_max(F.transform(own, lambda e, i: F.when(~e["kind"].eqNullSafe(F.lit("delta")), i))), F.lit(-1))
        said = F.transform(F.slice(own, F.greatest(last, F.lit(0)) + 1, F.size(own)), lambda e: e["text"])
        first = F.get(events, start)
        kind = F.when(first["kind"].eqNullSafe(F.lit("message")), "message").when(last >= 0, "edit").otherwise("delta")
        return F.struct(first["turn"].alias("turn"), kind.alias("kind"), first["role"].alias("role"), F.array_join(said, "").alias("text"))

    return F.zip_with(starts, ends, message)


def format_log(events: DataFrame) -> DataFrame:
    """Rows (conv_id, formatted, mask) from events (conv_id, turn, seq, kind, role, text).

    Events sort by turn, seq, then kind, role and text, so ties have one order
    and repeated rows are repeated turns. Nulls sort first; a null text is
    empty; a change before any message of its turn opens one. Texts of any
    length count whole, and no events give no rows. ``mask`` is an array of
    (skip, loss), one a turn. Extra columns are ignored.
    """
    clean = events.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("seq").cast("long").alias("seq"), "kind",
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")),
    ).withColumn("later", F.floor(F.col("seq") / SEQS))
    early = F.col("later").eqNullSafe(F.lit(0))
    clean = clean.withColumn("block", F.struct(early.alias("early"), F.when(early, F.floor(F.col("turn") / TURNS)).otherwise(F.col("turn")).alias("turns"), "later"))
    blocks = clean.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "seq", "kind", "role", "text"))).alias("events"))
    parts = F.transform(_fold(F.col("events")), lambda e, i: F.struct(e["turn"].alias("turn"), F.col("block.later").alias("later"), i.alias("at"), *(e[c].alias(c) for c in ("kind", "role", "text"))))
    joined = blocks.select("conv_id", parts.alias("parts")).groupBy("conv_id").agg(F.array_sort(F.flatten(F.collect_list("parts"))).alias("parts"))
    messages = joined.select("conv_id", _fold(F.col("parts")).alias("m"))
    head = lambda x: F.concat(F.lit(OPEN), escape(x["role"], True), F.lit("\n"))
    return messages.select(
        "conv_id",
        F.array_join(F.transform("m", lambda x: F.concat(head(x), escape(x["text"]), F.lit(CLOSE))), "").alias("formatted"),
        F.transform("m", lambda x: F.struct(F.length(head(x)).alias("skip"), F.when(x["role"] == LOSS_ROLE, F.length(escape(x["text"]))).otherwise(0).alias("loss"))).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted strings and masks say: (conv_id, turns, loss, formatted).

    ``turns`` is an array of (role, text), ``loss`` one of the texts under the mask, both unescaped.
    """
    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda p: p != "")
    cut = formatted.select("conv_id", "formatted", "mask", pieces.alias("pieces"))
    body = lambda p: F.substring(p, len(OPEN) + 1, F.length(p))

    def turn(p: Column) -> Column:
        at = F.instr(body(p), "\n")
        return F.struct(unescape(F.substring(body(p), F.lit(1), at - 1)).alias("role"), unescape(F.substring(body(p), at + 1, F.length(p))).alias("text"))

    masked = F.filter(F.arrays_zip(F.col("pieces").alias("p"), F.col("mask").alias("k")), lambda x: x["k"]["loss"] > 0)
    return cut.select(
        "conv_id", F.transform("pieces", turn).alias("turns"),
        F.transform(masked, lambda x: unescape(F.substring(x["p"], x["k"]["skip"] + 1, x["k"]["loss"]))).alias("loss"),
        "formatted",
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    check = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(check).alias("text"),
    )
    back = read_back(format_log(events_of(talk.unionByName(own))))
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: formatted_chars counts what the template and its escapes add.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + 8
    + len(regexp_extract_all(text, '[\\<\[]')) + len(regexp_extract_all(role, '[\\<\[\n]')) AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
