"""Chat formatting: fold an event log into final messages and render each conversation with its loss mask.

DataFrame functions only. An event has conv_id, seq, kind, turn, part, role and text. By `seq`, for the message (turn, part):
  message     starts it over with this role and text
  delta       appends text, as streamed
  edit        replaces the text
  regenerate  empties the text for a new answer, and drops what was logged before for later turns
`part` orders messages that share a turn. Work goes in three steps: events meet by message, messages by a block of turns,
blocks by conversation, so that the last step joins few long strings however many events a conversation has. A rendered
conversation is one value, so its size is what one row can hold.

Nulls: text and role count as empty, seq as the earliest, turn as later than all others; conv_id null is a conversation.
Events of one message with equal seq go by kind and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Fixed values of the template.
TURN_START, TURN_END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
EVENTS = ("conv_id", "seq", "kind", "turn", "part", "role", "text")
#: Turns to a block.
BLOCK = 256
LAST_TURN, FIRST_SEQ = (1 << 63) - 1, -(1 << 63)


def escaped(text: Column) -> Column:
    """One backslash more in every `<`, backslashes, `|`; no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log behind finished turns (conv_id, turn, role, text): a user's turn is one message; an assistant's is a discarded draft, a regeneration and two deltas.

    Rows that share conversation and turn are messages of their own, by role and text.
    """
    turn = F.coalesce(F.col("turn"), F.lit(LAST_TURN))
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("part", F.row_number().over(order).cast("long"))
    half = (F.char_length("text") / 2).cast("int")
    event = lambda k, kind, said: F.struct(F.lit(k).alias("step"), F.lit(kind).alias("kind"), said.alias("said"))
    head, tail = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))
    streamed = F.array(event(0, "message", head), event(1, "regenerate", F.lit("")), event(2, "delta", head), event(3, "delta", tail))
    whole = F.array(event(0, "message", F.col("text")))
    events = rows.withColumn("event", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(whole)))
    # a conversation's events are logged turn by turn, and those of one turn part by part
    seq = F.struct("turn", "part", "event.step")
    return events.select("conv_id", seq.alias("seq"), "event.kind", "turn", "part", "role", F.col("event.said").alias("text"))


def folded(events: DataFrame) -> DataFrame:
    """Blocks of final messages: conv_id, block, messages (turn, part, role, text; in order).

    `seq` may be any orderable type.
    """
    seq_type = events.schema["seq"].dataType
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN))
    seq = F.coalesce("seq", F.lit(FIRST_SEQ).cast(seq_type)) if seq_type.typeName() == "long" else F.col("seq")
    rows = events.select("conv_id", seq.alias("seq"), "kind", turn.alias("turn"), "part", "role", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    resets = F.col("kind").isin("message", "edit", "regenerate")
    said = rows.groupBy("conv_id", "turn", "part").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.min("seq").alias("first"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.sort_array(F.collect_list(F.struct("seq", "kind", "text"))).alias("events"),
    )
    since = F.filter("events", lambda e: F.coalesce(e["seq"] >= F.col("reset"), F.lit(True)))
    text = F.array_join(F.transform(since, lambda e: e["text"]), "")
    said = said.select("conv_id", "turn", "part", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), F.coalesce("reset", "first").alias("began"), "again")
    said = said.withColumn("block", F.floor(F.col("turn") / F.lit(BLOCK)).cast("long"))
    earlier = Window.partitionBy("conv_id", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    said = said.withColumn("dropped", F.max("again").over(earlier))
    blocks = said.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "part", "role", "text", "began", "dropped"))).alias("messages"), F.max("again").alias("again")
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("dropped", F.max("again").over(earlier))
    stays = lambda m: F.coalesce(m["began"] > m["dropped"], F.lit(True)) & F.coalesce(m["began"] > F.col("dropped"), F.lit(True))
    final = F.transform(F.filter("messages", stays), lambda m: F.struct(*(m[c].alias(c) for c in ("turn", "part", "role", "text"))))
    return blocks.select("conv_id", "block", final.alias("messages"))


def rendered(blocks: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """A row for each conversation that has messages: conv_id, formatted, turns.

    `turns` has, in order, start and end of each message's text in `formatted` (code points from 0, end exclusive) and
    whether the loss counts there.
    """

    def piece(m: Column) -> Column:
        head = F.concat(F.lit(TURN_START), F.replace(escaped(m["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
        body = escaped(m["text"])
        return F.struct(F.concat(head, body, F.lit(TURN_END)).alias("said"), F.char_length(head).alias("head"), F.char_length(body).alias("body"), (m["role"] == trained_role).alias("loss"))

    pieces = blocks.filter(F.size("messages") > 0).select("conv_id", "block", F.transform("messages", piece).alias("pieces"))

    def add(state: Column, p: Column) -> Column:
        start = state["at"] + p["head"]
        end = start + p["body"]
        span = F.struct(start.alias("start"), end.alias("end"), p["loss"].alias("loss"))
        return F.struct((end + F.lit(len(TURN_END))).alias("at"), F.concat(state["turns"], F.array(span)).alias("turns"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,loss:boolean>>")
    laid = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), none.alias("turns")), add)
    laid_out = pieces.select("conv_id", "block", F.array_join(F.transform("pieces", lambda p: p["said"]), "").alias("said"), laid.alias("laid"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("laid.at").over(earlier), F.lit(0).cast("long"))
    based = laid_out.withColumn("base", base)
    moved = F.transform("laid.turns", lambda t: F.struct((t["start"] + F.col("base")).alias("start"), (t["end"] + F.col("base")).alias("end"), t["loss"].alias("loss")))
    based = based.select("conv_id", F.struct("block", "said", moved.alias("turns")).alias("part"))
    whole = based.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select("conv_id", F.array_join("parts.said", "").alias("formatted"), F.flatten("parts.turns").alias("turns"))


def read_back(conversations: DataFrame) -> DataFrame:
    """What the rendered text says: conv_id, formatted, messages (role, text) and the texts under the loss mask."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    cut_up = conversations.select("conv_id", "formatted", "turns", F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))

    def message(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        role = F.substring(head, F.lit(len(TURN_START) + 1), F.char_length(head))
        text = F.substring(p, F.char_length(head) + 2, F.char_length(p))
        return F.struct(unescaped(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"), unescaped(text).alias("text"))

    def masked(p: Column, i: Column) -> Column:
        turn = F.element_at("turns", i + 1)
        piece_at = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at("turns", F.greatest(i, F.lit(1)))["end"] + len(TURN_END))
        said = F.substring(p, (turn["start"] - piece_at + 1).cast("int"), (turn["end"] - turn["start"]).cast("int"))
        return F.when(turn["loss"], unescaped(said)).otherwise("")

    return cut_up.select("conv_id", "formatted", F.transform("pieces", message).alias("messages"), F.array_join(F.transform("pieces", masked), "").alias("loss"))


def chat_report(turns: DataFrame) -> DataFrame:
    """Digest of the formatted conversations, read back from the rendered text."""
    back = read_back(rendered(folded(log_of_turns(turns))))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
