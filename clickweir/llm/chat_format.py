"""Chat formatting of messages made of typed parts, in DataFrame operations only.

A message is an array of parts: text, or an image, an audio clip or a document that is kept elsewhere. A visitor of the
parts writes texts, escaped, and numbered placeholders in their order; for every attachment it records where it is kept and
how many tokens it expands to. A turn is an opening mark, its body and a closing mark; a conversation is its turns in a row.
The loss mask has one span per turn, from the turn's first character: the body of an assistant turn, and nothing of others.

Every control string starts with `<` or `[` and has no other such character. In a text, a control string gets a backslash
after its first character, and one that has backslashes there already gets one more; reading takes one away. So no
control string is left in an escaped text, whatever stands before or behind it, and every text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template: fixed values.
BEGIN, END = "<s>", "</s>"
OPENS = {"system": "[SYS]", "user": "[INST]", "assistant": "[/INST]"}
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"            # around the name of any other role
LOSS_ROLE = "assistant"
ATTACHMENTS = ("image", "audio", "document")    # placeholders are <image:0>, <audio:1>, ... numbered within the turn
# the rest of each control string, behind its first character
_REST = r"(/?s>|SYS\]|/?INST\]|/?ROLE\]|(?:image|audio|document):\d+>)"
_PLACEHOLDER = r"<(?:image|audio|document):\d+>"
_BEHIND = r"(?<=<(?:image|audio|document):\d{1,9}>)"      # a look-behind needs a bounded length

# Tokens that attachments expand to: patches of an image, frames of a clip, a fixed number for each page.
PATCH, FRAMES_PER_SECOND, PAGE_TOKENS = 14, 25, 512
WORD_PIECE = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]"    # what counts as a token of a text

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, r"$1$2$3")


def text_parts(text: Column) -> Column:
    """A message of one text; null is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
                            *[F.lit(None).cast(t).alias(c) for c, t in (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part takes in a sequence; sizes that are unknown count as one patch, second or page."""
    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(1)) / F.lit(PATCH))
    return (F.when(part["kind"] == "image", patches("width") * patches("height"))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * FRAMES_PER_SECOND))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
            .otherwise(F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(WORD_PIECE)))).cast("bigint")


def visited(parts: Column) -> dict[str, Column]:
    """`body`, `attachments` and `tokens` of a message's parts. A null part, and one of a kind that is none of the four, counts
    as a text; a null text as an empty one."""
    def is_attachment(p: Column) -> Column:
        return F.coalesce(p["kind"].isin(*ATTACHMENTS), F.lit(False))
    held = F.filter(F.transform(parts, lambda p, i: F.struct(i.alias("place"), p.alias("part"))), lambda x: is_attachment(x["part"]))
    numbered = F.transform(held, lambda x, n: F.struct(
        n.cast("int").alias("number"), x["place"].cast("int").alias("place"), x["part"]["kind"].alias("kind"), x["part"]["ref"].alias("ref"),
        expanded_tokens(x["part"]).alias("tokens")))
    numbers = F.map_from_entries(F.transform(numbered, lambda a: F.struct(a["place"], a["number"])))
    shown = F.transform(parts, lambda p, i: F.when(
        is_attachment(p), F.concat(F.lit("<"), p["kind"], F.lit(":"), F.element_at(numbers, i).cast("string"), F.lit(">")))
        .otherwise(escaped(F.coalesce(p["text"], F.lit("")))))
    tokens = F.aggregate(F.transform(parts, expanded_tokens), F.lit(0).cast("bigint"), lambda a, t: a + t)
    return {"body": F.array_join(shown, ""), "attachments": numbered, "tokens": tokens}


def format_turns(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts") -> DataFrame:
    """conv_id, turn, formatted, loss_start, loss_length, attachments, tokens: one row per message, nothing is shuffled.

    `parts` is an array of `PART`; `text_parts` makes one of a text. Null or empty parts make an empty body; a null
    role is an empty one. Other columns are not read.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    opens = F.concat(F.lit(ROLE), escaped(role), F.lit(ROLE_END))
    for name, mark in OPENS.items():
        opens = F.when(role == name, F.lit(mark)).otherwise(opens)
    empty = F.from_json(F.lit("[]"), f"array<{PART}>")
    got = visited(F.coalesce(F.col("_parts"), empty))
    return (messages.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), opens.alias("opens"), (role == LOSS_ROLE).alias("learned"),
                            F.col(parts_col).alias("_parts"))
            .select("conv_id", "turn", "opens", "learned", *[c.alias(n) for n, c in got.items()])
            .select("conv_id", "turn", F.concat("opens", "body", F.lit(END)).alias("formatted"),
                    F.length("opens").alias("loss_start"),
                    F.when(F.col("learned"), F.length("body")).otherwise(F.lit(0)).alias("loss_length"), "attachments", "tokens"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss, attachments, n_turns, tokens: one row per conversation of `format_turns`.

    Turns stand in their order, null first; equal ones in the order of what is written. `loss` has one span
    (start, length) per turn, from the turn's first character; `attachments` one array per turn. A conversation is one
    value, so it has to fit in one; its turns come from all tasks already formatted.
    """
    turn = F.struct("turn", "formatted", F.struct(F.col("loss_start").alias("start"), F.col("loss_length").alias("length")).alias("loss"),
                    "attachments", "tokens")
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return ordered.select(
        "conv_id", F.concat(F.lit(BEGIN), F.array_join("t.formatted", "")).alias("formatted"), F.col("t.loss").alias("loss"),
        F.col("t.attachments").alias("attachments"), F.size("t").cast("bigint").alias("n_turns"),
        F.aggregate("t.tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text with its placeholders, tokens of the body, loss), found in the formatted text by its marks alone,
    the loss by the mask. `tokens` are the texts, unescaped, and the placeholders in their order."""
    def turn(piece: Column, loss: Column) -> Column:
        named = piece.startswith(ROLE)
        role = F.when(named, unescaped(F.substring_index(F.substr(piece, F.lit(len(ROLE) + 1)), ROLE_END, 1)))
        # an escaped name holds no mark, so the first closing one is its own
        start = F.when(named, F.locate(ROLE_END, piece) + len(ROLE_END))
        for name, mark in OPENS.items():
            role = F.when(piece.startswith(mark), F.lit(name)).otherwise(role)
            start = F.when(piece.startswith(mark), F.lit(len(mark) + 1)).otherwise(start)
        body = F.substr(piece, start)
        cut = F.filter(F.split(body, f"(?={_PLACEHOLDER})|{_BEHIND}"), lambda x: x != "")
        shown = F.transform(cut, lambda x: F.when(x.rlike(rf"\A{_PLACEHOLDER}\z"), x).otherwise(unescaped(x)))
        return F.struct(role.alias("role"), F.array_join(shown, "").alias("text"), shown.alias("tokens"),
                        unescaped(F.substr(piece, loss["start"] + 1, loss["length"])).alias("loss"))

    pieces = F.split(F.substr(F.col("formatted"), F.lit(len(BEGIN) + 1)), END)
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)       # nothing stands behind the last closing mark
    return formatted.select("conv_id", F.zip_with(whole, "loss", turn).alias("turns"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of conversations read back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), lines.alias("lines"),
                        F.array_join("turns.loss", "").alias("loss"), "formatted_chars")
            .select("conv_id", "n_turns", F.sha2(F.col("lines").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    "formatted_chars"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The turns of `conversations`, and a conversation -1 whose texts hold marks of the template."""
    probe = conversations.sparkSession.range(0, 2, 1, 1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"),
                                F.col("text").cast("string")).unionAll(probe)
