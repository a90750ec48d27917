"""Chat formatting in budgeted windows, by built-in functions only.

A conversation's turns get prefix sums of their tokens, which cut it into
segments of a few windows; within a segment turns fill windows in order, a turn
whole or not at all.  Every window begins with the conversation's system turn,
then repeats as much of the turns before it as the history budget holds, then
brings new turns.  Only the text of new assistant turns is under the loss mask.

The template marks a turn as ``<turn role="ROLE">`` newline TEXT ``</turn>``
newline.  Inside texts and roles ``&``, ``<`` and ``"`` are written ``&amp;``,
``&lt;`` and ``&quot;``, so that no text can hold a mark, whatever it says.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatFormat:
    """Parameters.

    budget: tokens of a window; only a turn that is too long for it, alone with the system turn, exceeds it.
    history: most of them for repeated turns; less where a long turn leaves less.
    token_chars: characters that count as one token, of a turn with its marks.
    segment: windows of a segment, the most that is held together while windows are filled.
    """

    budget: int = 2048
    history: int = 512
    token_chars: int = 4
    segment: int = 8


END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&quot;"), F.lit('"')), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def windows(turns: DataFrame, p: ChatFormat = ChatFormat()) -> DataFrame:
    """(conv_id, window, text, n_tokens, n_turns, n_repeated, loss array<struct<start, length>>).

    turns(conv_id, turn, role, text) are ordered by turn, then role, then text;
    null roles and texts are empty.  window grows along a conversation.  The
    first n_repeated of a window's n_turns turns are the system turn and history.
    loss holds the spans, in characters of text, of the new assistant texts.
    The system turn is the first turn if its role is `system`.
    """
    given = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("raw"),
    )
    body = given.select(
        "*",
        F.concat(F.lit('<turn role="'), escaped(F.col("role")), F.lit('">\n')).alias("head"),
        escaped(F.col("raw")).alias("body"),
    )
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    numbered = body.select(
        "conv_id",
        "role",
        "head",
        "body",
        F.ceil((F.length("head") + F.length("body") + len(END)) / F.lit(p.token_chars)).cast("bigint").alias("tokens"),
        F.row_number().over(by).alias("seq"),
    )
    is_system = (F.col("seq") == 1) & (F.col("role") == "system")
    over = Window.partitionBy("conv_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    system = F.first(F.when(is_system, F.struct("head", "body", "tokens"))).over(over)
    spent = F.when(is_system, F.lit(0)).otherwise(F.col("tokens"))
    summed = numbered.select("*", (F.sum(spent).over(over) - spent).alias("begin"), system.alias("system"))
    stride = F.greatest(F.lit(1), F.lit(p.budget - p.history) - F.coalesce(F.col("system.tokens"), F.lit(0))).cast("bigint")
    span = F.col("stride") * p.segment
    cut = summed.withColumn("stride", stride).withColumn("own", F.floor(F.col("begin") / span))
    # a turn that the next segment's first window may repeat goes there too
    near = ((F.col("own") + 1) * span - F.col("begin")) <= p.history
    dealt = cut.withColumn(
        "segment", F.explode(F.when(near & (F.col("seq") > 1), F.array(F.col("own"), F.col("own") + 1)).otherwise(F.array("own")))
    )
    turn = F.struct("seq", "role", "head", "body", "tokens", "begin", (F.col("segment") == F.col("own")).alias("new"))
    segments = (
        dealt.groupBy("conv_id", "segment")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.first("stride").alias("stride"), F.first("system", ignorenulls=True).alias("system"))
        .filter(F.exists("turns", lambda t: t["new"]))
    )
    # where each window of a segment begins: a system turn takes no room of its own
    state = F.struct(F.lit(0).cast("bigint").alias("used"), F.array().cast("array<struct<seq:int,begin:bigint>>").alias("starts"))

    def step(s: Column, t: Column) -> Column:
        free = (t["seq"] == 1) & F.col("system").isNotNull()
        need = F.when(free, F.lit(0)).otherwise(t["tokens"])
        fits = (F.size(s["starts"]) > 0) & ((s["used"] + need <= F.col("stride")) | (s["used"] == 0))
        fresh = F.array(F.struct(t["seq"].alias("seq"), t["begin"].alias("begin")))
        return F.struct(
            F.when(fits, s["used"] + need).otherwise(need).cast("bigint").alias("used"),
            F.when(fits, s["starts"]).otherwise(F.concat(s["starts"], fresh)).alias("starts"),
        )

    starts = F.aggregate(F.filter("turns", lambda t: t["new"]), state, step, lambda s: s["starts"])
    opened = segments.withColumn("starts", starts).select("*", F.posexplode("starts").alias("no", "at"))
    following = F.coalesce(F.get("starts", F.col("no") + 1)["seq"], F.lit(2147483647))
    own_tokens = F.aggregate(
        F.filter("turns", lambda t: (t["seq"] >= F.col("at.seq")) & (t["seq"] < following)), F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"]
    )
    room = F.least(F.lit(p.history), F.lit(p.budget) - F.coalesce(F.col("system.tokens"), F.lit(0)) - own_tokens)
    opened = opened.withColumn("room", room)
    held = opened.select(
        "conv_id",
        "segment",
        "no",
        "system",
        F.col("at.seq").alias("first"),
        F.filter("turns", lambda t: (t["seq"] < following) & ((t["seq"] >= F.col("at.seq")) | (F.col("at.begin") - t["begin"] <= F.col("room")))).alias("held"),
    )
    # the system turn itself is new in the first window and repeated in the others
    plain = F.filter("held", lambda t: ~((t["seq"] == 1) & F.col("system").isNotNull()))
    lead = F.when(
        F.col("system").isNotNull(),
        F.array(F.struct(F.col("system.head").alias("head"), F.col("system.body").alias("body"), F.lit(False).alias("loss"), (F.col("first") > 1).alias("old"), F.col("system.tokens").alias("tokens"))),
    ).otherwise(F.array().cast("array<struct<head:string,body:string,loss:boolean,old:boolean,tokens:bigint>>"))
    parts = F.concat(
        lead,
        F.transform(
            plain,
            lambda t: F.struct(
                t["head"].alias("head"),
                t["body"].alias("body"),
                ((t["seq"] >= F.col("first")) & (t["role"] == "assistant")).alias("loss"),
                (t["seq"] < F.col("first")).alias("old"),
                t["tokens"].alias("tokens"),
            ),
        ),
    )
    composed = held.select("conv_id", "segment", "no", parts.alias("parts"))
    walk = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss"))

    def mark(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(t["head"])
        span = F.array(F.struct(begin.cast("bigint").alias("start"), F.length(t["body"]).cast("bigint").alias("length")))
        return F.struct(
            (begin + F.length(t["body"]) + len(END)).cast("bigint").alias("at"),
            F.when(t["loss"], F.concat(s["loss"], span)).otherwise(s["loss"]).alias("loss"),
        )

    return composed.select(
        "conv_id",
        (F.col("segment") * (1 << 20) + F.col("no")).alias("window"),
        F.array_join(F.transform("parts", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
        F.size("parts").alias("n_turns"),
        F.size(F.filter("parts", lambda t: t["old"])).alias("n_repeated"),
        F.aggregate("parts", walk, mark, lambda s: s["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the windows alone.

    Turns are parsed from the text, repeated ones left out; the text under the
    loss mask is cut out by its spans and unescaped.
    """
    marked = F.slice(F.split("text", "</turn>\n"), F.col("n_repeated") + 1, F.greatest(F.col("n_turns") - F.col("n_repeated"), F.lit(0)))
    parsed = formatted.select(
        "conv_id",
        "window",
        F.length("text").cast("bigint").alias("chars"),
        F.transform(
            marked,
            lambda x: F.concat(
                unescaped(F.regexp_extract(x, '(?s)^<turn role="([^"]*)">\n', 1)), F.lit("\n"), unescaped(F.regexp_extract(x, '(?s)^<turn role="[^"]*">\n(.*)$', 1)), F.lit("\n")
            ),
        ).alias("turns"),
        F.array_join(F.transform("loss", lambda x: unescaped(F.substr(F.col("text"), x["start"].cast("int") + 1, x["length"].cast("int")))), "").alias("target"),
    )
    piece = F.struct("window", F.array_join("turns", "").alias("said"), "target")
    whole = parsed.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("bigint").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    said = F.array_join(F.transform("pieces", lambda x: x["said"]), "")
    target = F.array_join(F.transform("pieces", lambda x: x["target"]), "")
    return whole.select("conv_id", "n_turns", said.alias("said"), target.alias("target"), "formatted_chars").select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("target").cast("bigint").alias("loss_chars"),
        F.sha2("target", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def formatted_conversations(turns: DataFrame, p: ChatFormat = ChatFormat()) -> DataFrame:
    """The windows of turns, read back, one row per conversation.

    An empty table gives an empty one; repeated rows are turns of their own; a
    null conv_id is a conversation; other columns are ignored.
    """
    return read_back(windows(turns, p))
