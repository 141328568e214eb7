"""Chat formatting into budgeted training windows, by DataFrame functions only.

Template.  A turn is ``### <role>:\\n<text></turn>\\n``.  Inside roles and texts the
escape character and the control strings are written as two-character codes
(``ESCAPES``), so a text can't open or close a turn, and ``unescape`` restores it.

Windows.  Prefix sums of the turns' tokens (matches of the public pre-tokeniser
pattern) place every turn on a line per conversation, which is cut into stretches of BUDGET
tokens, after the first one less those of HISTORY and of the system turn.  The turns that lie within one stretch are the
new turns of one window; a turn that lies across a stretch's end joins them if all still fit,
else it is a window of its own.  So windows are turn-aligned.  Each later window begins with
the conversation's system turn, if it opens with one, and with the last turns before it that fit
into ``HISTORY`` tokens.  These repeated turns are context: the loss mask covers each assistant
text once, in the window where it is new.  Context is repeated as far as the budget
has room for it, so a window has more than ``BUDGET`` tokens only if one turn has.

Prefix sums have two levels, blocks of turn numbers and sums of blocks, and
everything else is grouped by conversation and window, so a conversation of any
length is spread over tasks.

Defined results
---------------
* turns are ordered by turn (null first), then role and text; rows that repeat are
  turns of their own; null role and text are empty, a null conv_id is a conversation;
* an empty table gives no windows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window.
BUDGET = 1024
#: Tokens of earlier turns that a window may repeat (well below BUDGET).
HISTORY = 256
#: Turn numbers that share a block of prefix sums.
BLOCK_TURNS = 256

OPEN, CLOSE = "### ", "</turn>\n"
#: Control strings and their codes; the escape character comes first.
ESCAPES = (("\\", "\\s"), ("### ", "\\h"), ("</turn>", "\\t"), ("\n", "\\n"))

_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def escape(text: Column, in_role: bool = False) -> Column:
    for plain, code in ESCAPES[:4 if in_role else 3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _turns(conversations: DataFrame) -> DataFrame:
    """Formatted turns with ``start``, the tokens of the conversation before them."""
    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"),
                                F.coalesce("text", empty).alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), in_role=True), F.lit(":\n"))
    rows = rows.withColumns({"head": head, "body": escape(F.col("text"))})
    rows = rows.withColumn("formatted", F.concat("head", "body", F.lit(CLOSE)))
    rows = rows.withColumns({"tokens": F.regexp_count("formatted", F.lit(_TOKEN)).cast("long"),
                             "block": F.floor(F.col("turn") / BLOCK_TURNS)})
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    before = Window.unboundedPreceding
    rows = rows.withColumn("in_block", F.coalesce(F.sum("tokens").over(in_block.rowsBetween(before, -1)), F.lit(0)))
    over_blocks = Window.partitionBy("block_conv").orderBy("block_no")
    first = F.min(F.struct("turn", "role", "text", "tokens"))
    opening = F.first(F.struct("first.role", "first.tokens")).over(over_blocks.rowsBetween(before, 0))
    blocks = (rows.groupBy(F.col("conv_id").alias("block_conv"), F.col("block").alias("block_no"))
              .agg(F.sum("tokens").alias("block_tokens"), first.alias("first"))
              .select("block_conv", "block_no", opening.alias("opening"),
                      F.coalesce(F.sum("block_tokens").over(over_blocks.rowsBetween(before, -1)), F.lit(0)).alias("before_block")))
    rows = rows.join(blocks, rows["conv_id"].eqNullSafe(blocks["block_conv"])
                     & rows["block"].eqNullSafe(blocks["block_no"]))
    system = F.when(F.col("opening.role") == "system", F.col("opening.tokens")).otherwise(0)
    rows = rows.select("conv_id", "role", "tokens", "formatted", (F.col("before_block") + F.col("in_block")).alias("start"),
                       F.length("head").alias("head_chars"), F.length("body").alias("body_chars"), system.alias("system"))
    room = F.greatest(F.lit(BUDGET - HISTORY) - F.col("system"), F.lit(BUDGET // 4))
    # the first stretch has no context before it and takes the whole budget
    stretch, end = F.greatest(F.floor((F.col("start") - BUDGET) / room) + 1, F.lit(0)), F.col("start") + F.col("tokens")
    rows = rows.withColumns({"stretch": stretch, "across": end > BUDGET + stretch * room})
    begin = F.min(F.when(~F.col("across"), F.col("start"))).over(Window.partitionBy("conv_id", "stretch"))
    alone = F.col("across") & ~F.coalesce(end - begin <= F.when(F.col("stretch") == 0, BUDGET).otherwise(room), F.lit(False))
    return rows.select("conv_id", "role", "tokens", "formatted", "start", "head_chars", "body_chars", "system",
                       (2 * F.col("stretch") + alone.cast("int")).alias("window"),
                       ((F.col("start") == 0) & (F.col("role") == "system")).alias("opens"))


def format_windows(conversations: DataFrame) -> DataFrame:
    """Per window: conv_id, window, text, loss_spans (code points of new assistant texts,
    end exclusive), n_repeated (leading turns that are context only), n_turns, n_tokens."""
    turns = _turns(conversations)
    following = Window.partitionBy("w_conv").orderBy("w_no")
    # what the budget leaves for context, the system turn first
    spare = F.lit(BUDGET) - F.col("w_tokens")
    keeps_system = (F.col("w_system") > 0) & (F.col("w_system") <= spare)
    windows = (turns.groupBy(F.col("conv_id").alias("w_conv"), F.col("window").alias("w_no"))
               .agg(F.min("start").alias("w_start"), F.sum("tokens").alias("w_tokens"), F.first("system").alias("w_system"))
               .withColumn("w_keeps", keeps_system)
               .withColumn("w_history", F.least(F.lit(HISTORY), spare - F.when(F.col("w_keeps"), F.col("w_system")).otherwise(0)))
               .withColumns({f"next_{c}": F.lead(f"w_{c}").over(following) for c in ("no", "start", "history")}))
    placed = turns.join(windows, turns["conv_id"].eqNullSafe(windows["w_conv"]) & (F.col("window") == F.col("w_no")))
    repeats = ~F.col("opens") & (F.col("next_start") - F.col("start") <= F.col("next_history"))
    place = lambda no, new: F.struct(no.alias("window"), F.lit(new).alias("new"))
    columns = ["conv_id", "role", "tokens", "formatted", "start", "head_chars", "body_chars"]
    placed = placed.select(*columns, F.explode(F.when(
        repeats, F.array(place(F.col("window"), True), place(F.col("next_no"), False))).otherwise(
        F.array(place(F.col("window"), True)))).alias("p")).select(*columns, "p.*")
    later = windows.filter((F.col("w_start") > 0) & F.col("w_keeps"))
    openings = turns.filter("opens")
    openings = openings.join(later, openings["conv_id"].eqNullSafe(later["w_conv"])).select(
        *columns, F.col("w_no").alias("window"), F.lit(False).alias("new"))
    in_window = Window.partitionBy("conv_id", "window").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.unionByName(openings).withColumn(
        "at", F.coalesce(F.sum(F.length("formatted")).over(in_window), F.lit(0)) + F.col("head_chars"))
    target = F.when(F.col("new") & (F.col("role") == "assistant"),
                    F.struct(F.col("at").alias("begin"), (F.col("at") + F.col("body_chars")).alias("end")))
    return (rows.withColumn("target", target).groupBy("conv_id", "window")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "formatted"))),
                                          lambda x: x["formatted"]), "").alias("text"),
                 F.array_sort(F.collect_list("target")).alias("loss_spans"),
                 F.count_if(~F.col("new")).alias("n_repeated"),
                 F.count(F.lit(1)).alias("n_turns"), F.sum("tokens").alias("n_tokens")))


def read_back(windows: DataFrame) -> DataFrame:
    """Per window, parsed from its text alone: conv_id, window, turns (role and text of the
    new turns), targets (the texts under the loss mask)."""
    pieces = F.split("text", CLOSE)
    new = F.slice(pieces, (F.col("n_repeated") + 1).cast("int"), (F.size(pieces) - 1 - F.col("n_repeated")).cast("int"))
    middle = lambda p: F.instr(p, ":\n")
    turns = F.transform(new, lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(OPEN) + 1), middle(p) - F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, middle(p) + 2)).alias("text")))
    targets = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("text"), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
    return windows.select("conv_id", "window", turns.alias("turns"), targets.alias("targets"),
                          F.length("text").alias("formatted_chars"))
