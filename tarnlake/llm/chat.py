"""Chat formatting in budgeted windows, with a template that can be read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import WORD, named

# Fixed marks of the template. A turn is OPEN role \n text CLOSE, the role in URL encoding.
MARKS = {"assistant": ("<s>", "</s>"), "other": ("[INST]", "[/INST]")}
# A mark, but for its last character, any number of backslashes, and that last character.
BROKEN = r"(</?s|\[/?INST)(\\*)([>\]])"
ESCAPED = r"(</?s|\[/?INST)\\(\\*)([>\]])"
TURN = r"(?s)(?:\[INST\]|<s>)[^\n]*\n.*?(?:\[/INST\]|</s>)"
PARTS = r"(?s)^(?:\[INST\]|<s>)([^\n]*)\n(.*)(?:\[/INST\]|</s>)$"


def escape(text: Column) -> Column:
    """Put one more backslash before the last character of anything that reads like a mark."""
    return F.regexp_replace(text, BROKEN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def format_windows(
    turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", budget: int = 1024, history: int = 256,
) -> DataFrame:
    """Training examples of at most ``budget`` tokens, cut between turns.

    Tokens of a turn are its words and two for its marks. Prefix sums of them are cut into tiles of
    ``budget - history - system`` tokens; the turns inside a tile make a span, and a turn across a border
    joins the span behind it if both fit, or else is a span of its own. A window is the conversation's system
    turn, the turns before the span that fit into ``history`` tokens, and the span. A turn that alone is
    longer than the room is not cut; its window is longer than the budget.

    One row a window: the conversation, ``window`` (from 0), ``formatted``, ``loss`` (start, from 0, and
    length in characters of each masked-in text: the assistant texts of the span, none of the repeated ones),
    ``repeated`` (how many of the first turns are repeats), ``turns`` and ``tokens``.

    - A null text or role is an empty one. Null turn numbers come first; rows with the same turn number are
      ordered by role and text, and repeated rows are turns of their own.
    - The system turn is a first turn of that role with others behind it. System turns further on, or
      alone, are ordinary turns.
    - Rows with a null conversation are one conversation. Columns other than these four are left out.
    - No row of a window function needs more than its frame: a long conversation is sorted and passed
      through, and only the turns of one window are ever gathered.
    """
    by = Window.partitionBy("conv")
    ordered = by.orderBy("turn", "role", "text")
    marks = {part: F.when(F.col("role") == "assistant", MARKS["assistant"][i]).otherwise(MARKS["other"][i])
             for i, part in enumerate(("open", "close"))}
    rows = turns.select(
        named(conversation).alias("conv"), named(turn).cast("long").alias("turn"),
        F.coalesce(named(role), F.lit("")).alias("role"), F.coalesce(named(text), F.lit("")).alias("text"))
    rows = rows.select(
        "conv", "turn", "role", "text",
        F.concat(marks["open"], F.url_encode("role"), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"), marks["close"].alias("tail"),
        (F.regexp_count("text", F.lit(WORD)) + 2).cast("long").alias("tokens"))
    rows = rows.withColumn("at", F.row_number().over(ordered)).withColumn(
        "is_system", (F.col("at") == 1) & (F.col("role") == "system") & (F.count(F.lit(1)).over(by) > 1))
    of_system = {n: F.max(F.when(F.col("is_system"), c)).over(by) for n, c in {
        "system": F.concat("head", "body", "tail"), "system_tokens": F.col("tokens")}.items()}
    rows = rows.withColumns(of_system).withColumn(
        "room", F.greatest(F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)), F.lit(1)))
    rows = rows.where(~F.col("is_system")).withColumn(
        "ends", F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("begins", F.col("ends") - F.col("tokens")).withColumn(
        "tile", F.expr("(ends - 1) div room"))
    tile = Window.partitionBy("conv", "tile")
    alone = (F.expr("begins div room") != F.col("tile")) & (F.sum("tokens").over(tile) > F.col("room"))
    rows = rows.withColumn("part", F.when(alone, 0).otherwise(1))
    rows = rows.withColumn("span", F.min("begins").over(Window.partitionBy("conv", "tile", "part")))
    near = by.orderBy("begins").rangeBetween(0, history)
    spans = F.collect_list(F.when(F.col("span") == F.col("begins"), F.col("span"))).over(near)
    rows = rows.withColumn("later", F.filter(
        spans, lambda s: (s >= F.col("ends")) & (s - F.col("begins") <= F.lit(history))))
    placed = rows.withColumn("own", F.col("span")).withColumn(
        "span", F.explode(F.concat(F.array("own"), "later"))).withColumn("new", F.col("span") == F.col("own"))
    inside = Window.partitionBy("conv", "span").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + F.char_length("tail")
    placed = placed.withColumn(
        "offset", F.coalesce(F.sum(size).over(inside), F.lit(0)) + F.coalesce(F.char_length("system"), F.lit(0)))
    learnt = F.when(F.col("new") & (F.col("role") == "assistant"), F.struct(
        (F.col("offset") + F.char_length("head")).cast("int").alias("start"),
        F.char_length("body").alias("length")))
    windows = placed.groupBy("conv", "span").agg(
        F.max(F.when(F.col("new"), F.col("system"))).alias("system"),
        F.sort_array(F.collect_list(F.struct("at", F.concat("head", "body", "tail").alias("piece")))).alias("pieces"),
        F.sort_array(F.collect_list(learnt)).alias("loss"),
        F.sum(F.when(F.col("new"), 0).otherwise(1)).cast("int").alias("before"),
        F.sum("tokens").alias("tokens"), F.max("system_tokens").alias("system_tokens"))
    has_system = F.col("system").isNotNull().cast("int")
    windows = windows.withColumn(
        "window", F.row_number().over(Window.partitionBy("conv").orderBy("span")) - 1)
    return windows.select(
        F.col("conv").alias(conversation), "window",
        F.concat(F.coalesce("system", F.lit("")), F.array_join("pieces.piece", "")).alias("formatted"), "loss",
        (F.col("before") + F.when(F.col("window") > 0, has_system).otherwise(0)).alias("repeated"),
        (F.size("pieces") + has_system).alias("turns"),
        (F.col("tokens") + F.coalesce("system_tokens", F.lit(0))).alias("tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """Parse windows again: ``new_turns`` (role and text of the turns that are no repeats) and ``loss_text``
    (the unescaped text under the loss mask)."""
    found = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0))
    return windows.withColumns({
        "new_turns": F.transform(
            F.slice(found, F.col("repeated") + 1, F.greatest(F.size(found) - F.col("repeated"), F.lit(0))),
            lambda t: F.struct(F.url_decode(F.regexp_extract(t, PARTS, 1)).alias("role"),
                               unescape(F.regexp_extract(t, PARTS, 2)).alias("text"))),
        "loss_text": F.array_join(F.transform(
            "loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")})
