"""Chat formatting (operator 8): turn-aligned windows under a token budget, natively.

A turn is written as `<|im_start|>` role, line feed, text, `<|im_end|>`, line feed. Inside roles
and texts `&` becomes `&amp;` and `<|` becomes `&lt;|` (in roles also line feed `&#10;`), so no
control string can arise from a text and every text is read back exactly.

A turn costs the tokens of all that is written for it, markers, role and escapes included: by
default its characters / 4, rounded up; or a column of token counts of the texts, to which markers
and role are added. Prefix sums of the costs place the turns. What the budget leaves beside the
system turn and `history` is shared: a turn of over half of that is a window of its own; other turns
go by their end into slots as wide as what is left less the largest of these turns, counted from the
last turn that has its own window. So a window never exceeds the budget, unless the system turn and one
turn alone do. A leading system turn opens every window; the last turns of the window before are
repeated if they begin within `history` tokens of the window's start and fit the budget. Repeated
turns come first, are counted in `n_repeated` and masked: only the texts of new assistant turns are
in `loss` (character ranges of the window's text), each exactly once over all windows.

No step needs a conversation in one task: turns are dealt by range of (conversation, turn, role,
text), each range's part of a conversation (a cell) is summed apart, and the cells' sums, one row
a cell, are prefix-summed for the places where cells begin. Windows are groups no larger than a
budget, and a system turn is joined to its windows cell by cell. Only `digest`, whose hash is of a
whole conversation by definition, gathers one.

Edge cases: null text and role are empty; turns are ordered by turn (null
first), role and text; repeated rows are turns each; a null conv_id is a conversation of its
own; a conversation of only a system turn gives one window; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def written(role: Column, text: Column) -> Column:
    """A turn as it stands in a window."""
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), escape(text), F.lit(END + "\n"))


def token_cost(whole: Column) -> Column:
    return F.ceil(F.char_length(whole) / F.lit(4)).cast("long")


CELL = ["#conv", "#absent", "cell"]


def _cells(turns: DataFrame, cost, tokens: str | None) -> DataFrame:
    """Turns with their cell, a number `at` in the order of turns, and their cost; written once.

    Ranges are cut at beginnings of texts, so what the driver samples stays small; turns alike
    to there share a cell. Cells must not move between the passes over them, so they are written.
    """
    counted = F.col(tokens).cast("long") if tokens else F.lit(None).cast("long")
    t = turns.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("#conv"), F.col("conv_id").isNull().alias("#absent"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), counted.alias("#tokens"))
    begins = F.when(F.char_length("role") <= 64, F.substring("text", 1, 64))
    dealt = t.repartitionByRange("conv_id", F.asc_nulls_first("turn"), F.substring("role", 1, 64), F.asc_nulls_last(begins)).withColumn("cell", F.spark_partition_id())
    ordered = dealt.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").withColumn("at", F.monotonically_increasing_id())
    full = F.coalesce(F.col("#tokens") + cost(written(F.col("role"), F.lit(""))), cost(written(F.col("role"), F.col("text"))))
    return cut(ordered.withColumn("full", full).drop("turn", "#tokens"))


def _placed(lean: DataFrame, cells: DataFrame) -> DataFrame:
    """lean with pos, leads, cost, end, and big; cells: a row a cell, of what comes before it and what holds for its conversation."""
    t = lean.join(cells, CELL).withColumn("pos", F.col("no") + F.col("rows_before"))
    t = t.withColumn("leads", F.col("led") & (F.col("pos") == 1))
    t = t.withColumn("cost", F.when(F.col("leads"), F.lit(0).cast("long")).otherwise(F.col("full")))
    t = t.withColumn("end", F.col("size_before") + F.col("upto") - F.col("room"))
    return t.withColumn("big", ~F.col("leads") & (F.col("cost") * 2 > F.col("avail")))


def _opening(lean: DataFrame, cells: DataFrame) -> DataFrame:
    """_placed, with whether a turn opens a window."""
    earlier = Window.partitionBy(*CELL).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    t = _placed(lean, cells)
    t = t.withColumn("base", F.greatest(F.coalesce(F.max(F.when(F.col("big"), F.col("end"))).over(earlier), F.lit(0)), F.col("base_before")))

    def slot(upto: Column) -> Column:
        return F.floor((F.greatest(upto - F.col("base"), F.lit(1)) - 1) / F.col("wide"))

    begin = F.col("end") - F.col("cost")
    opens = ~F.col("leads") & (F.col("big") | (begin == F.col("base")) | (slot(F.col("end")) != slot(begin)))
    return t.withColumn("opens", opens.cast("int"))


def windows(turns: DataFrame, budget: int = 1_024, history: int = 128, cost=token_cost, tokens: str | None = None) -> DataFrame:
    """conv_id, window, text, n_turns, n_repeated, loss of each window.

    cost: tokens of a piece of written text; tokens: name of a column of the texts' token counts,
    as stand-in for the cost of their text where not null.
    """
    t = _cells(turns, cost, tokens)
    # places are planned without texts
    own = Window.partitionBy(*CELL).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lean = cut(t.select(*CELL, "at", "full", (F.col("role") == "system").alias("system")).withColumn("no", F.row_number().over(own)).withColumn("upto", F.sum("full").over(own)))
    conv = Window.partitionBy("#conv", "#absent")
    before = conv.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    upto = conv.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    leading = [F.max(F.when(F.col("no") == 1, F.col(c))).alias(c) for c in ("system", "full")]
    sums = lean.groupBy(*CELL).agg(F.count("*").alias("n"), F.sum("full").alias("size"), *leading)
    led = F.first("system").over(upto)
    begins = sums.select(
        *CELL,
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("size_before"),
        led.alias("led"),
        F.when(led, F.first("full").over(upto)).otherwise(0).alias("room"),
    )
    begins = cut(begins.withColumn("avail", F.greatest(F.lit(budget - history) - F.col("room"), F.lit(1))))
    known = ["rows_before", "size_before", "led", "room", "avail"]
    shapes = _placed(lean, begins).groupBy(*CELL, *known).agg(F.max(F.when(~F.col("big"), F.col("cost"))).alias("small"), F.max(F.when(F.col("big"), F.col("end"))).alias("base"))
    shapes = shapes.withColumn("wide", F.greatest(F.col("avail") - F.coalesce(F.max("small").over(conv), F.lit(0)), F.lit(1)))
    shapes = cut(shapes.withColumn("base_before", F.coalesce(F.max("base").over(before), F.lit(0))).drop("small", "base"))
    opened = _opening(lean, shapes).groupBy(*CELL, *known, "wide", "base_before").agg(F.sum("opens").alias("opened"))
    whole = cut(opened.withColumn("opened_before", F.coalesce(F.sum("opened").over(before), F.lit(0))).withColumn("last", F.greatest(F.sum("opened").over(conv), F.lit(1)) - 1))
    plan = _opening(lean, whole).withColumn("window", F.col("opened_before") + F.sum("opens").over(own) - 1)
    turn_of = ["conv_id", "pos", "role", "text", "cost"]
    # a cell repeats the system turn for the windows it opens; of no others, there is window 0
    opening = whole.where("led and (opened > 0 or (last = 0 and rows_before = 0))").select(*CELL, F.col("opened_before").alias("low"), F.greatest(F.col("opened_before") + F.col("opened") - 1, F.col("opened_before")).alias("high"))
    heads = t.where("role = 'system'").join(plan.where("leads").select("at", "pos", F.col("full").alias("cost")), "at").select("#conv", "#absent", *turn_of)
    everywhere = opening.join(heads, ["#conv", "#absent"]).repartition(*CELL).select(*turn_of, F.explode(F.sequence("low", "high")).alias("window")).withColumn("new", F.col("window") == 0).withColumn("again", F.lit(False))
    plan = plan.where("not leads").withColumn("next_start", F.max("end").over(Window.partitionBy("#conv", "#absent", "window")))
    again = (F.col("window") < F.col("last")) & (F.col("next_start") - F.col("end") + F.col("cost") <= history)
    body = t.select("at", "conv_id", "role", "text").join(plan.select("at", "pos", "cost", F.col("window").alias("first"), again.alias("repeated")), "at")
    place = lambda w, new: F.struct(w.alias("window"), F.lit(new).alias("new"), F.lit(not new).alias("again"))
    once, repeated = place(F.col("first"), True), place(F.col("first") + 1, False)
    body = body.select(*turn_of, F.explode(F.when(F.col("repeated"), F.array(once, repeated)).otherwise(F.array(once))).alias("place"))
    placed = body.select(*turn_of, "place.window", "place.new", "place.again").unionByName(everywhere)
    within = Window.partitionBy("conv_id", "window")
    # nothing is repeated before a turn too long for it
    placed = placed.withColumn("crowded", F.sum("cost").over(within) > budget).where("not (again and crowded)")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    placed = placed.select("conv_id", F.col("window").cast("int").alias("window"), "new", "pos", "role", escape(F.col("text")).alias("body"), head.alias("head")).withColumn("whole", F.concat("head", "body", F.lit(END + "\n")))
    before = within.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.sum(F.char_length("whole")).over(before), F.lit(0)) + F.char_length("head"))
    part = F.struct("pos", "whole", "new", (F.col("new") & (F.col("role") == "assistant")).alias("learnt"), F.col("at").alias("start"), (F.col("at") + F.char_length("body")).alias("end"))
    grouped = placed.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("parts", lambda p: p["whole"]), "").alias("text"),
        F.size("parts").alias("n_turns"),
        F.size(F.filter("parts", lambda p: ~p["new"])).alias("n_repeated"),
        F.transform(F.filter("parts", lambda p: p["learnt"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of its new turns), loss_text: all from the written text."""
    parts = F.split("text", r"<\|im_start\|>")
    new = F.slice(parts, F.col("n_repeated") + 2, F.greatest(F.size(parts) - 1 - F.col("n_repeated"), F.lit(0)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(p, F.char_length(role) + 2, F.char_length(p) - F.char_length(role) - 2 - len(END))).alias("text"))

    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")
    return formatted.select("conv_id", "window", F.transform(new, turn).alias("turns"), loss.alias("loss_text"), F.char_length("text").cast("long").alias("chars"))


def digest(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from its windows."""
    back = read_back(formatted).withColumn("said", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
    each = back.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "said", "loss_text"))).alias("w"), F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    said, loss = F.array_join(F.col("w.said"), ""), F.array_join(F.col("w.loss_text"), "")
    return each.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
