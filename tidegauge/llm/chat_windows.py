"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written as ``<turn ROLE>``, a line break, its text, a line break and ``</turn>`` with a
line break. The role is URL-encoded. In a text, ``<turn`` and ``</turn`` get a backslash after ``<``,
before any backslashes that stand there already, so that marks cannot be forged and the
text comes back exactly.

Prefix sums of turn tokens choose the windows: a turn whose preceding tokens lie in
the k-th span of ``step`` tokens belongs to window k, and a turn longer than that has a window of its
own, so cuts lie between turns and a window holds at most two steps. The step is half of what the
budget leaves beside the system turn. Every window begins with the conversation's system turn and then
repeats the turns just before it: up to ``history`` of them, as far back as the sum of their tokens fits into
what the window has left. Repeated turns are marked and masked, so each assistant text is a target
once. Tokens are words and marks, two for the turn's own. Only windows around one turn that is too long
by itself exceed the budget; they say so and repeat nothing but the system turn.

Prefix sums are taken in two steps, over blocks of ``BLOCK`` turn numbers and then over the blocks of a
conversation, so that a long conversation is dealt out to many tasks.

Defined cases: null texts and roles are empty; a null conversation id is a conversation; turns with
equal numbers follow each other by role and text, null numbers come first; repeated rows are turns
of their own; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import shared_dir

BUDGET = 512
HISTORY = 2
BLOCK = 64
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
CLOSE = "\n</turn>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", "<$1$2")


def opening(role: Column) -> Column:
    return F.concat(F.lit("<turn "), F.url_encode(role), F.lit(">\n"))


def numbered(conversations: DataFrame, columns: tuple[str, str, str, str]) -> DataFrame:
    """Turns with their place, and the tokens before them, in their conversation."""
    conv, turn, role, text = (F.col(c) for c in columns)
    rows = conversations.select(
        conv.alias("conv"),
        turn.alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(TOKEN)).cast("long") + 2)
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    sums = [F.count(F.lit(1)).alias("rows_before"), F.sum("n").alias("tokens_before")]
    blocks = rows.groupBy("conv", "block").agg(*sums)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        *(F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(x) for x in ("rows_before", "tokens_before")),
    )
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    rows = rows.withColumns(
        {
            "place": F.row_number().over(inside) - 1,
            "tokens": F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
        }
    )
    both = rows["conv"].eqNullSafe(blocks["c"]) & rows["block"].eqNullSafe(blocks["b"])
    rows = rows.join(blocks, both)
    return rows.select(
        "conv",
        (F.col("place") + F.col("rows_before")).alias("pos"),
        (F.col("tokens") + F.col("tokens_before")).alias("start"),
        "n",
        "role",
        "text",
    )


def chat_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
) -> DataFrame:
    """A row per window.

    ``first`` is the place of its first own turn, ``repeated`` how many turns before it are
    repeated, ``loss`` the code-point spans (start, length) of target texts in ``text``.
    """
    spark = conversations.sparkSession
    path = shared_dir(spark, "turns")
    numbered(conversations, columns).write.parquet(path)
    turns = spark.read.parquet(path)
    shown = F.concat(opening(F.col("role")), escaped(F.col("text")), F.lit(CLOSE)).alias("shown")
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    system = turns.where(is_system).select(F.col("conv").alias("sc"), F.col("n").alias("system_n"), shown)
    system = system.withColumnRenamed("shown", "system")
    cost = turns.join(system.select("sc", "system_n"), turns["conv"].eqNullSafe(system["sc"]), "left")
    cost = cost.withColumn("system_n", F.coalesce("system_n", F.lit(0)))
    free = F.lit(budget) - F.col("system_n")
    cost = cost.withColumn("step", F.greatest(F.floor(free / 2), F.lit(16)))
    own_system = is_system & (F.col("system_n") > 0)
    start = F.when(own_system, 0).otherwise(F.col("start") - F.col("system_n"))
    cost = cost.withColumn("large", ~own_system & (F.col("n") > F.col("step")))
    cost = cost.withColumn("span", F.floor(start / F.col("step")))
    # Turns after a large one begin in a later span than those before it, as it is longer than a step.
    own = F.struct("pos", "role", shown, F.length(escaped(F.col("text"))).alias("size"), F.col("n").alias("n"))
    windows = cost.groupBy("conv", "span", F.when(F.col("large"), F.col("pos")).alias("alone")).agg(
        F.array_sort(F.collect_list(own)).alias("own"), F.first("system_n").alias("system_n")
    )
    windows = windows.withColumn("first", F.col("own")[0]["pos"])
    windows = windows.join(system.drop("system_n"), windows["conv"].eqNullSafe(system["sc"]), "left").drop("sc")
    windows = windows.withColumn("system", F.when(F.col("first") > 0, F.col("system")))
    used = F.aggregate("own", F.lit(0).cast("long"), lambda sum_, t: sum_ + t["n"])
    windows = windows.withColumn("room", F.lit(budget) - F.col("system_n") - used)
    windows = with_history(windows, turns.where(~is_system), history)
    context = F.concat(F.coalesce("system", F.lit("")), F.array_join(F.transform("before", lambda t: t["shown"]), ""))
    windows = windows.withColumn("context", context)
    windows = windows.withColumn("place", F.length("context"))

    def target(turn: Column, i: Column) -> Column:
        earlier = F.aggregate(F.slice("own", 1, i), F.lit(0), lambda sum_, t: sum_ + F.length(t["shown"]))
        text_at = F.col("place") + earlier + F.length(opening(turn["role"]))
        return F.struct(turn["role"].alias("role"), text_at.alias("start"), turn["size"].alias("length"))

    spans = F.filter(F.transform("own", target), lambda s: s["role"] == "assistant")
    tokens = F.aggregate("own", F.lit(0).cast("long"), lambda sum_, t: sum_ + t["n"])
    tokens = tokens + F.aggregate("before", F.lit(0).cast("long"), lambda sum_, t: sum_ + t["n"])
    tokens = tokens + F.when(F.col("system").isNotNull(), F.col("system_n")).otherwise(0)
    return windows.select(
        F.col("conv").alias(columns[0]),
        "first",
        F.size("own").alias("n_turns"),
        (F.size("before") + F.col("system").isNotNull().cast("int")).alias("repeated"),
        F.concat("context", F.array_join(F.transform("own", lambda t: t["shown"]), "")).alias("text"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
        tokens.alias("n_tokens"),
        (tokens > budget).alias("over_budget"),
    )


def with_history(windows: DataFrame, turns: DataFrame, history: int) -> DataFrame:
    """Adds ``before``: the unbroken run of at most ``history`` turns just before each window whose tokens
    together fit into its ``room``."""
    none = F.expr("array_repeat(named_struct('shown', '', 'n', 0L), 0)")
    if not history:
        return windows.withColumn("before", none)
    back = F.explode(F.array(*(F.lit(k) for k in range(1, history + 1)))).alias("back")
    wanted = windows.where("first > 0 and room > 0").select("conv", "first", "room", back)
    shown = F.concat(opening(F.col("role")), escaped(F.col("text")), F.lit(CLOSE)).alias("shown")
    known = turns.select(F.col("conv").alias("c"), F.col("pos").alias("p"), shown, "n")
    same = wanted["conv"].eqNullSafe(known["c"]) & (wanted["first"] - wanted["back"] == known["p"])
    # A turn that is too long by itself is not carried along.
    fits = known["n"] <= wanted["room"]
    found = wanted.join(known, same & fits).groupBy(F.col("conv").alias("c"), F.col("first").alias("f")).agg(
        F.array_sort(F.collect_list(F.struct("back", "shown", "n"))).alias("found")
    )
    same = windows["conv"].eqNullSafe(found["c"]) & (windows["first"] == found["f"])

    def together(i: Column) -> Column:
        return F.aggregate(F.slice("found", 1, i + 1), F.lit(0).cast("long"), lambda sum_, t: sum_ + t["n"])

    # The prefix sums only grow, so what stays is a run.
    run = F.filter("found", lambda t, i: (t["back"] == i + 1) & (together(i) <= F.col("room")))
    before = F.transform(F.reverse(run), lambda t: F.struct(t["shown"], t["n"].alias("n")))
    return windows.join(found, same, "left").withColumn("before", F.coalesce(before, none)).drop("c", "f", "found")


def turns_of(windows: DataFrame) -> DataFrame:
    """Reads windows back: ``turns`` (role, text) without the repeated ones, and ``targets``."""
    pieces = F.split("text", CLOSE, -1)
    own = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))

    def parsed(piece: Column) -> Column:
        cut = F.instr(piece, ">\n")
        role = F.url_decode(F.substr(piece, F.lit(7), cut - 7))
        return F.struct(role.alias("role"), unescaped(F.substr(piece, cut + 2)).alias("text"))

    target = F.transform("loss", lambda s: unescaped(F.substr(F.col("text"), s["start"] + 1, s["length"])))
    return windows.withColumns({"turns": F.transform(own, parsed), "targets": target})
