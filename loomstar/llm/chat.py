"""Chat formatting (10): turn-aligned windows under a token budget, from prefix sums.

Turns of a conversation are ordered; the prefix sum of their tokens, cut at
multiples of a stride, assigns each turn to a window.  A window repeats the
leading system turn and as many turns before it as fit into ``HISTORY`` tokens;
only texts of assistant turns that are new in the window are targets (loss
spans), so each is a target once.  The stride is half of what system turn and
history leave of the budget: a window then keeps the budget unless a single turn
is longer than the stride (no turn is cut or dropped).  History takes a third at most of
what the system turn leaves, so it never takes the place of new turns.  Behind a system turn that leaves less than
three times ``LEAST`` tokens, windows still have ``LEAST`` tokens of history and
a stride of ``LEAST``: they pass the budget by what the system turn takes beyond that.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and
texts, ``<|`` gets a backslash after ``<`` (and ``<\\|`` another one), which is
undone on reading, so no text can look like a mark.

Built-in expressions only.  Defined results: NULL texts and roles are empty; NULL
turns come first; equal turn numbers are ordered by role, then text; repeated
rows are turns of their own; rows with a NULL conversation id are one
conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstar.llm.shared import words_of

BUDGET = 512      # tokens of a window
HISTORY = 128     # tokens of repeated turns
LEAST = 32        # tokens of history and of a stride that a long system turn leaves
OVERHEAD = 4      # tokens that a turn's marks count for
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    parts = F.split(unescaped(role), r"\\\\", -1)  # doubled backslashes apart, then the line breaks
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def word_tokens(text: Column) -> Column:
    """The default token count: words, and the marks of a turn."""
    return F.size(words_of(text)) + OVERHEAD


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=word_tokens) -> DataFrame:
    """``(conv_id, window, formatted, loss, n_repeated)`` from rows ``(conv_id, turn, role, text)``.

    ``loss`` has the spans (code points, end exclusive) of the targets in
    ``formatted``; the first ``n_repeated`` turns were in an earlier window.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("ord", F.row_number().over(order)).withColumn("n", tokens(F.col("text")).cast("long"))
    rows = rows.withColumn("system", (F.col("ord") == 1) & (F.col("role") == "system"))
    by_turn = Window.partitionBy("conv_id").orderBy("ord")
    whole = Window.partitionBy("conv_id")
    rows = rows.withColumn("kept", F.when(F.col("system"), F.lit(0)).otherwise(F.col("n"))) \
        .withColumn("sum", F.sum("kept").over(by_turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("kept")) \
        .withColumn("head", F.first(F.when(F.col("system"), F.col("n")), ignorenulls=True).over(
            by_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    room = F.greatest(F.lit(budget) - F.coalesce("head", F.lit(0)), F.lit(3 * LEAST))
    rows = rows.withColumn("history", F.least(F.lit(history), F.floor(room / 3)))
    stride = F.greatest(F.lit(1), F.floor((room - F.col("history")) / 2))
    rows = rows.withColumn("window", F.floor(F.col("sum") / stride))
    # the next window that has turns of its own (a long turn jumps over numbers), and where it begins; a stride is
    # no shorter than the history, so no window after that one reaches back to this turn
    following = Window.partitionBy("conv_id").orderBy("window").rangeBetween(1, Window.unboundedFollowing)
    own = ~F.col("system")
    rows = rows.withColumn("next", F.min(F.when(own, F.col("sum"))).over(following)) \
        .withColumn("next_window", F.min(F.when(own, F.col("window"))).over(following)) \
        .withColumn("last", F.max("window").over(whole))
    again = F.when(F.col("system"), F.when(F.col("last") > 0, F.sequence(F.lit(1), F.col("last")))) \
        .when(F.col("next") - F.col("sum") <= F.col("history"), F.array("next_window"))
    placed = rows.select("conv_id", "ord", "role", "text", F.explode(F.concat(
        F.array(F.struct(F.col("window").alias("w"), F.lit(False).alias("again"))),
        F.coalesce(F.transform(again, lambda w: F.struct(w.alias("w"), F.lit(True).alias("again"))),
                   F.array().cast("array<struct<w:bigint,again:boolean>>")))).alias("x")) \
        .select("conv_id", "ord", "role", "x.w", "x.again", escaped_role(F.col("role")).alias("as_role"), escaped(F.col("text")).alias("as_text"))
    placed = placed.withColumn("piece", F.concat(F.lit(OPEN), "as_role", F.lit("\n"), "as_text", F.lit(CLOSE)))
    inside = Window.partitionBy("conv_id", "w").orderBy("ord")
    start = F.sum(F.length("piece")).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece") \
        + F.length("as_role") + len(OPEN) + 1
    placed = placed.withColumn("start", start).withColumn("span", F.when(
        (F.col("role") == "assistant") & ~F.col("again"),
        F.struct(F.col("start").alias("start"), (F.col("start") + F.length("as_text")).alias("end"))))
    out = placed.groupBy("conv_id", "w").agg(
        F.array_sort(F.collect_list(F.struct("ord", "piece", "span"))).alias("turns"), F.count_if("again").alias("n_repeated"))
    # a window that only a long turn jumps over has nothing new
    return out.where(F.size("turns") > F.col("n_repeated")).select(
        "conv_id", F.col("w").alias("window"), F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss"),
        F.col("n_repeated").cast("long").alias("n_repeated"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say: its turns and the texts under the loss mask."""
    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 1, F.length(piece))
        cut = F.instr(body, "\n")
        return F.struct(unescaped_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescaped(F.substring(body, cut + 1, F.length(body))).alias("text"))

    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    new = F.slice(pieces, F.col("n_repeated").cast("int") + 1, F.greatest(F.lit(0), F.size(pieces) - 1 - F.col("n_repeated").cast("int")))
    target = F.transform("loss", lambda s: unescaped(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    rows = formatted.select("conv_id", "window", F.transform(new, turn).alias("turns"), F.array_join(target, "").alias("target"),
                            F.length("formatted").cast("long").alias("chars"))
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "turns", "target"))).alias("w"),
                                        F.sum("chars").alias("formatted_chars"))
    said = F.array_join(F.transform(F.flatten(F.transform("w", lambda x: x["turns"])),
                                    lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    found = found.select("conv_id", "formatted_chars", F.aggregate("w", F.lit(0), lambda a, x: a + F.size(x["turns"])).alias("n"),
                         said.alias("said"), F.array_join(F.transform("w", lambda x: x["target"]), "").alias("target"))
    return found.select("conv_id", F.col("n").cast("long").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                        F.length("target").cast("long").alias("loss_chars"), F.sha2("target", 256).alias("loss_sha256"),
                        "formatted_chars")
