"""Quotation linking for chats and mail threads, in DataFrame operations only.

A line's quote level is the number of '>' before its text. Runs of quoted lines of one level are
passages. A passage, its paragraphs and its lines, and everything a message says in its own words
(its whole text, each run between quotes, each paragraph of these, each line) are normalised and
hashed. The passage's message is the latest earlier one of the conversation with an equal hash; if
none has the whole passage, the one that most of its paragraphs are found in, then most of its
lines, the latest of these if there are several. A message that quotes another is an answer to it.

The result is the messages in reply order without their quotes. Nothing is gathered by
conversation: quotes meet sayings in a running maximum within ranges of (conversation, hash, turn),
and the threads are numbered by doubling: sizes of the answers' trees from the bottom, places from
the top, each in as many rounds as the logarithm of the deepest thread, and each a join with one row
on one side. So one conversation, thread or message answered may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import earlier_in_group
from ..functions.workspace import hold
from .skew import join_keys

_QUOTED = r"^[ \t]*(>[ \t]*)+"
_BLANK_LINE = r"\n[ \t]*\n"
_SAID = r"(?i)^[ \t]*(on\b.*\bwrote|.{1,80}\b(?:wrote|writes)):[ \t]*$"


def normalised(text: Column) -> Column:
    """Lower case, white space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passage_hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def parse_quotes(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``own`` (text outside quotes), ``runs`` (its parts between quotes) and ``quotes``: array of (level, passage).

    A line that only announces a quote ('... wrote:') right before one is dropped with it.
    """
    lines = F.transform(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, _QUOTED, 0), "[^>]", "")).alias("level"),
            F.when(x.rlike(_QUOTED), F.regexp_replace(x, _QUOTED, "")).otherwise(x).alias("line"),
        ),
    )
    parsed = messages.withColumn("_lines", lines).withColumn("_levels", F.col("_lines.level"))

    def announces(x: Column, i: Column) -> Column:
        return x["line"].rlike(_SAID) & (F.coalesce(F.get("_levels", i + 1), F.lit(0)) > 0)

    own = F.filter("_lines", lambda x, i: (x["level"] == 0) & ~announces(x, i))
    said = F.transform(
        "_lines", lambda x, i: F.when((x["level"] == 0) & announces(x, i), F.lit("")).otherwise(x["line"])
    )
    # the lines at which another level begins, and the runs from each of them to the next
    begins = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1),
        lambda i: (i == 0) | (F.get("_levels", i) != F.get("_levels", i - 1)),
    )
    parsed = parsed.withColumn("_said", said).withColumn("_begins", begins)
    runs = F.transform(
        "_begins",
        lambda i, k: F.struct(
            F.get("_levels", i).alias("level"),
            F.array_join(
                F.slice("_said", i + 1, F.coalesce(F.get("_begins", k + 1), F.size("_lines")) - i), "\n"
            ).alias("passage"),
        ),
    )
    parsed = parsed.withColumn("_runs", runs)
    return (
        parsed.withColumn("own", F.trim(F.array_join(F.transform(own, lambda x: x["line"]), "\n")))
        .withColumn("runs", F.transform(F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["passage"]))
        .withColumn("quotes", F.filter("_runs", lambda r: (r["level"] > 0) & (F.trim(r["passage"]) != "")))
        .drop("_lines", "_levels", "_said", "_begins", "_runs")
    )


def _parts(q: Column) -> Column:
    """(kind, unit) of a passage: 0 the whole, 1 its paragraphs, 2 its lines; no kind of a single part repeats the whole."""

    def named(kind: int, units: Column) -> Column:
        said = F.filter(units, lambda x: F.trim(x) != "")
        return F.transform(said, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("unit")))

    paragraphs, lines = named(1, F.split(q["passage"], _BLANK_LINE)), named(2, F.split(q["passage"], "\n"))
    parts = [F.when(F.size(x) > 1, x).otherwise(F.slice(x, 1, 0)) for x in (paragraphs, lines)]
    return F.concat(named(0, F.array(q["passage"])), *parts)


def reply_order(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per input row, sorted: conv, turn, role, reply_to, depth, n_quotes, n_linked, thread, place, text.

    reply_to is the turn of the message quoted at the lowest level that links, the latest such turn
    if there are several; null where nothing quoted is found earlier in the conversation. thread is the
    turn of the message that the chain of answers begins with, place the message's number in the
    thread: after the message it answers, and before that message's later answers. Rows are in the
    order of conv, thread and place. Turns are any longs. text has no quotes. Null text is empty, says
    nothing and quotes nothing. Null conversations or turns link to nothing and sort first. Rows that
    repeat a turn are all kept; they share their place. Columns of other names are ignored. An empty
    table gives no rows.
    """
    rows = messages.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"),
        F.col(role_col).alias("_role"), F.col(text_col).alias("_text"),
    )
    parsed = parse_quotes(rows, "_text").drop("_text")
    # texts without a mark at the begin of a line have no quotes; the pattern finds more begins than there are
    marked = rows.where(F.col("_text").rlike(r"(?m)^[ \t]*>"))
    quoting = hold(
        parse_quotes(marked, "_text").where(F.size("quotes") > 0)
        .select("_conv", "_turn", F.explode("quotes").alias("q"))
        .select("_conv", "_turn", F.col("q.level").alias("_level"), passage_hash(F.col("q.passage")).alias("_passage"),
                F.explode(_parts(F.col("q"))).alias("p"))
        .select("_conv", "_turn", "_level", "_passage", F.col("p.kind").alias("_kind"), passage_hash(F.col("p.unit")).alias("_hash")),
        "quotes",
    )
    answers = hold(_links(parsed, quoting), "answers")
    numbered = hold(_numbered(answers), "numbered")
    out = (
        parsed.join(answers, ["_conv", "_turn"], "left")
        .join(numbered, ["_conv", "_turn"], "left")
        .select(
            F.col("_conv").alias(conv_col), F.col("_turn").alias(turn_col), F.col("_role").alias(role_col),
            F.col("_to").alias("reply_to"),
            F.coalesce("_depth", F.lit(0)).alias("depth"),
            F.size("quotes").alias("n_quotes"),
            F.coalesce("_linked", F.lit(0)).cast("int").alias("n_linked"),
            F.coalesce("_thread", "_turn").alias("thread"),
            F.coalesce("_place", F.lit(0).cast("long")).alias("place"),
            F.col("own").alias(text_col),
        )
    )
    return out.orderBy(conv_col, "thread", "place")


def _links(parsed: DataFrame, quoting: DataFrame) -> DataFrame:
    """(conv, turn) of each quoting message with the turn it answers and the passages that link."""
    says = F.array_distinct(
        F.filter(
            F.concat(
                F.array("own"), F.split("own", _BLANK_LINE), F.split("own", "\n"),
                "runs", F.flatten(F.transform("runs", lambda x: F.split(x, _BLANK_LINE))),
            ),
            lambda x: F.trim(x) != "",
        )
    )
    said = parsed.select("_conv", F.col("_turn").alias("_said"), F.explode(says).alias("unit")).select(
        "_conv", "_said", passage_hash(F.col("unit")).alias("_hash")
    )
    wanted = quoting.select("_conv", "_hash").distinct()
    said = said.join(wanted, ["_conv", "_hash"], "left_semi")
    parts = (
        quoting.select("_conv", "_turn", "_level", "_passage", "_kind", "_hash").distinct()
        .join(_latest(quoting, said), ["_conv", "_hash", "_turn"])
    )
    # a passage's message: the whole before paragraphs before lines, then the most parts, then the latest
    best = F.max(F.struct((-F.col("_kind")).alias("_minus"), "_n", "_said"))
    found = (
        parts.groupBy("_conv", "_turn", "_level", "_passage", "_kind", "_said").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_conv", "_turn", "_level", "_passage").agg(best["_said"].alias("_said"))
    )
    nearest = F.max(F.struct((-F.col("_level")).alias("_minus"), "_said"))
    return found.groupBy("_conv", "_turn").agg(F.count(F.lit(1)).alias("_linked"), nearest["_said"].alias("_to"))


def _latest(quoting: DataFrame, said: DataFrame) -> DataFrame:
    """(conv, hash, turn) of each quote with the latest earlier turn that says it, if there is one.

    A running maximum over quotes and sayings together, so a line that thousands say and thousands
    quote costs rows, not pairs. It runs within ranges of (conv, hash, turn) of about equal size;
    what earlier ranges hold is one row for each range that a hash reaches into.
    """
    asked = quoting.select("_conv", "_hash", "_turn", F.lit(True).alias("_asked"), F.lit(None).cast("long").alias("_at"))
    told = said.select("_conv", "_hash", F.col("_said").alias("_turn"), F.lit(False).alias("_asked"), F.col("_said").alias("_at"))
    turns = (
        asked.unionByName(told).where("_conv is not null and _turn is not null")
        .groupBy("_conv", "_hash", "_turn").agg(F.max("_asked").alias("_asked"), F.max("_at").alias("_at"))
        .repartitionByRange("_conv", "_hash", "_turn").withColumn("_range", F.spark_partition_id())
    )
    turns = hold(turns, "turns")
    same = W.partitionBy("_conv", "_hash")
    carried = turns.groupBy("_conv", "_hash", "_range").agg(F.max("_at").alias("_top")).withColumn(
        "_top", F.max("_top").over(same.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    ).where("_top is not null")
    inside = W.partitionBy("_conv", "_hash", "_range").orderBy("_turn").rowsBetween(W.unboundedPreceding, -1)
    return (
        turns.withColumn("_in", F.max("_at").over(inside)).where("_asked")
        .join(carried, ["_conv", "_hash", "_range"], "left")
        .select("_conv", "_hash", "_turn", F.coalesce("_in", "_top").alias("_said")).where("_said is not null")
    )


def _node(turn: str) -> Column:
    return F.struct("_conv", F.col(turn).alias("_turn"))


def _up(state: DataFrame, carry: list[str]) -> DataFrame:
    """Each open row of ``state`` with what the row that it points to holds: ``_next`` and ``up{c}``.

    Rows point by ``_up``, a turn of their conversation, and are open until that is null.
    """
    open_ = state.where("_up is not null").withColumn("_key", _node("_up"))
    above = state.select(_node("_turn").alias("_key"), F.col("_up").alias("_next"), *[F.col(c).alias(f"up{c}") for c in carry])
    return join_keys(open_, above, "_key", open_.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))).drop("_key")


def _sizes(nodes: DataFrame) -> DataFrame:
    """(conv, turn, to, size): how many messages the tree of answers under each has, itself included.

    In round k a row knows those less than 2^k levels below and points 2^k levels up; what it points to
    takes over its count.
    """
    state = hold(nodes.withColumns({"_up": F.col("_to"), "_size": F.lit(1).cast("long")}), "sizes")
    while not state.where("_up is not null").isEmpty():
        more = state.where("_up is not null").groupBy("_conv", F.col("_up").alias("_turn")).agg(F.sum("_size").alias("_more"))
        stepped = _up(state, []).select("_conv", "_turn", "_to", F.col("_next").alias("_up"), "_size")
        both = stepped.unionByName(state.where("_up is null"))
        state = hold(
            both.join(more, ["_conv", "_turn"], "left")
            .withColumn("_size", F.col("_size") + F.coalesce("_more", F.lit(0)))
            .drop("_more"),
            "sizes",
        )
    return state.drop("_up")


def _numbered(answers: DataFrame) -> DataFrame:
    """(conv, turn, depth, thread, place) of every message that answers or is answered.

    A message's place is its parent's, plus one, plus the sizes of its earlier siblings' trees; places
    and depths are summed along the way to the top, which doubles each round.
    """
    answering = answers.select("_conv", "_turn", "_to")
    asked = answering.select("_conv", F.col("_to").alias("_turn")).distinct()
    first = asked.join(answering, ["_conv", "_turn"], "left_anti").withColumn("_to", F.lit(None).cast("long"))
    sized = _sizes(answering.unionByName(first))
    placed = earlier_in_group(sized.where("_to is not null"), ["_conv", "_to"], ["_turn"], F.col("_size"), "_earlier")
    begun = placed.select(
        "_conv", "_turn", F.col("_to").alias("_up"), (F.col("_earlier") + 1).alias("_place"), F.lit(1).alias("_depth"),
        F.lit(None).cast("long").alias("_thread"),
    )
    tops = sized.where("_to is null").select(
        "_conv", "_turn", F.col("_to").alias("_up"), F.lit(0).cast("long").alias("_place"), F.lit(0).alias("_depth"),
        F.col("_turn").alias("_thread"),
    )
    state = hold(begun.unionByName(tops), "places")
    while not state.where("_up is not null").isEmpty():
        stepped = _up(state, ["_place", "_depth", "_thread"]).select(
            "_conv", "_turn", F.col("_next").alias("_up"), (F.col("_place") + F.col("up_place")).alias("_place"),
            (F.col("_depth") + F.col("up_depth")).alias("_depth"), F.col("up_thread").alias("_thread"),
        )
        state = hold(stepped.unionByName(state.where("_up is null")), "places")
    return state.drop("_up")
