r"""Quotation linking: which message a quoted passage comes from, and conversations in the order of their replies.

DataFrame functions only. Lines that start with > are quoted, each further > is one level deeper. The passages of a level
(a message's own text is level 0) are its lines, and the sentences and runs of eight words of its paragraphs: neighbouring
lines of one level, joined. So a quote is known when it is wrapped anew, and when it is a part of a line or paragraph.
Passages are known by a hash of their normal form (lower case, white space as single spaces).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import written

_MARKS = r"^((?:[ \t]*>)+)"
#: Where a sentence ends and another begins: after a mark and a space, or after a full-width mark.
_SENTENCE_END = "(?<=[.!?\u2026][\"')\\]\u201d\u2019\u00bb]{0,2}) |(?<=[\u3002\uff01\uff1f]) ?"
#: Words of a run.
RUN = 8
#: Turns that are looked through in one go for the latest message with a passage.
STRETCH = 1024


def _lines(text: Column) -> Column:
    """(level, body, norm) of each line: how deep it is quoted, the rest of the line, and its normal form."""
    empty = F.lit("")

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 1)
        body = F.regexp_replace(line, _MARKS + "[ \t]?", "")
        norm = F.lower(F.btrim(F.regexp_replace(body, r"(?U)\s+", " ")))
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), empty))
        return F.struct(level.alias("level"), body.alias("body"), norm.alias("norm"))

    return F.transform(F.split(F.coalesce(text, empty), "\n"), parse)


def _passages(rows: DataFrame) -> DataFrame:
    """(conversation, turn, level, hash) of each passage, repeats included; `rows` has the lines.

    Passages become hashes where they are found, so that only numbers are shuffled.
    """
    levels = F.array_distinct(F.transform("lines", lambda line: line["level"]))
    rows = rows.select("conversation", "turn", "lines", F.explode(levels).alias("level"))

    def here(line: Column) -> Column:
        return (line["level"] == F.col("level")) & (line["norm"] != "")

    def hashes(passages: Column) -> Column:
        return F.transform(F.filter(passages, lambda passage: passage != ""), lambda passage: F.xxhash64(passage))

    norms = F.transform("lines", lambda line: F.when(here(line), line["norm"]).otherwise(F.lit("\n")))
    rows = rows.select("conversation", "turn", "level", norms.alias("norms"))
    lines = F.filter("norms", lambda norm: norm != "\n")
    paragraphs = rows.select("conversation", "turn", "level", F.explode(F.split(F.array_join("norms", " "), "\n")).alias("joined"))
    paragraphs = paragraphs.withColumn("joined", F.btrim("joined")).filter("joined <> ''")
    words = paragraphs.withColumn("words", F.split("joined", " ")).filter(F.size("words") >= RUN)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("words") - RUN + 1), lambda at: F.xxhash64(F.array_join(F.slice("words", at, RUN), " "))
    )
    parts = [
        rows.select("conversation", "turn", "level", F.explode(hashes(lines)).alias("hash")),
        paragraphs.select("conversation", "turn", "level", F.explode(hashes(F.split("joined", _SENTENCE_END))).alias("hash")),
        words.select("conversation", "turn", "level", F.explode(runs).alias("hash")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def _sources(own: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conversation, turn, level, source): for each quoted passage the latest earlier turn that has it as its own.

    Turns are cut into stretches: within one, a running maximum finds the source; the maximum of the stretches before
    is carried in. So a passage that a long conversation repeats all the time is no single task's work.
    """
    both = own.select("conversation", "turn", "hash", F.lit(None).cast("int").alias("level")).distinct().unionByName(
        quoted.select("conversation", "turn", "hash", "level").distinct()
    )
    both = both.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    key = ["conversation", "hash", "stretch"]
    turn = F.when(F.col("level").isNull(), F.col("turn"))
    ends = both.groupBy(key).agg(F.max(turn).alias("last"))
    past = Window.partitionBy("conversation", "hash").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.max("last").over(past)).select(*key, "carried")
    here = Window.partitionBy(key).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("near", F.max(turn).over(here)).filter("level IS NOT NULL").join(carried, key)
    source = F.coalesce("near", "carried")
    return found.select("conversation", "turn", "level", source.alias("source")).filter("source IS NOT NULL")


def _threads(parents: DataFrame) -> DataFrame:
    """(conversation, turn, parent_turn, root_turn, depth) of every reply, by doubling the steps towards the root."""
    state = written(parents.withColumns({"root_turn": F.col("parent_turn"), "depth": F.lit(1).cast("long")}), "replies")
    while True:
        above = state.select(
            "conversation", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more")
        )
        grown = state.join(above, ["conversation", "root_turn"], "left")
        if not grown.filter("next IS NOT NULL").limit(1).count():
            return state
        state = written(
            grown.select(
                "conversation",
                "turn",
                "parent_turn",
                F.coalesce("next", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "replies",
        )


def _positions(replies: DataFrame) -> DataFrame:
    """`replies` with `position`: the place of each in its thread by (depth, turn), from 1; the root is at 0.

    Counted by stretches of turns of one depth, and carried on from those before, so that a thread with very many replies
    to one message is not a single task's work.
    """
    replies = replies.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    thread, cell = ["conversation", "root_turn"], ["depth", "stretch"]
    before = Window.partitionBy(*thread).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    sizes = replies.groupBy(*thread, *cell).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    here = F.row_number().over(Window.partitionBy(*thread, *cell).orderBy("turn"))
    placed = replies.withColumn("position", here).join(sizes, [*thread, *cell])
    return placed.withColumn("position", F.col("position") + F.col("before")).drop("before", "stretch")


def linked(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Every message without its quotes, with its place among the replies.

    Returns conv_id, turn, role, text (the lines that are not quoted, without empty lines at both ends), n_quoted
    (quoted lines), levels (deepest level), n_linked (different quoted lines, sentences and runs of words with a known
    source; one passage may count as several), parent_turn,
    root_turn, depth and position. The parent is the latest earlier turn of the conversation that has a passage which the message
    quotes at the first level; root and depth follow from the parents. A root and its replies are a thread; `position`
    numbers its messages by (depth, turn) from 0, the root, so every message comes after the one it answers
    (`conversations` makes one row of each thread). A message that quotes nothing known is its own root at depth 0.

    A null text counts as empty. A row without conversation or turn has no place: it loses its quotes and is its own
    root. Rows that repeat a conversation and turn share their links, and each comes back. An empty table gives no rows.
    Other columns are ignored.
    """
    rows = messages.select(
        F.col(conversation).alias("conversation"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
        _lines(F.col(text)).alias("lines"),
    )
    placed = rows.filter("conversation IS NOT NULL AND turn IS NOT NULL").select("conversation", "turn", "lines")
    quoting = placed.filter(F.exists("lines", lambda line: line["level"] > 0))
    quoted = written(_passages(quoting).filter("level > 0").distinct(), "quoted-passages")
    # Only what somebody quotes in the conversation can be a source: the rest goes before repeats are looked for.
    own = _passages(placed.join(quoted.select("conversation").distinct(), "conversation", "left_semi")).filter("level = 0")
    wanted = quoted.select("conversation", "hash").distinct()
    own = own.join(wanted, ["conversation", "hash"], "left_semi").distinct()
    sources = written(_sources(own, quoted), "quote-sources")
    parents = sources.filter("level = 1").groupBy("conversation", "turn").agg(F.max("source").alias("parent_turn"))
    counts = sources.groupBy("conversation", "turn").agg(F.count(F.lit(1)).alias("n_linked"))
    threads = counts.join(_positions(_threads(parents)), ["conversation", "turn"], "left")
    bare = F.array_join(F.transform(F.filter("lines", lambda line: line["level"] == 0), lambda line: line["body"]), "\n")
    levels = F.transform("lines", lambda line: line["level"])
    shown = rows.select(
        "conversation",
        "turn",
        "role",
        F.btrim(bare, F.lit("\n")).alias("text"),
        F.size(F.filter(levels, lambda level: level > 0)).cast("long").alias("n_quoted"),
        F.array_max(levels).cast("long").alias("levels"),
    )
    return shown.join(threads, ["conversation", "turn"], "left").select(
        F.col("conversation").alias("conv_id"),
        "turn",
        "role",
        "text",
        "n_quoted",
        "levels",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("position", F.lit(0)).cast("long").alias("position"),
    )


def conversations(messages: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, root_turn, n_messages, messages): one row for each thread, its messages (turn, role, text) in reply order.

    A thread is one example to learn from, so its messages come together in one row at last. Messages that are empty
    without their quotes are left out, and threads that have no other. Rows that repeat a turn come next to each other.
    """
    message = F.struct("position", "turn", "role", "text")
    threads = linked(messages, **columns).filter("text <> ''").groupBy("conv_id", "root_turn")
    ordered = F.transform(F.sort_array(F.collect_list(message)), lambda one: F.struct(one["turn"], one["role"], one["text"]))
    return threads.agg(F.count(F.lit(1)).alias("n_messages"), ordered.alias("messages"))
