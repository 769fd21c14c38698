"""Chat formatting by prefix-target expansion.

A turn is formatted as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Every assistant turn
is exploded into an example of its own: the formatted conversation up to and including
that turn, of which only the reply's text is trainable.  A conversation that doesn't end
with an assistant turn has one more row, all of it without anything trainable.

An example is stored in parts of a cell each, so a long conversation's examples are many
rows of bounded size.  The parts before an example's own cell are the same for
all examples behind them; the text of n turns is written about n / 2 times, which is
what the method asks for.

Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, ``<|`` becomes ``<\\|``, and a line feed in a role ``\\n``.

Turns are put in order within cells of ``CELL`` turn numbers; the cells' sums are
added up per conversation, so a huge conversation is many cells.

Defined cases: null text is empty, a null role the empty role; rows with the same
turn are ordered by role and text and kept, repeated rows too; a null turn comes
first; rows without ``conv_id`` are one conversation; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
CELL = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """Doubled backslashes are set aside, so that they don't join an ``n``."""
    parts = F.transform(F.split(role, r"\\\\", -1), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(parts, "\\")


def format_turns(conversations: DataFrame) -> DataFrame:
    """The formatted conversations, a segment a turn:
    ``conv_id, cell, seq, segment, begin, end, target, reply_begin, reply_end`` (characters)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = (conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
                                  text.alias("text"))
             .withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL), F.lit(-(1 << 62))))
             .withColumn("head", F.char_length(head))
             .withColumn("segment", F.concat(head, escape(F.col("text")), F.lit(END)))
             .withColumn("size", F.char_length("segment").cast("bigint")))
    inside = Window.partitionBy("conv_id", "cell").orderBy("turn", "role", "text")
    turns = (turns.withColumn("before", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                                                   F.lit(0)))
             .withColumn("place", F.row_number().over(inside).cast("bigint")))
    along = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (turns.groupBy("conv_id", "cell").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
             .select(F.col("conv_id").alias("c"), F.col("cell").alias("k"),
                     F.coalesce(F.sum("size").over(along), F.lit(0)).alias("base"),
                     F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base_n")))
    joined = turns.join(cells, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("cell") == F.col("k")))
    begin = F.col("base") + F.col("before")
    return joined.select("conv_id", "cell", (F.col("base_n") + F.col("place") - 1).alias("seq"), "segment",
                         begin.alias("begin"), (begin + F.col("size")).alias("end"),
                         (F.col("role") == "assistant").alias("target"), (begin + F.col("head")).alias("reply_begin"),
                         (begin + F.col("size") - len(END)).alias("reply_end"))


def expand(segments: DataFrame) -> DataFrame:
    """The examples, a row a part: ``conv_id, target_seq, own, last, cell, part,
    trainable, reply_begin, reply_end``.

    ``target_seq`` is the turn an example ends with, ``part`` its text in the turns of
    ``cell``, ``own`` marks the part with the reply, whose characters from
    ``reply_begin`` to ``reply_end`` are the loss mask (null elsewhere), and ``last`` the
    example that holds the whole conversation."""
    turn = F.struct("seq", "segment", "target", (F.col("reply_begin") - F.col("begin")).cast("int").alias("from"),
                    (F.col("reply_end") - F.col("begin")).cast("int").alias("to"))
    cells = (segments.groupBy("conv_id", "cell").agg(F.array_sort(F.collect_list(turn)).alias("turns")))
    ends = segments.groupBy(F.col("conv_id").alias("c")).agg(F.max("seq").alias("last_seq"))
    cells = materialize(cells.join(ends, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"), "chat-cells")
    text = lambda turns: F.array_join(F.transform(turns, lambda t: t["segment"]), "")
    spots = F.filter(F.transform("turns", lambda t, i: F.struct(t.alias("t"), (i + 1).alias("n"))),
                     lambda s: s["t"]["target"] | (s["t"]["seq"] == F.col("last_seq")))
    own = cells.select("conv_id", "cell", "turns", "last_seq", F.explode(spots).alias("s")).select(
        "conv_id", F.col("s.t.seq").alias("target_seq"), "cell", (F.col("s.t.seq") == F.col("last_seq")).alias("last"),
        F.col("s.t.target").alias("trainable"), text(F.slice("turns", F.lit(1), F.col("s.n") - 1)).alias("context"),
        F.col("s.t").alias("t"))
    before, reply = F.char_length("context"), F.col("trainable")
    own_parts = own.select(
        "conv_id", "target_seq", F.lit(True).alias("own"), "last", "cell", F.concat("context", "t.segment").alias("part"),
        "trainable", F.when(reply, before + F.col("t.from")).alias("reply_begin"),
        F.when(reply, before + F.col("t.to")).alias("reply_end"))
    earlier = cells.select(F.col("conv_id").alias("c"), F.col("cell").alias("k"), text(F.col("turns")).alias("part"))
    none = F.lit(None).cast("int")
    parts = (own.select("conv_id", "target_seq", "cell", "last", "trainable")
             .join(earlier, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("k") < F.col("cell")))
             .select("conv_id", "target_seq", F.lit(False).alias("own"), "last", F.col("k").alias("cell"), "part",
                     "trainable", none.alias("reply_begin"), none.alias("reply_end")))
    return own_parts.unionByName(parts)


def render(examples: DataFrame) -> DataFrame:
    """Whole examples: ``conv_id, target_seq, text, reply_begin, reply_end`` (characters);
    an example's text is one value, so use the parts where conversations are long."""
    size = F.char_length("part").cast("bigint")
    whole = (examples.where("trainable").groupBy("conv_id", "target_seq").agg(
        F.array_sort(F.collect_list(F.struct("cell", "part"))).alias("parts"),
        F.sum(F.when(F.col("own"), 0).otherwise(size)).alias("before"),
        F.max("reply_begin").alias("a"), F.max("reply_end").alias("b")))
    return whole.select("conv_id", "target_seq", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("text"),
                        (F.col("before") + F.col("a")).alias("reply_begin"), (F.col("before") + F.col("b")).alias("reply_end"))


def parsed(part: Column) -> Column:
    """Array of the turns in a formatted text: ``(role, text)``."""
    # texts and roles hold no unescaped control string, so each END closes a turn
    bodies = F.transform(F.filter(F.split(part, r"<\|im_end\|>\n", -1), lambda t: t != ""),
                         lambda t: F.substring(t, len(START) + 1, 1 << 30))

    def turn(body):
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(role).alias("role"),
                        unescape(F.substring(body, F.char_length(role) + 2, F.lit(1 << 30))).alias("text"))
    return F.transform(bodies, turn)


def _joined(name: str, order: str) -> Column:
    """Strings of a group in order; nulls add nothing."""
    runs = F.array_sort(F.collect_list(F.struct(order, name)))
    return F.array_join(F.transform(runs, lambda r: r[name]), "")


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what is read back from its examples (stored, as they are read
    three times): the turns of the last one, the text under each one's loss mask, the
    characters of all and, in ``contexts_sha256``, the digests of all their texts in order."""
    key = F.col("conv_id").eqNullSafe(F.col("c"))
    lines = F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    whole = (examples.where("last").select("conv_id", "cell", parsed(F.col("part")).alias("t"))
             .select("conv_id", "cell", F.size("t").cast("bigint").alias("n"), F.array_join(lines, "").alias("lines"))
             .groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sha2(_joined("lines", "cell"), 256).alias("turns_sha256")))
    span = F.substring("part", F.col("reply_begin") + 1, F.col("reply_end") - F.col("reply_begin"))
    replies = (examples.where("own AND trainable").select("conv_id", "cell", "target_seq", unescape(span).alias("loss"))
               .groupBy("conv_id", "cell").agg(_joined("loss", "target_seq").alias("losses"))
               .groupBy(F.col("conv_id").alias("c")).agg(
                   F.sum(F.char_length("losses")).cast("bigint").alias("loss_chars"),
                   F.sha2(_joined("losses", "cell"), 256).alias("loss_sha256")))
    code = lambda name, order: F.sha2(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(order, name))), lambda r: r[name]), ","), 256)
    texts = (examples.where("trainable")
             .select("conv_id", "target_seq", "cell", F.sha2("part", 256).alias("h"), F.char_length("part").alias("size"))
             .groupBy("conv_id", "target_seq").agg(code("h", "cell").alias("e"), F.sum("size").alias("size"))
             .groupBy(F.col("conv_id").alias("c")).agg(F.sum("size").alias("formatted_chars"),
                                                      code("e", "target_seq").alias("contexts_sha256")))
    nothing = F.sha2(F.lit(""), 256)
    return (whole.join(replies, key, "left").drop("c").join(texts, key, "left").select(
        "conv_id", "n_turns", "turns_sha256", F.coalesce("loss_chars", F.lit(0)).alias("loss_chars"),
        F.coalesce("loss_sha256", nothing).alias("loss_sha256"),
        F.coalesce("formatted_chars", F.lit(0)).alias("formatted_chars"),
        F.coalesce("contexts_sha256", nothing).alias("contexts_sha256")))
