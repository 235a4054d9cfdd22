"""Chat formatting by quotation linking (operator 2), in DataFrame functions alone.

Lines that open with ``>`` marks are quoted, as deep as they have marks. A quoted line, normalised and
hashed, is joined to the messages that have it as a line one level less deep, or that have its words in
a passage wrapped otherwise; the message that most of a reply's outermost quotes come from is what it
replies to. Where none of these links, deeper quotes decide: the message that carried them, or else
their author. A message without any link replies to the turn before it. What results is a forest, given in reply order, with every body free of quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.staging import staged

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: A line of more different profiles than this is looked through only where others do not decide.
FEW = 64
#: Words on end that are hashed together, so that a passage is known however its lines are wrapped.
SHINGLE = 3


def quote_depth(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[^>]", ""))


def normalised(line: Column) -> Column:
    """Without marks; lower case; words with one space between; without punctuation at the ends."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " ")
    return F.regexp_replace(bare, r"^[\s\p{Punct}]+|[\s\p{Punct}]+$", "")


def _runs(messages: DataFrame) -> DataFrame:
    """conv_id, turn, d, ns, ws, w: each run of lines of one depth (lines of marks alone aside), as normalised
    lines, the words of each, and all its words."""
    line = F.transform(F.split("text", "\r?\n"), lambda x: F.struct(quote_depth(x).alias("d"), normalised(x).alias("n")))
    out = messages.select("conv_id", "turn", F.filter(line, lambda x: x.n != "").alias("l")).where("size(l) > 0")
    starts = F.filter(F.sequence(F.lit(0), F.size("l") - 1), lambda i: (i == 0) | (F.col("l")[i].d != F.col("l")[F.greatest(i - 1, F.lit(0))].d))
    out = out.withColumn("a", starts).withColumn("b", F.concat(F.slice("a", F.lit(2), F.size("a")), F.array(F.size("l"))))
    run = F.zip_with("a", "b", lambda a, b: F.slice("l", a + 1, b - a))
    out = out.select("conv_id", "turn", F.explode(run).alias("r")).select("conv_id", "turn", F.col("r")[0].d.alias("d"), F.col("r.n").alias("ns"))
    # a line's end is no mark in the passage, so each word goes without punctuation at its ends
    bare = lambda n: F.split(F.btrim(F.regexp_replace(n, r"(?<![^\s])\p{Punct}+|\p{Punct}+(?![^\s])", "")), r"\s+")
    out = out.select("*", F.explode(F.array(F.transform("ns", bare))).alias("ws"))
    return out.select("*", F.explode(F.array(F.flatten("ws"))).alias("w"))


def _shingles() -> Column:
    """Hashes of each SHINGLE words on end of w, or of all where there are fewer."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, SHINGLE)))


def _asked(runs: DataFrame) -> DataFrame:
    """conv_id, turn, level, u, h, words, s, count: quoted lines u with the hashes h that they may stand by.

    s is the depth that they are looked for at: 0 for a line of depth 1 (level 1); for a deeper one the depth
    less one, where the message that carried it has it (level 2), and 0, where its author has it (level 3).
    words are the shingles that must all stand in a message for it to have h, or null where only the line may. A
    line of under SHINGLE words takes words of its passage, before it if there are, and then stands by either.
    """
    ends = F.aggregate("ws", F.array(F.lit(0)), lambda t, x: F.concat(t, F.array(F.element_at(t, -1) + F.size(x))))
    held = runs.where("d > 0").select("conv_id", "turn", "d", F.explode(F.array(F.struct("ns", ends.alias("ends"), _shingles().alias("sh"), F.size("w").alias("size")))).alias("r"))

    def unit(j: Column) -> Column:
        a, b = F.col("r.ends")[j], F.col("r.ends")[j + 1]
        start = F.greatest(F.lit(0), F.least(a, b - SHINGLE))
        end = F.least(F.col("r.size"), F.greatest(b, start + SHINGLE))
        words = F.slice(F.col("r.sh"), start + 1, F.greatest(F.lit(1), end - SHINGLE - start + 1))
        return F.struct(F.col("r.ns")[j].alias("n"), F.array_sort(F.array_distinct(words)).alias("words"), (b - a < SHINGLE).alias("short"))

    held = held.select("conv_id", "turn", "d", F.explode(F.transform(F.sequence(F.lit(0), F.size("r.ns") - 1), unit)).alias("x"))
    levels = F.when(F.col("d") == 1, F.array(F.struct(F.lit(1).alias("level"), F.lit(0).alias("s")))).otherwise(
        F.array(F.struct(F.lit(2).alias("level"), (F.col("d") - 1).alias("s")), F.struct(F.lit(3).alias("level"), F.lit(0).alias("s")))
    )
    held = held.select("conv_id", "turn", F.explode(levels).alias("k"), "x.*").select("conv_id", "turn", "k.level", "k.s", "n", "words", "short")
    held = held.groupBy("conv_id", "turn", "level", "s", "n", "words", "short").count()
    own, none = F.xxhash64(F.xxhash64("n"), "s"), F.lit(None).cast("array<long>")
    ways = F.when(F.col("short"), F.array(F.struct(own.alias("h"), none.alias("words")), F.struct(F.xxhash64(F.lit("words"), "words", "s").alias("h"), F.col("words").alias("words")))).otherwise(
        F.array(F.struct(own.alias("h"), F.col("words").alias("words")))
    )
    return held.select("conv_id", "turn", "level", F.xxhash64("n", "words", "s").alias("u"), "s", "count", F.explode(ways).alias("y")).select("conv_id", "turn", "level", "u", "y.h", "y.words", "s", "count")


def _standing_words(asked: DataFrame, messages: DataFrame) -> DataFrame:
    """h, conv_id, turn: the messages that have all shingles of h in their passages of its depth, however wrapped.

    Messages are looked up by the shingle of h that the fewest have, and then asked for the others.
    """
    units = asked.where("words is not null").select("h", "s", "words").dropDuplicates(["h"])
    each = units.select("h", "s", F.size("words").alias("of"), F.explode("words").alias("g"))
    source = _runs(messages).select("conv_id", "turn", F.col("d").alias("s"), F.explode(_shingles()).alias("g"))
    source = staged(source.join(each.select("s", "g").distinct(), ["s", "g"], "left_semi").distinct())
    rarest = each.join(source.groupBy("s", "g").count(), ["s", "g"]).groupBy("h", "s", "of").agg(F.min(F.struct("count", "g")).alias("m"), F.count(F.lit(1)).alias("k"))
    found = rarest.where("k = of").select("h", "s", "of", F.col("m.g").alias("g")).join(source, ["s", "g"]).select("h", "s", "of", "conv_id", "turn")
    every = found.join(each.select("h", "g"), "h").join(source, ["s", "g", "conv_id", "turn"])
    return every.groupBy("h", "of", "conv_id", "turn").count().where(F.col("count") == F.col("of")).select("h", "conv_id", "turn")


def _linked_lines(quoted: DataFrame, stands: DataFrame) -> DataFrame:
    """The rows of ``quoted`` (conv_id, turn, level, u, h, count) whose line u stands by any of its hashes h in an
    earlier message, with ``same``: one of the same conversation."""
    line = ["conv_id", "turn", "level", "u"]
    source = stands.groupBy("h", F.col("parent_conv").alias("conv_id")).agg(F.min("parent_turn").alias("t"))
    near = quoted.join(source, ["conv_id", "h"]).where("t < turn").select(*line).distinct()
    least = source.groupBy("h").agg(F.min(F.struct("t", "conv_id")).alias("s"))
    rest = quoted.join(near, line, "left_anti")
    far = rest.join(least, "h").where(F.col("s") < F.struct(F.col("turn").alias("t"), "conv_id")).select(*line).distinct()
    return quoted.join(near.withColumn("same", F.lit(True)).union(far.withColumn("same", F.lit(False))), line)


def _most_of_lines(links: DataFrame, stands: DataFrame) -> DataFrame:
    """conv_id, turn, p (parent_conv, parent_turn): the earlier message in which most of a reply's linked lines stand,
    then the earliest; one of the reply's own conversation if any line stands in one.

    Of messages with the same quoted lines only the earliest can win, so candidates are such profiles. A reply
    meets those that share a line of few profiles with it; all its lines count for them. Only where the lines of
    many profiles might outvote these (they are as many as the best's votes, or more) are profiles of such lines
    alone, which are few, looked through too.
    """
    reply, scope = ["conv_id", "turn"], ["same", "g"]
    own = links.groupBy(*reply).agg(F.max("same").alias("same"))
    asked = links.join(own, [*reply, "same"]).withColumn("g", F.when(F.col("same"), F.col("conv_id")).otherwise(F.lit(0)))
    asked = staged(asked.select(*scope, *reply, "u", "h", "count"))
    wanted = asked.select(*scope, "h").distinct()
    near = stands.withColumn("same", F.lit(True)).withColumn("g", F.col("parent_conv"))
    far = stands.withColumn("same", F.lit(False)).withColumn("g", F.lit(0).cast("long"))
    source = near.union(far).join(wanted, [*scope, "h"], "left_semi")

    def profiles(rows: DataFrame, by: list[str], first: Column) -> DataFrame:
        """same, g, p, e, h: the lines h of each set of lines p, and the earliest message e that has it."""
        sets = rows.groupBy(*scope, *by).agg(F.array_sort(F.collect_set("h")).alias("hs"), F.min(first).alias("e"))
        sets = sets.groupBy(*scope, "hs").agg(F.min("e").alias("e"))
        return sets.select(*scope, F.xxhash64("hs").alias("p"), "e", F.explode("hs").alias("h"))

    met = staged(profiles(source, ["parent_conv", "parent_turn"], F.struct(F.col("parent_turn").alias("turn"), F.col("parent_conv").alias("conv_id"))))
    many = staged(met.groupBy(*scope, "h").count().where(F.col("count") > FEW).select(*scope, "h"))
    earlier = F.col("e") < F.struct("turn", "conv_id")
    pair = [*scope, *reply, "p", "e"]
    rare = asked.join(many, [*scope, "h"], "left_anti").join(met, [*scope, "h"]).where(earlier).select(*pair, "u", "count")
    often = staged(asked.join(many, [*scope, "h"], "left_semi"))
    more = rare.select(*pair).distinct().join(often, [*scope, *reply]).join(met.select(*scope, "p", "h"), [*scope, "p", "h"], "left_semi").select(*pair, "u", "count")
    votes = staged(rare.union(more).distinct().groupBy(*pair).agg(F.sum("count").alias("votes")))
    best = votes.groupBy(*reply).agg(F.max("votes").alias("best"))
    beyond = often.select(*reply, "u", "count").distinct().groupBy(*reply).agg(F.sum("count").alias("most")).join(best, reply, "left").where("best is null or most >= best").select(*reply)
    common = profiles(met.join(many, [*scope, "h"], "left_semi"), ["p"], F.col("e"))
    rest = often.join(beyond, reply, "left_semi").join(common, [*scope, "h"]).where(earlier).select(*pair, "u", "count").distinct().groupBy(*pair).agg(F.sum("count").alias("votes"))
    rank = F.struct("votes", (-F.col("e.turn")).alias("t"), (-F.col("e.conv_id")).alias("c"))
    parent = F.struct(F.col("e.conv_id").alias("parent_conv"), F.col("e.turn").alias("parent_turn"))
    return votes.union(rest).groupBy(*reply).agg(F.max_by(parent, rank).alias("p"))


def _in_ranges(rows: DataFrame, *order: str) -> DataFrame:
    """The rows, staged, with ``part``: the number of their range in this order. Ranges hold about equal shares of
    all rows, however many a thread or a conversation has; only a row for each range goes across one of those."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))


def _numbered(rows: DataFrame, group: list[str], order: list[str], number: str) -> DataFrame:
    """Adds each row's number, from 1, in its group, by ranges of ``part``."""
    inside, across = Window.partitionBy(*group, "part").orderBy(*order), Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*group, "part").count().select(*group, "part", F.coalesce(F.sum("count").over(across), F.lit(0)).alias("_before"))
    out = rows.withColumn(number, F.row_number().over(inside)).join(counts, [*group, "part"])
    return out.withColumn(number, (F.col(number) + F.col("_before")).cast("int")).drop("_before")


def _carried(rows: DataFrame, value: str) -> DataFrame:
    """The largest ``value`` of a conversation up to each turn, itself included, by ranges of ``part``."""
    inside, across = Window.partitionBy("conv_id", "part").orderBy("turn"), Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("conv_id", "part").agg(F.max(value).alias("_m")).select("conv_id", "part", F.max("_m").over(across).alias("_m"))
    out = rows.withColumn(value, F.max(value).over(inside)).join(ends, ["conv_id", "part"])
    return out.withColumn(value, F.greatest(value, "_m")).drop("_m")


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, n_quoted, deepest, n_linked, parent_conv, parent_turn, root_conv, root_turn,
    depth, position: one row for each row of ``messages`` (conv_id, turn, role, text).

    The body is the text without quoted lines (null stays null). n_quoted counts quoted lines with anything
    in them, deepest their depth, n_linked those at depth 1 that stand in an earlier message. Only where none
    does, deeper lines give the parent: as lines of depth less one, or else of depth 0. Earlier is by (turn,
    conv_id), so links never form a ring. The same conversation goes before others, then the message
    with most of the lines, then the earliest. A message with a null conv_id or turn stands alone. Rows
    with the same conv_id and turn are one message whose lines count together. position numbers the
    messages of a thread from 1, parents before replies, by (depth, turn, conv_id).
    """
    own = messages.select("conv_id", "turn", "role", "text")
    line = F.col("line")
    lines = own.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(F.split(F.coalesce("text", F.lit("")), "\r?\n")).alias("line"))
    lines = lines.select("conv_id", "turn", quote_depth(line).alias("d"), normalised(line).alias("n")).where("n <> ''").select("conv_id", "turn", "d", F.xxhash64("n").alias("h"))
    lines = staged(lines)
    quoted = lines.where("d > 0")
    asked = staged(_asked(_runs(own.where(F.col("text").rlike(r"(?m)^[ \t]*>")).where("conv_id is not null and turn is not null"))))
    stands = lines.select(F.xxhash64("h", "d").alias("h"), "conv_id", "turn").join(asked.select("h").distinct(), "h", "left_semi")
    stands = staged(stands.union(_standing_words(asked, own.where("conv_id is not null and turn is not null"))).distinct().toDF("h", "parent_conv", "parent_turn"))
    links = staged(_linked_lines(asked.drop("words", "s"), stands))
    n_linked = links.where("level = 1").select("conv_id", "turn", "u", "count").distinct().groupBy("conv_id", "turn").agg(F.sum("count").alias("n_linked"))
    first = links.groupBy("conv_id", "turn").agg(F.min("level").alias("level"))
    links = links.join(first, ["conv_id", "turn", "level"]).drop("level")
    chosen = _most_of_lines(links, stands).join(n_linked, ["conv_id", "turn"], "left")
    stats = quoted.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_quoted"), F.max("d").alias("deepest"))

    nodes = own.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    nodes = _numbered(_in_ranges(nodes, "conv_id", "turn"), ["conv_id"], ["turn"], "rn")
    # the turn before: the last one up to the row before
    nodes = nodes.withColumn("prev", F.lag("turn").over(Window.partitionBy("conv_id", "part").orderBy("turn")))
    last = nodes.groupBy("conv_id", "part").agg(F.max("turn").alias("last"))
    last = last.select("conv_id", "part", F.lag("last").over(Window.partitionBy("conv_id").orderBy("part")).alias("last"))
    nodes = nodes.join(last, ["conv_id", "part"]).withColumn("prev", F.coalesce("prev", "last"))
    nodes = nodes.join(chosen, ["conv_id", "turn"], "left").join(stats, ["conv_id", "turn"], "left")
    up_conv = F.coalesce("p.parent_conv", F.when(F.col("prev").isNotNull(), F.col("conv_id")))
    nodes = nodes.select("conv_id", "turn", "part", "rn", up_conv.alias("parent_conv"), F.coalesce("p.parent_turn", "prev").alias("parent_turn"), "prev", "n_linked", "n_quoted", "deepest")
    nodes = staged(nodes)

    # A run: a message and those after it that each reply to the turn before. Its place in the run is a window's
    # count, so only heads of runs that reply to something else need their chains followed.
    linked_head = F.col("parent_turn").isNotNull() & ~(F.col("parent_conv").eqNullSafe(F.col("conv_id")) & F.col("parent_turn").eqNullSafe(F.col("prev")))
    head = F.col("prev").isNull() | linked_head
    runs = _carried(nodes.withColumn("h", F.when(head, F.struct("rn", "turn"))).withColumn("link", linked_head), "h")
    runs = runs.select("conv_id", "turn", "parent_conv", "parent_turn", "link", F.col("h.turn").alias("ht"), (F.col("rn") - F.col("h.rn")).alias("off"))
    runs = staged(runs)
    target = runs.select(F.col("conv_id").alias("parent_conv"), F.col("turn").alias("parent_turn"), F.col("conv_id").alias("rc"), F.col("ht").alias("rt"), (F.col("off") + 1).alias("depth"))
    up = staged(runs.where("link").select("conv_id", "turn", "parent_conv", "parent_turn").join(target, ["parent_conv", "parent_turn"]).select("conv_id", "turn", "rc", "rt", "depth"))
    while True:
        # pointer jumping: after k rounds a pointer spans 2 ** k runs, and those at a root stand still
        on = up.select(F.col("conv_id").alias("rc"), F.col("turn").alias("rt"), F.col("rc").alias("rc2"), F.col("rt").alias("rt2"), F.col("depth").alias("more"))
        moved = staged(up.join(on, ["rc", "rt"]).select("conv_id", "turn", F.col("rc2").alias("rc"), F.col("rt2").alias("rt"), (F.col("depth") + F.col("more")).alias("depth")))
        if moved.isEmpty():
            break
        up = staged(up.join(moved.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti").union(moved))
    top = up.select("conv_id", F.col("turn").alias("ht"), "rc", "rt", F.col("depth").alias("above"))
    up = runs.join(top, ["conv_id", "ht"], "left").select(
        "conv_id", "turn", F.coalesce("rc", "conv_id").alias("rc"), F.coalesce("rt", "ht").alias("rt"), (F.coalesce("above", F.lit(0)) + F.col("off")).alias("depth")
    )
    up = up.select("conv_id", "turn", F.col("rc").alias("root_conv"), F.col("rt").alias("root_turn"), "depth")
    order = ["depth", "turn", "conv_id"]
    placed = _numbered(_in_ranges(up, "root_conv", "root_turn", *order), ["root_conv", "root_turn"], order, "position").drop("part")
    placed = placed.join(nodes.drop("prev", "part", "rn"), ["conv_id", "turn"])

    kept = F.filter(F.split("text", "\r?\n"), lambda x: quote_depth(x) == 0)
    body = F.when(F.col("text").isNotNull(), F.btrim(F.array_join(kept, "\n"), F.lit(" \t\r\n")))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = own.withColumn("body", body).drop("text").join(placed, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "body", count("n_quoted"), count("deepest"), count("n_linked"), "parent_conv", "parent_turn", "root_conv", "root_turn", count("depth"), F.coalesce("position", F.lit(1)).alias("position"))


def conversations(messages: DataFrame) -> DataFrame:
    """root_conv, root_turn, turns: each thread as one array of (role, content) in reply order."""
    rows = linked(messages).where("root_turn is not null")
    item = F.struct("position", "conv_id", "turn", "role", F.col("body").alias("content"))
    turns = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x.role.alias("role"), x.content.alias("content")))
    return rows.groupBy("root_conv", "root_turn").agg(turns.alias("turns"))
