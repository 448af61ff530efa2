"""Chat formatting by quotation linking (DataFrame functions only).

A message's lines are read as quote levels (the number of leading ``>``); runs of one
level are passages. Each quoted passage, of whatever level, is normalised and hashed (two 64-bit hashes), whole and
line by line, and joined to the messages whose own (unquoted) text has that hash. The quotes
then leave the text, the best linked message of the shallowest level that links becomes the parent,
and messages are put into reply order: threads by their first message, turns within.

Messages are parsed once, into a stored table with a row number. Hashes, links and ranks are joined and sorted without
texts; one join by row number brings the decisions back to them.

Before the join the originals are reduced to the first message per passage, once per
conversation and once over all (there with that of the next conversation, for quotes from the first
one itself), so a passage that many messages share yields at most two rows per quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .registry import query

_MARKS = r"^(?:[ \t]*>)+"
#: "On Monday, A wrote:" just before a quote, in the corpus's four languages (fixed values).
ATTRIBUTION = r"(?i)\b(wrote|schrieb|escribió|a écrit)\b[^\n]{0,80}:[ \t]*$"
#: Shorter single lines ("ok", "thanks") do not link on their own.
MIN_LINE_CHARS = 12


def normalised(c: Column) -> Column:
    """Lower case, every run of anything but letters and digits as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def parse_quotes(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``own_text`` (without quotes and attribution lines) and ``passages``: array of
    (level, text), the runs of quoted lines in order. A null text stays null."""
    held, back = common.set_aside(messages.columns)
    text = F.col("__text")
    messages = messages.select(*held, F.col(text_col).alias("__text"))
    lines = F.split(text, r"\r?\n")
    tagged = F.transform(lines, lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _MARKS + " ?", "").alias("text")))
    m = messages.withColumn("__lines", tagged)
    level = lambda i: F.get(F.col("__lines"), i)["level"]
    n = F.size("__lines")
    m = m.withColumn("__at", F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (level(i) != level(i - 1))))
    runs = F.transform(
        F.col("__at"),
        lambda a, k: F.struct(
            level(a).alias("level"),
            F.slice(F.col("__lines"), a + 1, F.coalesce(F.get(F.col("__at"), k + 1), n) - a)["text"].alias("lines"),
        ),
    )
    m = m.withColumn("__runs", runs)
    quoted_next = lambda k: F.coalesce(F.get(F.col("__runs"), k + 1)["level"] > F.get(F.col("__runs"), k)["level"], F.lit(False))

    def without_attribution(r: Column, k: Column) -> Column:
        last = F.element_at(r["lines"], -1)
        bare = F.when(quoted_next(k) & last.rlike(ATTRIBUTION), F.slice(r["lines"], 1, F.size(r["lines"]) - 1)).otherwise(r["lines"])
        return F.struct(r["level"].alias("level"), F.btrim(F.array_join(bare, "\n"), F.lit(" \t\r\n")).alias("text"))

    m = m.withColumn("__runs", F.transform("__runs", without_attribution))
    own = F.array_join(F.filter(F.filter("__runs", lambda r: r["level"] == 0)["text"], lambda t: t != ""), "\n")
    quoted = F.filter("__runs", lambda r: (r["level"] > 0) & (normalised(r["text"]) != ""))
    plain = ~F.coalesce(text, F.lit("")).rlike(r"(?m)" + _MARKS)
    return m.select(
        *back,
        F.when(plain, text).otherwise(own).alias("own_text"),
        F.when(plain | text.isNull(), F.array().cast("array<struct<level:int,text:string>>")).otherwise(quoted).alias("passages"),
    )


def _keys(text: Column) -> Column:
    """Normalised forms under which a text can be quoted: whole, by paragraph and by line."""
    lines = F.transform(F.split(text, "\n"), normalised)
    paragraphs = F.transform(F.split(text, r"\n[ \t]*\n"), normalised)
    long = lambda x: F.length(x) >= MIN_LINE_CHARS
    whole = F.filter(F.array(normalised(text)), lambda x: x != "")
    return F.array_distinct(F.concat(whole, F.filter(paragraphs, long), F.filter(lines, long)))


def link_quotes(
    messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", originals_col: str | None = None
) -> DataFrame:
    """The input rows with the text freed of quotes, their parent, and their place.

    Added columns: ``n_quotes`` passages, ``quote_depth`` (deepest level), ``parent_conv`` /
    ``parent_turn`` (the message that a passage of the shallowest level with any original was found
    in: of its conversation an earlier turn if there is one, else the first message elsewhere that
    says it; of several the one with most matched text, then the latest turn), ``thread_turn``
    (first message of the reply chain within the conversation), ``position`` (1-based reply order:
    threads by ``thread_turn``, then turn). With ``originals_col``, that column lists every passage
    in order as (level, text, conv, turn, found), its original chosen as a parent is among what the
    passage alone matches. The text column holds the text without quotes.

    Defined cases: a null text stays null and has no quotes; a message of quotes only keeps an
    empty text; null conversations form one of their own; repeated (conversation, turn) rows are
    kept and share parent and thread; an empty table gives no rows; input columns named like an
    added column are replaced.
    """
    added = ("own_text", "passages", "n_quotes", "quote_depth", "parent_conv", "parent_turn", "thread_turn", "position", originals_col)
    names = [c for c in messages.columns if c not in added]
    held, back = common.set_aside(c for c in names if c != text_col)
    tie = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in names]).alias("tie")
    own = [F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(text_col).alias("text"), tie]
    m = parse_quotes(messages.select(*held, *own), "text").drop("text").withColumn("row", F.monotonically_increasing_id())
    m = common.stored(m)

    hashes = [F.xxhash64("norm").alias("hash"), F.xxhash64(F.lit(1), "norm").alias("check")]
    said = m.filter("own_text <> ''").select("conv", "turn", F.explode(_keys(F.col("own_text"))).alias("norm")).select("conv", "turn", *hashes)
    quoted = m.filter(F.size("passages") > 0).select("conv", "turn", F.explode("passages").alias("p"))
    quoted = quoted.select("conv", "turn", "p.level", F.xxhash64("p.text").alias("passage"), F.explode(_keys(F.col("p.text"))).alias("norm"))
    quoted = quoted.select("conv", "turn", "level", "passage", F.length("norm").alias("chars"), *hashes).groupBy("conv", "turn", "hash", "check")
    quoted = common.cut(quoted.agg(F.min("level").alias("level"), F.collect_set("passage").alias("of"), F.max("chars").alias("chars")))

    said = said.join(quoted.select("hash", "check").distinct(), ["hash", "check"], "left_semi")
    here = common.cut(said.groupBy("conv", "hash", "check").agg(F.min("turn").alias("first_turn")))
    two = here.withColumn("n", F.row_number().over(Window.partitionBy("hash", "check").orderBy(F.col("conv").asc_nulls_first()))).filter("n <= 2")
    one = lambda n: F.max(F.when(F.col("n") == n, F.struct(F.col("conv").alias("c"), F.col("first_turn").alias("t"))))
    anywhere = two.groupBy("hash", "check").agg(one(1).alias("first"), one(2).alias("second"))
    h = here.select(F.col("conv").alias("h_conv"), F.col("hash").alias("h_hash"), F.col("check").alias("h_check"), "first_turn")
    same = F.col("conv").eqNullSafe(F.col("h_conv")) & (F.col("hash") == F.col("h_hash")) & (F.col("check") == F.col("h_check"))
    found = quoted.join(h, same, "left").join(anywhere, ["hash", "check"], "left")
    earlier = F.col("first_turn") < F.col("turn")
    elsewhere = F.when(F.col("first.c").eqNullSafe(F.col("conv")), F.col("second")).otherwise(F.col("first"))
    found = found.select(
        "conv", "turn", "level", "of", "chars",
        F.when(earlier, F.struct(F.lit(1).alias("near"), F.col("conv").alias("c"), F.col("first_turn").alias("t")))
        .when(elsewhere.isNotNull(), F.struct(F.lit(0).alias("near"), elsewhere["c"].alias("c"), elsewhere["t"].alias("t"))).alias("to"),
    ).filter("to is not null")
    found = common.cut(found) if originals_col else found
    best = [F.col("to.near").alias("near"), F.col("most"), F.col("all"), F.col("to.t").alias("t"), F.col("to.c").alias("c")]
    matched = [F.max("chars").alias("most"), F.sum("chars").alias("all")]
    votes = found.groupBy("conv", "turn", "level", "to").agg(*matched)
    best_of_all = F.max(F.struct((-F.col("level")).alias("up"), *best)).alias("b")
    parents = common.cut(votes.groupBy("conv", "turn").agg(best_of_all).select(
        F.col("conv").alias("p_conv"), F.col("turn").alias("p_turn"), F.col("b.c").alias("parent_conv"), F.col("b.t").alias("parent_turn")))

    roots = thread_roots(parents.filter(F.col("p_conv").eqNullSafe(F.col("parent_conv"))).select(
        F.col("p_conv").alias("conv"), F.col("p_turn").alias("turn"), F.col("parent_turn").alias("root")))
    p = parents.join(roots, F.col("p_conv").eqNullSafe(F.col("conv")) & F.col("p_turn").eqNullSafe(F.col("turn")), "left").select(
        "p_conv", "p_turn", "parent_conv", "parent_turn", "root")
    linked = m.select("row", "conv", "turn", "tie").join(p, F.col("conv").eqNullSafe(F.col("p_conv")) & F.col("turn").eqNullSafe(F.col("p_turn")), "left")
    linked = linked.select("row", "conv", "turn", "tie", "parent_conv", "parent_turn", F.coalesce("root", F.col("turn")).alias("thread_turn"))
    order = [F.col("thread_turn").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("tie").asc()]
    placed = common.ranked(linked, ["conv"], order, prefix="place")
    originals = []
    if originals_col:
        each = found.withColumn("passage", F.explode("of")).groupBy("conv", "turn", "passage", "to").agg(*matched)
        each = each.groupBy("conv", "turn", "passage").agg(F.max(F.struct(*best)).alias("b"))
        entry = F.struct("passage", F.struct(F.col("b.c").alias("conv"), F.col("b.t").alias("turn")))
        o = each.groupBy(F.col("conv").alias("o_conv"), F.col("turn").alias("o_turn")).agg(F.map_from_entries(F.collect_list(entry)).alias("o_of"))
        placed = placed.join(o, F.col("conv").eqNullSafe(F.col("o_conv")) & F.col("turn").eqNullSafe(F.col("o_turn")), "left")

        def with_original(p: Column) -> Column:
            to = F.col("o_of")[F.xxhash64(p["text"])]
            at = [to["conv"].alias("conv"), to["turn"].alias("turn"), to.isNotNull().alias("found")]
            return F.struct(p["level"].alias("level"), p["text"].alias("text"), *at)

        originals = [F.transform("passages", with_original).alias(originals_col)]
    carried = iter(back)
    return m.drop("conv", "turn", "tie").join(placed.drop("conv", "turn", "tie"), "row").select(
        *[F.col("own_text").alias(c) if c == text_col else next(carried) for c in names],
        F.size("passages").alias("n_quotes"),
        F.coalesce(F.array_max(F.col("passages")["level"]), F.lit(0)).alias("quote_depth"),
        "parent_conv", "parent_turn", "thread_turn", *originals, F.col("place_n").alias("position"),
    )


def thread_roots(links: DataFrame) -> DataFrame:
    """(conv, turn, root) for links (conv, turn, root = parent turn): pointer doubling, so a
    chain of n replies takes log2(n) joins. A parent's turn is smaller, so there are no cycles."""
    at = common.cut(links)
    while True:
        up = at.select(F.col("conv").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("root").alias("u_root"))
        on = F.col("conv").eqNullSafe(F.col("u_conv")) & (F.col("root") == F.col("u_turn"))
        after = common.cut(at.join(up, on, "left").select(
            "conv", "turn", F.coalesce("u_root", "root").alias("root"), F.col("u_root").isNotNull().alias("moved")))
        at = after.select("conv", "turn", "root")
        if after.filter("moved").isEmpty():
            return at


@query("op6_quote_linking")
def op6_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(common.table(spark, sf_dir, "conversations"), originals_col="originals")
