"""Chat formatting as a prefix tree: conversations that share their first turns share those tokens.

Everything is DataFrame code. A node is a turn together with all turns before it, named by a chained digest, so equal
beginnings meet in one aggregation with map-side combine however many conversations share them. Depth-first order comes
from sorting the distinct conversations by their paths: a node is emitted with the first conversation that has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.common import Stash

START, STOP = "<|im_start|>", "<|im_end|>\n"
TRAINED = ("assistant",)


def escape(text: Column) -> Column:
    """Make control strings in a text harmless: a backslash goes after `<` wherever `<`, backslashes and `|` meet."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role(role: Column) -> Column:
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _plain_role(role: Column) -> Column:
    """The role back: pairs of backslashes first, from the left, then the marks of line breaks between them."""
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def prefix_tree(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, members) of the conversations in `turns`.

    nodes: node_id, parent_id, depth, offset, length, text, position, loss_start, loss_end, ancestors. The texts in
    order of offset are the token stream (a token is a code point here): every shared turn once, depth first. Tokens of
    a node have position ids from `position` on and attend to the intervals `ancestors` of the stream and, causally, to
    their own node; code points loss_start..loss_end of the text bear loss (null: none).
    members: conv_id, node_ids (the path from the root).
    Null texts and roles are empty; rows of a null conversation id are one conversation; turns are ordered by (turn,
    role, text), nulls first, and repeated rows are repeated turns. An empty table gives empty results; other columns
    are ignored.
    """
    stash = Stash(turns.sparkSession, "chat")
    t = turns.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    convs = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    head = lambda x: F.concat(F.lit(START), _role(x["role"]), F.lit("\n"))
    start = F.struct(F.lit("").alias("key"), F.lit(0).cast("long").alias("position"), F.lit("").alias("parent"), F.lit("").alias("text"), F.lit(0).cast("long").alias("head"), F.lit(False).alias("loss"))

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        key = F.md5(F.concat(last["key"], F.lit(":"), F.length(x["role"]).cast("string"), F.lit(":"), x["role"], F.lit(":"), x["text"]))
        text = F.concat(head(x), escape(x["text"]), F.lit(STOP))
        node = F.struct(key.alias("key"), (last["position"] + F.length(last["text"])).cast("long").alias("position"), last["key"].alias("parent"), text.alias("text"), F.length(head(x)).cast("long").alias("head"), x["role"].isin(*TRAINED).alias("loss"))
        return F.concat(done, F.array(node))

    convs = convs.select("conv_id", F.slice(F.aggregate("ts", F.array(start), step), 2, 1 << 30).alias("ns"))
    convs = stash.save(convs.select("conv_id", F.transform("ns", lambda n: n["key"]).alias("path"), "ns"))
    members = convs.select("conv_id", F.col("path").alias("node_ids"))
    leaf = F.element_at("path", -1)
    distinct = convs.groupBy(leaf.alias("leaf")).agg(F.first("path").alias("path"), F.first("ns").alias("ns"))
    parts = max(1, convs.rdd.getNumPartitions(), int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = stash.save(distinct.repartitionByRange(parts, "path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id()))

    each = ranked.select("rank", F.posexplode("ns").alias("depth", "n")).select("rank", "depth", "n.*")
    nodes = each.groupBy("key").agg(F.min("rank").alias("rank"), *[F.first(c).alias(c) for c in ("depth", "position", "parent", "text", "head", "loss")])
    nodes = nodes.withColumn("length", F.length("text").cast("long")).withColumn("part", F.shiftright("rank", 33))
    nodes = stash.save(nodes)
    sums = nodes.groupBy("part").agg(F.sum("length").alias("n"))  # a row for each partition of the sort
    sums = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    within = Window.partitionBy("part").orderBy("rank", "depth")
    nodes = nodes.join(F.broadcast(sums), "part").withColumn("offset", (F.col("base") + F.sum("length").over(within) - F.col("length")).cast("long"))
    nodes = stash.save(nodes.drop("base", "part"))

    # the turns before each emitted branch, from its conversation's path; contiguous ones form one interval
    path = ranked.select(F.col("rank").alias("conv_rank"), F.explode("path").alias("key")).join(nodes.select("key", "rank", "offset", "length"), "key")
    shared = path.where("rank < conv_rank").groupBy("conv_rank").agg(F.sort_array(F.collect_list(F.struct("offset", (F.col("offset") + F.col("length")).alias("stop")))).alias("spans"))
    merge = lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] == x["offset"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), x["stop"].alias("end"))))).otherwise(F.concat(done, F.array(F.struct(x["offset"].alias("start"), x["stop"].alias("end")))))
    shared = shared.select(F.col("conv_rank").alias("rank"), F.aggregate("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"), merge).alias("shared"))
    branch = nodes.groupBy("rank").agg(F.min("offset").alias("first"))
    out = nodes.join(branch, "rank").join(shared, "rank", "left")
    own = F.array(F.struct(F.col("first").alias("offset"), F.col("offset").alias("stop")))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    ancestors = F.when(F.col("offset") > F.col("first"), F.aggregate(own, F.coalesce("shared", empty), merge)).otherwise(F.coalesce("shared", empty))
    loss = F.col("loss") & (F.col("length") - F.col("head") > len(STOP))
    nodes = out.select(F.col("key").alias("node_id"), F.when(F.col("parent") != "", F.col("parent")).alias("parent_id"), "depth", "offset", "length", "text", "position", F.when(loss, F.col("head")).alias("loss_start"), F.when(loss, F.col("length") - len(STOP)).alias("loss_end"), ancestors.alias("ancestors"))
    return stash.save(nodes), members


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss_texts array<string>, formatted string): each conversation from the tree.

    The formatted text is what lies at the conversation's nodes in the stream; roles and texts are parsed out of it and
    unescaped, and loss texts are cut out by the loss mask. Distinct conversations are put together once.
    """
    leaf = F.element_at("node_ids", -1)
    paths = members.groupBy(leaf.alias("leaf")).agg(F.first("node_ids").alias("node_ids"))
    parts = paths.select("leaf", F.explode("node_ids").alias("node_id")).join(nodes.select("node_id", "depth", "text", "loss_start", "loss_end"), "node_id")
    whole = parts.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "text", "loss_start", "loss_end"))).alias("ns"))
    formatted = F.array_join(F.transform("ns", lambda n: n["text"]), "")
    loss = F.transform(F.filter("ns", lambda n: n["loss_start"].isNotNull()), lambda n: unescape(F.substring(n["text"], (n["loss_start"] + 1).cast("int"), (n["loss_end"] - n["loss_start"]).cast("int"))))
    whole = whole.select("leaf", formatted.alias("formatted"), loss.alias("loss_texts"))
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    body = lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))
    at = lambda p: F.instr(body(p), "\n")
    turn = lambda p: F.struct(_plain_role(F.substring(body(p), F.lit(1), at(p) - 1)).alias("role"), unescape(F.substring(body(p), at(p) + 1, F.length(p))).alias("text"))
    whole = whole.select("leaf", "formatted", "loss_texts", F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn).alias("turns"))
    return members.select("conv_id", leaf.alias("leaf")).join(whole, "leaf").select("conv_id", "turns", "loss_texts", "formatted")
