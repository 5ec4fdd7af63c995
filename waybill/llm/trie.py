"""The prefix trie of conversations, measured along its Euler tour.

A node is a distinct sequence of first turns, and its members are the conversations that
begin with it.  Nodes of one depth have no members in common, so (depth, smallest member)
names a node.  Sequences are told apart by 128 bits: sums, over the turns, of hashes of
place, role and text, which is a running sum along a conversation.

The tour goes into a node, through its children by smallest member, and out again.  An
arc knows the next one: from going in, to the first child or out again; from going out,
to the next sibling or out of the parent.  ``listrank`` gives every arc the sums over all
arcs ahead of it; what a subtree holds is the difference between a node's two arcs.

Texts stay where they are read: only their digests and numbers of words travel.  Long
conversations and nodes with very many children are cut as ``skew.with_running`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm import listrank
from waybill.llm.digests import EMPTY, joined_sha256
from waybill.llm.store import only, stored
from waybill.operators.skew import Running, with_running

LANES = ["s0", "s1", "s2", "s3"]
KEY = ["depth", *LANES]
WORD = r"[^\x20\x09-\x0D]+"


def turns_of(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conv_id, place, role, digest, words): every conversation's turns, numbered from 1.

    They are ordered by ``turn``, null first; ties by role and the MD5 of the text, so rows
    that repeat are turns of their own.  A null role or text is empty.  Rows without a
    conv_id belong to no conversation and are left out.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    rows = only(conversations, conv_id, turn, role, text).filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.md5(said.cast("binary")).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    )
    chunk = [F.col("turn"), F.col("role"), F.substring("digest", 1, 3)]
    return with_running(rows, "conv_id", ["turn", "role", "digest"], chunk, [Running("place", "count")]).select(
        "conv_id", "place", "role", "digest", "words"
    )


def branched(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first ``shared`` turns of the conversation ``base`` in
    place of its own first ``shared`` ones: (conv_id, place, role, digest, words), and (conv_id) of all.

    ``base`` and ``shared`` (at most ``most``) are of conv_id.  An absent base has no turns;
    a short one gives those it has.
    """
    first = F.struct("place", "role", "digest", "words")
    kept = stored(turns)
    convs = kept.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("place") <= most, first))).alias("head")
    )
    convs = stored(convs.select("conv_id", base.alias("base"), shared.cast("int").alias("shared"), "head"))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("given"))
    plan = convs.select("conv_id", "base", "shared").join(heads, "base", "left").select(
        "conv_id", "shared", F.slice(F.coalesce("given", F.array().cast(heads.schema["given"].dataType)), F.lit(1), F.col("shared")).alias("given")
    )
    plan = stored(plan)
    begins = plan.select("conv_id", F.explode("given").alias("g")).select("conv_id", "g.*")
    goes_on = kept.join(plan.select("conv_id", "shared", F.size("given").alias("given")), "conv_id").filter(
        F.col("place") > F.col("shared")
    ).select("conv_id", (F.col("place") - F.col("shared") + F.col("given")).alias("place"), "role", "digest", "words")
    return begins.unionByName(goes_on), plan.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, s0..s3, up0..up3, words): what each turn's sequence is, and the one before it."""
    one, two = F.xxhash64(F.lit(1), "place", "role", "digest"), F.xxhash64(F.lit(2), "digest", "place", "role")
    low = F.lit((1 << 32) - 1)
    parts = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32)]
    rows = turns.select("conv_id", F.col("place").alias("depth"), "words", *[p.alias(f"p{i}") for i, p in enumerate(parts)])
    summed = with_running(
        rows, "conv_id", ["depth"], [F.col("depth")],
        [Running(lane, "sum", F.col(f"p{i}")) for i, lane in enumerate(LANES)],
    )
    return summed.select(
        "conv_id", "depth", *LANES, *[(F.col(s) - F.col(f"p{i}")).alias(f"up{i}") for i, s in enumerate(LANES)], "words"
    )


def _nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, s0..s3, conv_id, parent_conv_id, n_convs, words) of every node, the root included."""
    zero = F.lit(0).cast("long")
    ups = [f"up{i}" for i in range(len(LANES))]
    inner = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
        *[F.min(u).alias(u) for u in ups],
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), *[zero.alias(s) for s in LANES], "conv_id", "n_convs", zero.alias("words"),
        *[F.lit(None).cast("long").alias(u) for u in ups],
    )
    nodes = stored(inner.unionByName(root))
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), *[F.col(s).alias(u) for s, u in zip(LANES, ups)],
        F.col("conv_id").alias("parent_conv_id"),
    )
    # the root's children may be most of all nodes; they need no join
    deep = nodes.filter("depth > 1").join(above.filter("depth > 1"), ["depth", *ups])
    found = nodes.filter("depth = 0").select("conv_id").first()
    least = F.lit(found["conv_id"] if found else None).cast("long")
    top = nodes.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, least))
    names = ["depth", *LANES, "conv_id", "n_convs", "words", "parent_conv_id"]
    return deep.select(*names).unionByName(top.select(*names))


def _arcs(nodes: DataFrame) -> DataFrame:
    """The tour as a linked list: arc (conv_id, 2 * depth) goes in, (conv_id, 2 * depth + 1) out."""
    family = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(
        F.min("conv_id").alias("first_child"), F.count(F.lit(1)).alias("n_children")
    )
    parent = F.struct("depth", "parent_conv_id")
    ranked = stored(with_running(
        nodes.withColumn("parent", parent), "parent", ["conv_id"], [F.col("conv_id")], [Running("nth", "count")]
    ).select("depth", "conv_id", "parent_conv_id", "nth"))
    after = ranked.select(
        "depth", "parent_conv_id", (F.col("nth") - 1).alias("nth"), F.col("conv_id").alias("sibling")
    ).filter("nth > 0")
    ranked = ranked.join(after, ["depth", "parent_conv_id", "nth"], "left").select("depth", "conv_id", "sibling")
    return nodes.join(ranked, ["depth", "conv_id"]).join(family, ["depth", "conv_id"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))
    )


def measured(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Per node: s0..s3, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, and its interval (enter, leave) of the tour, which holds those of its subtree.

    ``rows`` are of ``prefixes``, ``convs`` all conv_ids.  Without conversations there are no nodes.
    """
    nodes = stored(_arcs(stored(_nodes(rows, convs))))
    code = 2 * F.col("depth")
    no = F.lit(0).cast("long")
    child = F.col("first_child").isNotNull()
    enter = F.struct(
        F.col("conv_id").alias("a"), code.alias("b"),
        F.when(child, F.col("first_child")).otherwise(F.col("conv_id")).alias("next_a"),
        F.when(child, code + 2).otherwise(code + 1).alias("next_b"),
        F.lit(1).cast("long").alias("w0"), F.when(child, 0).otherwise(1).cast("long").alias("w1"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("w2"),
    )
    leave = F.struct(
        F.col("conv_id").alias("a"), (code + 1).alias("b"),
        F.coalesce("sibling", "parent_conv_id", "conv_id").alias("next_a"),
        F.when(F.col("sibling").isNotNull(), code).when(F.col("depth") > 0, code - 1).otherwise(-1).alias("next_b"),
        F.lit(1).cast("long").alias("w0"), no.alias("w1"), no.alias("w2"),
    )
    links = nodes.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*")
    sums = listrank.prefix_sums(links, 3)
    out = F.col("b") % 2 == 1
    within = sums.groupBy(F.col("a").alias("conv_id"), F.floor(F.col("b") / 2).cast("long").alias("depth")).agg(
        F.max(F.when(~out, F.col("o0"))).alias("enter"), F.max(F.when(out, F.col("o0"))).alias("leave"),
        F.sum(F.when(out, F.col("o1")).otherwise(-F.col("o1"))).alias("n_leaves"),
        F.sum(F.when(out, F.col("o2")).otherwise(-F.col("o2"))).alias("saved_tokens"),
    )
    return nodes.join(within, ["conv_id", "depth"]).select(
        *LANES, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "enter", "leave"
    )


def ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, s0..s3, member): the node at which each conversation ends."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("k"))
    zero = F.lit(0).cast("long")
    return convs.join(last, "conv_id", "left").select(
        *[F.coalesce(F.col(f"k.{c}"), zero).alias(c) for c in KEY], F.col("conv_id").alias("member")
    )


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (see ``turns_of``): the columns of
    ``measured`` but for the sums, and ends_sha256, the digest of the conversations that end there.

    ``convs`` holds every conv_id once; those without turns are members of the root alone.
    """
    rows = stored(prefixes(turns))
    nodes = measured(rows, convs)
    ended = joined_sha256(ends(rows, convs), KEY, "member", "ends_sha256")
    return nodes.join(ended, KEY, "left").drop(*LANES).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))
    )
