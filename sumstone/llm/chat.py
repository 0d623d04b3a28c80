"""Chat formatting in prefix trees: conversations that begin alike share their first turns.

The conversations of one first turn make a tree.  Its nodes are turns, each emitted once, depth
first; a conversation is the way from the root to its node.  A node's tokens may attend to its
ancestors and to itself, so it carries the intervals of its ancestors in the tree's emission, and
its positions count on from its parent's, as if the way were a text of its own.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.llm.common import freeze, offsets_by_part, row_places

#: The control strings of the template (fixed values).
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")

_INSIDE = r"(<|\[)(/?(?:s>|INST\]|ROLE\]))"
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<s>\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>"
    r"| (?P<assistant>.*?) </s>",
    re.DOTALL,
)


def escaped(text: Column) -> Column:
    """``text`` without control strings: a backslash within each, and one before each backslash."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _INSIDE, r"$1\\$2")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def opening(role: Column) -> Column:
    """What stands before the text of a turn."""
    other = F.concat(F.lit("<s>[ROLE] "), escaped(role), F.lit(" [/ROLE] "))
    return F.when(role == "user", F.lit("<s>[INST] ")).when(role == "assistant", F.lit(" ")).otherwise(other)


def closing(role: Column) -> Column:
    return F.when(role == "user", F.lit(" [/INST]")).otherwise(F.lit(" </s>"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation, as they were given."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"not a turn at {at}")
        if found["user"] is not None:
            turns.append(("user", unescape(found["user"])))
        elif found["other"] is not None:
            turns.append((unescape(found["role"]), unescape(found["other"])))
        else:
            turns.append(("assistant", unescape(found["assistant"])))
        at = found.end()
    return turns


def conversations(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``key, turns``: the turns of each conversation in order, a null role or text as empty.

    Turns of one number go by role and text; a null number comes first.  A conversation is a row, as
    it is one training text; its turns have to fit in memory, not those of many.
    """
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    return turns.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def _path(turns: str) -> Column:
    """A digest for each turn, of its role and text."""
    return F.transform(
        F.col(turns),
        lambda t: F.md5(
            F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"])
        ),
    )


def _ids(path: str) -> Column:
    """A digest for each turn, of all turns up to it: the node of the tree."""
    none = F.array().cast("array<string>")
    chained = lambda ids, d: F.md5(F.concat(F.coalesce(F.get(ids, F.size(ids) - 1), F.lit("")), d))
    return F.aggregate(path, none, lambda ids, d: F.concat(ids, F.array(chained(ids, d))))


def format_trees(
    turns: DataFrame, key: str, turn: str, role: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """Nodes of all prefix trees, and the node at which each conversation ends.

    Nodes: ``tree, node, depth, segment, start, length, position, ancestors, role, formatted,
    loss_start, loss_length``.  ``formatted`` is the turn in the template; its code points are the
    tokens.  They stand at ``start`` in the tree's emission and at ``position`` on the way from the
    root; ``ancestors`` are the intervals (``start``, ``end``) of the emission that they may attend
    to besides themselves, root first, and ``segment`` is where the run of nodes that follow each
    other down to this one begins.  The loss interval, within ``formatted``, is an assistant's text
    and empty for other roles.

    Members: ``key, tree, node``.  Conversations alike in all turns end at one node; one that is the
    beginning of another ends above it.  No conversations give no nodes.

    Paths of turn digests in lexicographic order visit the trees depth first.  They are sorted over
    all tasks, and each adds the nodes that its predecessor does not share, so a first turn common to
    very many conversations is dealt to many tasks; places in a tree are sums by task first.
    """
    own = conversations(turns, key, turn, role, text).withColumn("path", _path("turns"))
    own = freeze(own.withColumn("ids", _ids("path")), "conversations")
    distinct = own.groupBy("path").agg(F.first("turns").alias("turns"), F.first("ids").alias("ids"))
    ordered = distinct.repartitionByRange("path").sortWithinPartitions("path")
    part, seq = row_places()
    ordered = freeze(ordered.select("*", part, seq), "paths")

    # The last path of the tasks before: one row a task.
    last = ordered.groupBy("_part").agg(F.max("path").alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("_part", F.max("_last").over(earlier).alias("_before"))
    in_part = Window.partitionBy("_part").orderBy("_seq")
    prior = F.coalesce(F.lag("path").over(in_part), "_before", F.array().cast("array<string>"))
    branches = ordered.join(before, "_part").withColumn("_prior", prior)
    alike = F.transform("path", lambda d, i: F.coalesce(F.get("_prior", i), F.lit("")) == d)
    differs = F.array_position(alike, F.lit(False))
    shared = F.when(differs > 0, differs - 1).otherwise(F.size("path"))
    branches = branches.withColumn("_shared", shared.cast("int"))
    branches = branches.withColumn("branch", F.element_at("ids", -1))

    fresh = branches.select(
        F.col("path")[0].alias("tree"), "branch", "ids", "_shared", "_part", "_seq",
        F.posexplode("turns").alias("depth", "t"),
    ).filter("depth >= _shared")
    head, tail = opening(F.col("t.role")), closing(F.col("t.role"))
    body = escaped(F.col("t.text"))
    assistant = F.col("t.role") == "assistant"
    nodes = fresh.select(
        "tree", "branch", "depth", "_part", "_seq",
        F.get("ids", F.col("depth")).alias("node"),
        F.col("t.role").alias("role"),
        F.concat(head, body, tail).alias("formatted"),
        F.when(assistant, F.length(head)).otherwise(0).alias("loss_start"),
        F.when(assistant, F.length(body)).otherwise(0).alias("loss_length"),
    ).withColumn("length", F.length("formatted").cast("long"))
    nodes = freeze(nodes, "nodes")

    parts = nodes.groupBy("tree", "_part").agg(F.sum("length").alias("_sum"))
    ahead = offsets_by_part(parts, ["tree"], "_sum").drop("_sum")
    so_far = Window.partitionBy("tree", "_part").orderBy("_seq", "depth")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("length").over(so_far), F.lit(0))
    placed = nodes.join(ahead, ["tree", "_part"]).withColumn("start", start)
    segment = F.min("start").over(Window.partitionBy("tree", "_part", "_seq"))
    placed = freeze(placed.withColumn("segment", segment).drop("_before"), "placed")

    # A branch leaves its ancestors' segments in turn: of each it has the beginning.
    spans = placed.select(
        F.col("node").alias("_above"), "segment", (F.col("start") + F.col("length")).alias("end"),
        "length",
    )
    up = branches.select("branch", F.explode(F.slice("ids", 1, F.col("_shared"))).alias("_above"))
    reached = up.join(spans, "_above").groupBy("branch", "segment").agg(
        F.max("end").alias("end"), F.sum("length").alias("_sum")
    )
    span = F.struct(F.col("segment").alias("start"), "end")
    above = reached.groupBy("branch").agg(
        F.sort_array(F.collect_list(span)).alias("_spans"), F.sum("_sum").alias("_deep")
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    own_run = F.array(F.struct(F.col("segment").alias("start"), F.col("start").alias("end")))
    ancestors = F.concat(
        F.coalesce("_spans", none), F.when(F.col("start") > F.col("segment"), own_run).otherwise(none)
    )
    position = F.coalesce("_deep", F.lit(0)) + F.col("start") - F.col("segment")
    out = placed.join(above, "branch", "left").select(
        "tree", "node", "depth", "segment", "start", "length", position.alias("position"),
        ancestors.alias("ancestors"), "role", "formatted", "loss_start", "loss_length",
    )
    members = own.select(key, F.col("path")[0].alias("tree"), F.element_at("ids", -1).alias("node"))
    return freeze(out, "trees"), members


def read_back(nodes: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``key, formatted, loss`` of each conversation, put together from the emitted nodes.

    The way to a node is read off its ancestor intervals: each is the beginning of a segment of the
    tree's emission.  ``loss`` holds the intervals of the formatted conversation under the loss mask.
    Only nodes at which a conversation ends are put together, once however many end there.
    """
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    others = F.filter("ancestors", lambda a: a["start"] != F.col("segment"))
    own = F.array(
        F.struct(F.col("segment").alias("start"), (F.col("start") + F.col("length")).alias("end"))
    )
    way = wanted.select("tree", "node", F.explode(F.concat(others, own)).alias("_at"))
    way = way.select("tree", "node", F.col("_at.start").alias("segment"), F.col("_at.end").alias("end"))
    piece = F.struct("start", "position", "formatted", "loss_start", "loss_length")
    segments = nodes.groupBy("tree", "segment").agg(F.collect_list(piece).alias("_run"))
    found = way.join(segments, ["tree", "segment"])
    found = found.withColumn("_run", F.filter("_run", lambda p: p["start"] < F.col("end")))
    pieces = F.sort_array(F.flatten(F.collect_list("_run"))).alias("_pieces")
    whole = found.groupBy("node").agg(pieces)
    begin = lambda p: p["position"] + p["loss_start"]
    loss = F.transform(
        F.filter("_pieces", lambda p: p["loss_length"] > 0),
        lambda p: F.struct(
            begin(p).alias("start"), (begin(p) + p["loss_length"]).alias("end")
        ),
    )
    formatted = F.array_join(F.transform("_pieces", lambda p: p["formatted"]), "")
    whole = whole.select("node", formatted.alias("formatted"), loss.alias("loss"))
    return members.select(key, "node").join(whole, "node").drop("node")


def digests(formatted: pd.Series, loss: pd.Series) -> pd.DataFrame:
    """What a formatted conversation says, and what lies under its loss mask."""
    out = []
    for text, spans in zip(formatted, loss):
        turns = parse(text)
        said = "".join(f"{role}\n{content}\n" for role, content in turns)
        learned = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
        out.append(
            (
                len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                hashlib.sha256(learned.encode()).hexdigest(), len(text),
            )
        )
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pd.DataFrame(out, columns=names)


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
