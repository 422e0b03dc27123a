"""Reply trees: root-to-leaf paths, ranked by score, formatted as conversations.

Every message points to the one that it answers.  Iterated self-joins double
the reach of each pointer, so a path of n messages takes about log2(n) rounds:
after the rounds each message knows its root, its depth and the score summed
along its path.  The leaves of a tree are ranked by that score.  The same jump
tables, applied from the longest to the shortest, unfold each chosen leaf into
the messages of its path.  Rounds are tables in the shared folder.

The template brackets turns with control strings.  Inside texts and role names
these strings are replaced by escapes, which nothing else in an escaped text
looks like, so reading back is exact.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

#: Escapes in the order in which they are put in.
ESCAPES = [
    ("\\", "\\\\"), ("<<", "\\l"), (">>", "\\g"), ("</s>", "\\e"), ("<s>", "\\s"), ("[INST]", "\\i"), ("[/INST]", "\\j"),
]
BACK = {e[1]: c for c, e in ESCAPES}
TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>|<<ROLE=(?P<role>.*?)>>(?P<other>.*?)<</ROLE>>",
    re.DOTALL,
)


def escape(text: str) -> str:
    for control, e in ESCAPES:
        text = text.replace(control, e)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: BACK[m[1]], text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation and the loss mask: (start, length) of each assistant text in code points."""
    out, spans, at = [], [], 0
    for role, text in turns:
        text = escape(text)
        if role == "user":
            part = f"[INST] {text} [/INST]"
        elif role == "assistant":
            part = f"<s>{text}</s>"
            spans.append((at + 3, len(text)))
        elif role == "system":
            part = f"<<SYS>>{text}<</SYS>>"
        else:
            part = f"<<ROLE={escape(role)}>>{text}<</ROLE>>"
        out.append(part)
        at += len(part)
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, unescaped; all of it must be turns."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["other"])))
        else:
            turns.append((m.lastgroup, unescape(m[m.lastgroup])))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def linear(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """A table of turns as reply trees: each row answers the one before it.

    Rows of one turn follow each other by role and text; none is lost.
    """
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_first(turn_col), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    rows = conversations.select(F.col(conv_col).alias("tree"), turn_col, "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(
        "tree", node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def paths(nodes: DataFrame, per_tree: int = 1, unique: bool = False) -> DataFrame:
    """(tree, leaf, rank, pos, node) of the ``per_tree`` best root-to-leaf paths of each tree.

    ``nodes`` has tree, node, parent and score.  Paths rank by summed score,
    ties by smaller leaf.  A parent that is not there makes its child a root;
    messages that only answer each other in a ring hang from no root and are on
    no path.  Null scores count as 0; a null tree is a tree of its own.  Of
    rows that repeat a node one counts; ``unique`` says that there are none.
    """
    base = nodes.select(F.coalesce(F.col("tree").cast("string"), F.lit("\0")).alias("t"), "tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    base = written(base if unique else base.dropDuplicates(["t", "node"]), "messages")
    there = base.select(F.col("t").alias("t2"), F.col("node").alias("up"))
    step = base.join(there, (F.col("t") == F.col("t2")) & (F.col("parent") == F.col("up")), "left").select("t", "node", "up", "score")
    jumps = [written(step.select("t", "node", "up", "score", F.lit(1).cast("long").alias("n")), "jumps")]
    while True:
        now = jumps[-1]
        open_now = now.filter("up is not null")
        if open_now.isEmpty():
            break
        far = now.select(F.col("t").alias("t2"), F.col("node").alias("mid"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("n").alias("n2"))
        doubled = open_now.join(far, (F.col("t") == F.col("t2")) & (F.col("up") == F.col("mid"))).select(
            "t", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"), (F.col("n") + F.col("n2")).alias("n")
        )
        made = written(doubled.unionByName(now.filter("up is null")), "jumps")
        if made.filter("up is not null").count() == open_now.count():  # what is left runs in rings
            jumps.append(made.filter("up is null"))
            break
        jumps.append(made)
    done = jumps[-1].filter("up is null").select("t", "node", "score", "n")
    parents = base.filter("parent is not null").select("t", F.col("parent").alias("node")).distinct()
    best = Window.partitionBy("t").orderBy(F.desc("score"), F.asc("node"))
    leaves = done.join(parents, ["t", "node"], "left_anti").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= per_tree)
    # a row stands for ``n`` messages upwards from ``node``; rows are halved until each stands for one
    rows = leaves.select("t", F.col("node").alias("leaf"), "rank", "node", "n")
    for k in range(len(jumps) - 2, -1, -1):
        reach = 1 << k
        up = jumps[k].filter("up is not null").select(F.col("t").alias("t2"), F.col("node").alias("mid"), "up")
        more = rows.filter(F.col("n") > reach).join(up, (F.col("t") == F.col("t2")) & (F.col("node") == F.col("mid")))
        rows = written(
            rows.select("t", "leaf", "rank", "node", F.least("n", F.lit(reach)).alias("n"))
            .unionByName(more.select("t", "leaf", "rank", F.col("up").alias("node"), (F.col("n") - reach).alias("n"))),
            "unfolding",
        )
    depth = done.select(F.col("t").alias("t3"), F.col("node").alias("node3"), F.col("n").alias("pos"))
    return (
        rows.join(depth, (F.col("t") == F.col("t3")) & (F.col("node") == F.col("node3")))
        .join(base.select(F.col("t").alias("t4"), F.col("node").alias("node4"), "tree"), (F.col("t") == F.col("t4")) & (F.col("node") == F.col("node4")))
        .select("tree", "leaf", "rank", "pos", "node")
    )


def format_paths(nodes: DataFrame, per_tree: int = 1, unique: bool = False) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans) of each chosen path.

    ``loss_spans`` (array of start and length, in code points) masks the
    assistants' texts.  Null texts and roles count as empty; a role other than
    user, assistant and system is written out.  An empty table gives an empty
    result.  One conversation is one value, so it is what a task must hold.
    """
    ship(nodes.sparkSession)
    nodes = written(nodes, "nodes")
    turns = (nodes if unique else nodes.dropDuplicates(["tree", "node"])).select(
        F.col("tree").alias("tree2"), F.col("node").alias("node2"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    told = (
        paths(nodes, per_tree, unique)
        .join(turns, F.col("tree").eqNullSafe(F.col("tree2")) & (F.col("node") == F.col("node2")))
        .groupBy("tree", "leaf", "rank")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
        .select("tree", "leaf", "rank", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    )

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            made = [format_turns(list(zip(r, t, strict=True))) for r, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            spans = [[{"start": a, "length": n} for a, n in s] for _, s in made]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([f for f, _ in made], pa.string()), pa.array(spans, span)],
                names=["tree", "leaf", "rank", "formatted", "loss_spans"],
            )

    tree, leaf = (nodes.schema[c].dataType.simpleString() for c in ("tree", "node"))
    return told.mapInArrow(run, f"tree {tree}, leaf {leaf}, rank int, formatted string, loss_spans array<struct<start: long, length: long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds: turns and the text under the loss mask, as digests."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in spans)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((len(turns), sha(told), len(loss), sha(loss), len(text)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
