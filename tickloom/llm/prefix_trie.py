"""The prefix trie of conversations, with subtree totals by centroid decomposition.

Conversations that begin with the same turns share nodes: a node at depth d is a distinct sequence of d
turns (role and text), the root is the empty one, and a conversation is a member of every node on its
way. A node is named by its smallest member and its depth, so a parent edge is (owner, depth) to
(parent's owner, depth - 1).

Totals over subtrees come from a centroid decomposition of these edges. A node weighs as many
conversations as it has members, so its subtree's weight, the turns that its members have left, is known
from one aggregate. In every component the deepest node with more than half of the weight is the
centroid. What lies below it, and its own value, is one sum by component; the sum goes to the centroid and
to each node on the way from it to the component's top, and the same nodes lose the centroid's weight.
The component falls into the part above the centroid and one part below each of its children, each of
at most half the weight. So a node is visited once a round, and rounds grow with the logarithm of the
turns, whatever the depth. Components of up to `SMALL` nodes go through the same steps inside a task.

Sequences are told apart by 128 bits: four sums, over the turns, of 32 bits of a hash of position and
turn (the SHA-256 of role and text). A sum runs along a conversation in blocks of `BLOCK` turns, whose
totals are carried on, so a conversation with a third of all turns is no hot task. Its turns are
numbered by a range shuffle, for the same reason; joins on a hot key are split by adaptive execution.

Defined cases: turns stand in the order of `turn`, null first, equal ones by the hash of role and text; a
null role or text is the empty one; rows without a conv_id belong to no conversation and are left out; a
repeated row is a turn of its own; no conversations give no nodes; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, written

#: Turns of a conversation that are summed in one task.
BLOCK = 1 << 16
#: Conversation numbers whose ids stand in one row to be hashed.
IDS = 1 << 12
#: Nodes of a component that is finished inside a task.
SMALL = 20_000
_LOCAL = 33
_LANES = ("s1", "s2", "s3", "s4")
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# Turns in order


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), n (the conversation's turns), digest, words, of every turn; written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        # The length keeps role and text apart.
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    # Equal turns part by the task they come from.
    order.append(F.col("from"))
    # Written, since a range shuffle reads its rows twice: texts are hashed once.
    turns = written(turns.withColumn("from", F.monotonically_increasing_id()), "digests")
    sorted_ = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_.select("conv_id", "digest", "words", F.monotonically_increasing_id().alias("place"))
    placed = written(placed, "turns")
    task = F.shiftright("place", _LOCAL)
    local = F.col("place").bitwiseAND((1 << _LOCAL) - 1)
    tasks = placed.groupBy(task.alias("task")).agg((F.max(local) + 1).alias("held"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    numbered = placed.join(tasks, task == tasks["task"]).select(
        "conv_id", "digest", "words", (F.col("before") + local).alias("number")
    )
    starts = numbered.groupBy("conv_id").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("n"))
    turns = numbered.join(starts, "conv_id").select(
        "conv_id", (F.col("number") - F.col("start")).alias("pos"), "n", "digest", "words"
    )
    return written(turns, "ordered")


def rebuilt_turns(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations in which c begins as conversation c - c % every does.

    Of that one it takes the first h turns, h = crc32(c) % heads, and then its own after its first h.
    Turns come as `ordered_turns` gives them, conversations as conv_id and n, turnless ones included.
    """
    own = turns.groupBy("conv_id").agg(F.first("n").alias("own"))
    convs = own.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    convs = convs.join(bases, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    left = F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + left).alias("n"))
    convs = written(convs, "conversations")
    rest = turns.drop("n").join(convs, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "n", "digest", "words"
    )
    head = turns.where((F.col("pos") < heads - 1) & (F.col("conv_id") % every == 0))
    head = head.select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    head = head.join(convs, "base").where("pos < taken").select("conv_id", "pos", "n", "digest", "words")
    return head.unionByName(rest), convs.select("conv_id", "n")


# Nodes


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, left (turns from here on), words, the sums of the turns up to here, and those before."""
    a, b = (F.xxhash64("pos", "digest", F.lit(seed)) for seed in (1, 2))
    low = F.lit(0xFFFFFFFF)
    lanes = (F.shiftrightunsigned(a, 32), a.bitwiseAND(low), F.shiftrightunsigned(b, 32), b.bitwiseAND(low))
    marked = turns.select(
        "conv_id",
        "pos",
        (F.col("n") - F.col("pos")).alias("left"),
        "words",
        *[lane.alias(f"e{name}") for lane, name in zip(lanes, _LANES)],
        F.floor(F.col("pos") / BLOCK).alias("block"),
    )
    along = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = marked.select("*", *[F.sum(f"e{name}").over(along).alias(f"in_{name}") for name in _LANES])
    # Conversations of one block, and the last block of the others, have nothing to carry on.
    blocks = marked.where(F.col("left") + F.col("pos") > (F.col("block") + 1) * BLOCK)
    blocks = blocks.groupBy("conv_id", "block").agg(*[F.sum(f"e{name}").alias(name) for name in _LANES])
    passed = Window.partitionBy("conv_id").orderBy("block")
    carried = blocks.select(
        "conv_id",
        (F.col("block") + 1).alias("block"),
        *[F.sum(name).over(passed).alias(f"before_{name}") for name in _LANES],
    )
    joined = summed.join(carried, ["conv_id", "block"], "left")
    sums = [F.coalesce(f"before_{name}", F.lit(0)) + F.col(f"in_{name}") for name in _LANES]
    return joined.select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        "left",
        "words",
        *[total.alias(name) for total, name in zip(sums, _LANES)],
        *[(total - F.col(f"e{name}")).alias(f"p{name}") for total, name in zip(sums, _LANES)],
    )


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the ways of conversations through them, both written.

    `turns` has conv_id, pos, n, digest, words; `convs` every conversation with its number of turns n.

    Nodes: conv_id, depth, parent (its conv_id), n_convs, words, weight (the turns that its members have
    left, and one of each for the node). Ways: conv_id, depth, owner, parent and left: the conversation's
    node at a depth, that node's parent, and what it has left, itself included.
    """
    prefixes = written(_prefixes(turns), "prefixes")
    found = written(
        prefixes.groupBy("depth", *_LANES).agg(
            F.min("conv_id").alias("owner"),
            F.count(F.lit(1)).alias("n_convs"),
            F.sum("left").alias("weight"),
            F.min("words").alias("words"),
            *[F.min(f"p{name}").alias(f"p{name}") for name in _LANES],
        ),
        "found",
    )
    root = convs.select(
        F.lit(0).cast("long").alias("depth"), "conv_id", (F.col("n") + 1).alias("left")
    )
    top = root.groupBy("depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("left").alias("weight")
    )
    # One number: every conversation and every first turn is tied to it, so it is no key of a join.
    first = F.lit((top.first() or {"conv_id": None})["conv_id"]).cast("long")
    none = F.lit(None).cast("long")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"), *[F.col(n).alias(f"p{n}") for n in _LANES])
    tied = found.where("depth > 1").join(above, ["depth", *[f"p{name}" for name in _LANES]])
    tied = tied.unionByName(found.where("depth = 1").withColumn("parent", first))
    tied = written(tied.drop(*[f"p{name}" for name in _LANES]), "tied")
    nodes = tied.select(F.col("owner").alias("conv_id"), "depth", "parent", "n_convs", "words", "weight")
    nodes = nodes.unionByName(
        top.select("conv_id", "depth", none.alias("parent"), "n_convs", F.lit(0).cast("long").alias("words"), "weight")
    )
    ways = prefixes.select("conv_id", "depth", "left", *_LANES).join(
        tied.select("depth", *_LANES, "owner", "parent"), ["depth", *_LANES]
    )
    ways = ways.select("conv_id", "depth", "owner", "parent", "left").unionByName(
        root.select("conv_id", "depth", first.alias("owner"), none.alias("parent"), "left")
    )
    return written(nodes, "nodes"), written(ways, "ways")


# Totals


def settle(parents: list[int], weights: list[int], leaves: list[int], saved: list[int]) -> tuple[list[int], list[int]]:
    """Totals over the subtrees of one component, whose nodes follow their parents; the first is its top.

    `weights` are those of subtrees within the component, and are used up.
    """
    all_leaves, all_saved = [0] * len(parents), [0] * len(parents)
    waiting = [list(range(len(parents)))]
    while waiting:
        part = waiting.pop()
        top = part[0]
        half = weights[top] / 2
        c = min((i for i in part if weights[i] > half), key=weights.__getitem__)
        below: dict[int, int] = {}  # node -> the child of the centroid that it lies under
        pieces: dict[int, list[int]] = {}
        above = []
        some_leaves, some_saved = leaves[c], saved[c]
        for i in part:
            if i == c:
                continue
            child = i if parents[i] == c else below.get(parents[i])
            if child is None:
                above.append(i)
                continue
            below[i] = child
            pieces.setdefault(child, []).append(i)
            some_leaves += leaves[i]
            some_saved += saved[i]
        all_leaves[c] += some_leaves
        all_saved[c] += some_saved
        i = c
        while i != top:
            i = parents[i]
            all_leaves[i] += some_leaves
            all_saved[i] += some_saved
            weights[i] -= weights[c]
        waiting += pieces.values()
        if above:
            waiting.append(above)
    return all_leaves, all_saved


_TOP = ("top", "top_depth")
_STATE = "conv_id long, depth long, parent long, n_convs long, n_children long, all_leaves long, all_saved long"
_SETTLED = ("conv_id", "depth", "parent", "n_convs", "n_children", "all_leaves", "all_saved")


def _settle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole components, in order of top and depth; the last one of a batch may go on in the next."""

    def finished(rows: pd.DataFrame) -> pd.DataFrame:
        top, top_depth = rows["top"].to_numpy(), rows["top_depth"].to_numpy()
        new = (top[1:] != top[:-1]) | (top_depth[1:] != top_depth[:-1])
        ends = [0, *(new.nonzero()[0] + 1).tolist(), len(rows)]
        names = list(zip(rows["conv_id"].tolist(), rows["depth"].tolist()))
        parents = rows["parent"].fillna(-1).astype("int64").tolist()
        weights, leaves, saved = (rows[c].tolist() for c in ("weight", "leaves", "saved"))
        all_leaves, all_saved = [], []
        for a, b in zip(ends, ends[1:]):
            at = {name: i for i, name in enumerate(names[a:b])}
            up = [at.get((p, name[1] - 1), -1) for p, name in zip(parents[a:b], names[a:b])]
            up[0] = -1
            more_leaves, more_saved = settle(up, weights[a:b], leaves[a:b], saved[a:b])
            all_leaves += more_leaves
            all_saved += more_saved
        out = rows.assign(all_leaves=rows["all_leaves"] + all_leaves, all_saved=rows["all_saved"] + all_saved)
        return out[list(_SETTLED)]

    kept = None
    for batch in batches:
        rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        if rows.empty:
            continue
        last = (rows["top"] == rows["top"].iloc[-1]) & (rows["top_depth"] == rows["top_depth"].iloc[-1])
        kept = rows[last].reset_index(drop=True)
        if not last.all():
            yield finished(rows[~last])
    if kept is not None:
        yield finished(kept)


def subtree_totals(nodes: DataFrame, ways: DataFrame, small: int = SMALL) -> DataFrame:
    """`nodes` (with n_children, leaves and saved of the node itself) and all_leaves, all_saved of subtrees."""
    zero = F.lit(0).cast("long")
    state = nodes.select("*", zero.alias("all_leaves"), zero.alias("all_saved"))
    top = nodes.where("depth = 0").select("conv_id").first()  # the root
    top = F.lit(top["conv_id"] if top else None).cast("long")
    state = written(state.select("*", top.alias("top"), zero.alias("top_depth")), "state")
    ready, settled = [], []
    while True:
        sizes = state.groupBy(*_TOP).agg(F.count(F.lit(1)).alias("size"), F.max("weight").alias("whole"))
        # No more than one of `small` nodes.
        large = written(sizes.where(F.col("size") > small).drop("size"), "large")
        ready.append(state.join(large, [*_TOP], "left_anti"))
        if large.isEmpty():
            break
        state, centroids = _split(state.join(large, [*_TOP]), ways)
        settled.append(centroids)
    rest = ready[0]
    for more in ready[1:]:
        rest = rest.unionByName(more)
    rest = rest.repartition(*_TOP).sortWithinPartitions(*_TOP, "depth", "conv_id")
    out = rest.mapInPandas(_settle_rows, _STATE)
    for centroids in settled:
        out = out.unionByName(centroids.select(*_SETTLED))
    return out


def _split(state: DataFrame, ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over components: the nodes in their new components, and the centroids with their totals."""
    name = F.struct(F.col("conv_id").alias("c"), F.col("depth").alias("c_depth"))
    heavy = state.where(F.col("weight") * 2 > F.col("whole")).groupBy(*_TOP)
    centroids = heavy.agg(F.min_by(name, "weight").alias("name"), F.min("weight").alias("c_weight"))
    centroids = written(centroids.select(*_TOP, "name.*", "c_weight"), "centroids")
    # The node's way shows the child of the centroid that it passes, if it passes one.
    passes = ways.select("conv_id", F.col("depth").alias("at"), F.col("owner").alias("child"), F.col("parent").alias("over"))
    placed = state.join(centroids, [*_TOP]).withColumn("at", F.col("c_depth") + 1)
    placed = placed.join(passes, ["conv_id", "at"], "left")
    is_centroid = (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("c_depth"))
    is_below = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("over") == F.col("c"), F.lit(False))
    placed = placed.select("*", is_centroid.alias("is_centroid"), is_below.alias("is_below"))
    placed = written(placed.drop("at", "over", "whole"), "placed")
    sums = placed.where("is_centroid or is_below").groupBy(*_TOP).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    sums = written(centroids.join(sums, [*_TOP]), "sums")
    # From the centroid up to the top, along the way of the conversation that names the centroid.
    steps = ways.select(F.col("conv_id").alias("c"), F.col("depth").alias("step"), "owner").join(sums, "c")
    steps = steps.where((F.col("step") >= F.col("top_depth")) & (F.col("step") < F.col("c_depth"))).select(
        F.col("owner").alias("conv_id"), F.col("step").alias("depth"), "c_weight", "more_leaves", "more_saved"
    )
    columns = [c for c in state.columns if c != "whole"]

    def raised(rows: DataFrame) -> DataFrame:
        changed = {
            "weight": F.col("weight") - F.coalesce("less", F.lit(0)),
            "all_leaves": F.col("all_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "all_saved": F.col("all_saved") + F.coalesce("more_saved", F.lit(0)),
        }
        return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])

    above = placed.where("not is_centroid and not is_below").drop("c_weight")
    above = raised(above.join(steps.withColumnRenamed("c_weight", "less"), ["conv_id", "depth"], "left"))
    below = placed.where("is_below")
    parts = {"top": F.col("child"), "top_depth": F.col("c_depth") + 1}
    below = below.select(*[parts.get(c, F.col(c)).alias(c) for c in columns])
    done = placed.where("is_centroid").join(sums.select(*_TOP, "more_leaves", "more_saved"), [*_TOP])
    done = raised(done.withColumn("less", F.lit(0)))
    return written(above.unionByName(below), "parts"), written(done, "settled")


# Ends


def _hash_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest per node over its ids, which come in order, some thousand to a row."""
    node, digest = None, None
    for batch in batches:
        out = []
        for owner, depth, ids in zip(batch["owner"].tolist(), batch["depth"].tolist(), batch["ids"]):
            if (owner, depth) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (owner, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["conv_id", "depth", "ends_sha256"]).astype({"conv_id": "int64", "depth": "int64"})
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])


def ends(ways: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of the nodes at which conversations end.

    The ids of one block of numbers are at most its length, so no row is longer than that; a node's rows
    are hashed one after the other, never held together.
    """
    last = ways.where("left = 1").groupBy("owner", "depth", F.floor(F.col("conv_id") / IDS).alias("block"))
    rows = last.agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    rows = rows.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block")
    rows = rows.select("owner", "depth", "ids")
    return rows.mapInPandas(_hash_rows, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, every: int = 20, heads: int = 4, small: int = SMALL) -> DataFrame:
    """Every node of the trie of rebuilt conversations; see `rebuilt_turns`.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns, convs = rebuilt_turns(ordered_turns(conversations), every, heads)
    nodes, ways = trie(turns, convs)
    children = nodes.where("parent is not null").groupBy(
        F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    )
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0)).cast("long")
    nodes = nodes.join(children, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent",
        "n_convs",
        "weight",
        n_children.alias("n_children"),
        (n_children == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    totals = subtree_totals(nodes, ways, small)
    return totals.join(ends(ways), ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("all_leaves").alias("n_leaves"),
        F.col("all_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
