"""Conversation prefix trie: nodes by hashed prefixes, subtree totals by centroid decomposition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.llm.common import saved
from vendaflow.llm.simhash import group_starts, whole_groups
from vendaflow.operators.joins import hot_share, shuffle_partitions, spread_join

FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that no bit of a turn is lost
WORD = 1 << 64
PIECE = 20_000  # turns of a component that one task takes apart by itself
SHARED_ROWS = 100_000  # rows of a table that is broadcast in a round
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY, TOP = ["k1", "k2"], ["t1", "t2"]


def turn_tags(role: Column, text: Column) -> list[Column]:
    """120 bits of the SHA-256 of a turn, in two numbers; role and text cannot run together."""
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return [F.conv(F.substring(whole, 1 + 15 * i, 15), 16, 10).cast("bigint").alias(f"x{i + 1}") for i in (0, 1)]


# -- running sums over sorted partitions ----------------------------------------------


def _powers(factor: int, n: int) -> np.ndarray:
    """factor^1 ... factor^n, modulo 2^64."""
    return np.cumprod(np.full(n, factor, np.uint64))


def _run_in_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and prefix hash of each turn among those of its conversation in this partition."""
    part = TaskContext.get().partitionId()
    last, seen, sums = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv").to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(conv[1:] != conv[:-1]) + 1))
        sizes = np.diff(np.append(starts, n))
        run = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(n) - starts[run]
        on = sizes[0] if conv[0] == last else 0  # rows that go on with the batch before
        at = place + 1
        at[:on] += seen
        out = {"part": pa.array(np.full(n, part, np.int32)), "conv": batch.column("conv"), "at": pa.array(at)}
        with np.errstate(over="ignore"):
            for i, factor in enumerate(FACTORS):
                x = batch.column(f"x{i + 1}").to_numpy().view(np.uint64)
                term = x * _powers(factor, int(sizes.max()))[place]
                term[:on] *= np.uint64(pow(factor, seen, WORD))
                total = np.cumsum(term)
                k = total - (total[starts] - term[starts])[run]
                k[:on] += sums[i]
                sums[i] = k[-1]
                out[f"k{i + 1}"] = pa.array(k.view(np.int64))
                out[f"p{i + 1}"] = pa.array((k - term).view(np.int64))
        last, seen = conv[-1], int(at[-1])
        yield pa.record_batch(out | {c: batch.column(c) for c in ("x1", "x2", "bytes")})


def running(turns: DataFrame, *order: Column) -> DataFrame:
    """(conv, at, k1, k2, p1, p2, x1, x2, bytes): the turns of each conversation numbered from 1.

    k1, k2 are a hash of the turns up to this one and p1, p2 of those before it: the sum of
    x * factor^at modulo 2^64, which can be put together from parts. So a conversation may
    stretch over many range partitions; what is carried into each is worked out from one row
    per partition.
    """
    spark = turns.sparkSession
    by = [F.col("conv"), *order]
    columns = ["conv", "x1", "x2", "bytes"]
    ordered = turns.repartitionByRange(*by).sortWithinPartitions(*by).select(*columns)
    types = "conv bigint, at bigint, k1 bigint, p1 bigint, k2 bigint, p2 bigint, x1 bigint, x2 bigint, bytes bigint"
    local = saved(ordered.mapInArrow(_run_in_part, f"part int, {types}"), "running")
    ends = local.groupBy("part").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "at", "k1", "k2")).alias("last")
    )
    carried: dict[int, tuple[int, int, tuple[int, int]]] = {}  # part -> conversation, turns, hash before it
    conv, before, sums = None, 0, (0, 0)
    for r in sorted(ends.collect()):
        fresh = r["first"] != conv
        if not fresh:
            carried[r["part"]] = (conv, before, sums)
        own = r["last"]
        if fresh or own["conv"] != conv:
            conv, before, sums = own["conv"], 0, (0, 0)
        sums = tuple((s + pow(f, before, WORD) * k) % WORD for f, s, k in zip(FACTORS, sums, (own["k1"], own["k2"])))
        before += own["at"]

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            part = columns.pop("part").to_numpy()
            for p in np.unique(part).tolist():
                if p not in carried:
                    continue
                conv, before, sums = carried[p]
                mine = (part == p) & (columns["conv"].to_numpy() == conv)
                columns["at"] = pa.array(columns["at"].to_numpy() + np.where(mine, before, 0))
                with np.errstate(over="ignore"):
                    for i, factor in enumerate(FACTORS):
                        scale = np.uint64(pow(factor, before, WORD))
                        for name in (f"k{i + 1}", f"p{i + 1}"):
                            old = columns[name].to_numpy().view(np.uint64)
                            new = np.where(mine, old * scale + np.uint64(sums[i]), old)
                            columns[name] = pa.array(new.view(np.int64))
            yield pa.record_batch(columns)

    return local.mapInArrow(carry, types) if carried else local.drop("part")


# -- the contract's conversations -----------------------------------------------------


def tagged_turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, x1, x2, bytes, row) of every row with a conv_id; null role and
    text count as empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), text.alias("text"),
        *turn_tags(role, text), F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: (convs, turns), from turns numbered by `running`.

    Conversation c gets the first h turns of c - c % group, then its own after its first h; h is
    the CRC-32 of c in decimal modulo `most`. convs: (conv, length) of every conversation, also
    where no turn is left. turns: (conv, side, at, x1, x2, bytes), in the order of (side, at).
    """
    told = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    own = turns.groupBy("conv").agg(F.max("at").alias("n"))
    own = saved(own.select("conv", "n", told.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base")), "convs")
    bases = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    given = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = own.join(bases, "base", "left").select(
        "conv", (given + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("bigint").alias("length")
    )
    heads = turns.filter((F.col("conv") % group == 0) & (F.col("at") < most)).select(
        F.col("conv").alias("base"), "at", "x1", "x2", "bytes"
    )
    copied = own.select("conv", "base", "h").join(heads, "base").filter(F.col("at") <= F.col("h"))
    columns = ["conv", "side", "at", "x1", "x2", "bytes"]
    parts = copied.withColumn("side", F.lit(0)).select(*columns).unionByName(
        turns.filter(F.col("at") > told).withColumn("side", F.lit(1)).select(*columns)
    )
    return saved(convs, "lengths"), parts


# -- nodes ----------------------------------------------------------------------------


def _hot(counts: DataFrame, key: list[str], n: str, total: int) -> dict[int, float]:
    """Keys with so large a share of the rows that their rows are dealt to several tasks."""
    share = hot_share(shuffle_partitions(counts.sparkSession))
    rows = counts.filter(F.col(n) > share * total).select(F.xxhash64(*key).alias("h"), n).collect()
    return {r["h"]: r[n] / total for r in rows}  # 1 / share at most


def _nodes(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """One row per distinct prefix, the root included.

    k1, k2 name it, p1, p2 its parent. `weight` counts the turns, plus one for the root, of all
    conversations in its subtree; it is what the decomposition balances.
    """
    total = convs.agg(F.sum("length")).first()[0] or 0
    lengths = convs.select(F.col("conv").alias("c"), "length")
    long = _hot(convs, ["conv"], "length", total) if total else {}
    each = spread_join(steps, lengths, [("conv", "c")], "inner", long, ["at"])
    below = each.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("at").alias("depth"),
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("at") + 1).alias("weight"),
    )
    zero = F.lit(0).cast("bigint")
    root = convs.agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")
    ).filter("n_convs > 0")
    root = root.select(
        zero.alias("k1"), zero.alias("k2"), zero.cast("bigint").alias("p1"), zero.alias("p2"), zero.alias("depth"),
        "conv", "n_convs", zero.alias("bytes"), "weight",
    )
    return saved(below.unionByName(root), "nodes")


def _with_family(nodes: DataFrame) -> DataFrame:
    """The nodes with their parent's conv_id, their number of children, and what is summed up:
    `leaves` 1 for a node without any, `tokens` the bytes that sharing its last turn saves."""
    inner = nodes.filter("depth > 0")
    children = saved(
        inner.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("n_children")),
        "children",
    )
    counted = nodes.join(children, (nodes["k1"] == children["c1"]) & (nodes["k2"] == children["c2"]), "left")
    counted = counted.drop("c1", "c2").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    parents = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("parent"))
    hot = _hot(children, ["c1", "c2"], "n_children", nodes.count())
    orphan = counted.withColumns({c: F.when(F.col("depth") > 0, F.col(c)) for c in ("p1", "p2")})
    known = spread_join(orphan, parents, [("p1", "q1"), ("p2", "q2")], "left", hot, KEY).drop("q1", "q2")
    return known.withColumns({
        "leaves": (F.col("n_children") == 0).cast("bigint"),
        "tokens": (F.col("n_convs") - 1) * F.col("bytes"),
    })


def _ends(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """(e1, e2, ends): SHA-256 of the ids of the conversations that end at a node, ascending.

    The ids are sorted by range and joined to chunks of text in many tasks; one task per node
    runs over the chunks in order, without holding them.
    """
    last = steps.groupBy("conv").agg(F.max(F.struct("at", *KEY)).alias("s"))
    at_node = convs.join(last, "conv", "left").select(
        *[F.coalesce(F.col("s")[k], F.lit(0)).alias(k) for k in KEY], "conv"
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = pa.Table.from_batches([batch])
                starts = group_starts(part, KEY)
                k1, k2, conv = (part[c].to_numpy() for c in (*KEY, "conv"))
                ends = [*starts[1:], part.num_rows]
                ids = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(starts, ends)]
                yield pa.record_batch({"e1": k1[starts], "e2": k2[starts], "first": conv[starts], "ids": ids})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for e1, e2, ids in zip(*[batch.column(c).to_pylist() for c in ("e1", "e2", "ids")]):
                if (e1, e2) == held:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    done.append((*held, state.hexdigest()))
                held, state = (e1, e2), hashlib.sha256(ids.encode())
            if done:
                yield told(done)
        if state:
            yield told([(*held, state.hexdigest())])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        e1, e2, ends = zip(*rows)
        return pa.record_batch({"e1": pa.array(e1, pa.int64()), "e2": pa.array(e2, pa.int64()), "ends": list(ends)})

    ordered = at_node.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    pieces = ordered.mapInArrow(chunks, "e1 bigint, e2 bigint, first bigint, ids string")
    return (
        pieces.repartition("e1", "e2")
        .sortWithinPartitions("e1", "e2", "first")
        .mapInArrow(digest, "e1 bigint, e2 bigint, ends string")
    )


# -- rollup ---------------------------------------------------------------------------


def _split(active: DataFrame, steps: DataFrame, most: int) -> DataFrame:
    """One round over components of more than `most` turns: each is taken apart at its centroid.

    Nodes with more than half of the component's weight below them form the path from the
    centroid, the deepest of them, up to the top. What lies in the component at or below the
    centroid is summed once, added to every node of the path, and its weight taken from those
    above. A node is below if the conversation that names it has the centroid at its depth; the
    node after that on its way is the top of the new component.

    Returns the rows with their new component and `state`: done, small or large.
    """
    spark = active.sparkSession
    heavy = F.col("weight") * 2 > F.col("total")
    found = (
        active.filter(heavy).groupBy(*TOP)
        .agg(F.max(F.struct("depth", *KEY, "weight")).alias("c"))
        .select(*TOP, "c.*")
        .toDF(*TOP, "c_depth", "c1", "c2", "c_weight")
    )
    found = _shared(saved(found, "centroids"))
    marked = active.join(found, TOP)
    asked = marked.filter(F.col("depth") > F.col("c_depth")).groupBy(*TOP, "conv").agg(
        F.min(F.col("c_depth") + 1).alias("next"), F.count("*").alias("n")
    )
    asked = saved(asked, "asked")
    ways = steps.select(
        F.col("conv").alias("way"), "at", F.col("k1").alias("n1"), F.col("k2").alias("n2"),
        F.col("p1").alias("b1"), F.col("p2").alias("b2"),
    )
    answers = (
        asked.join(ways, (F.col("conv") == F.col("way")) & (F.col("next") == F.col("at")))
        .select(F.col("t1").alias("u1"), F.col("t2").alias("u2"), F.col("conv").alias("way"), "n1", "n2", "b1", "b2")
    )
    hot = _hot(asked, [*TOP, "conv"], "n", active.count())
    pairs = [("t1", "u1"), ("t2", "u2"), ("conv", "way")]
    located = spread_join(marked, answers, pairs, "left", hot, KEY)
    is_centroid = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    through = (F.col("b1") == F.col("c1")) & (F.col("b2") == F.col("c2")) & (F.col("depth") > F.col("c_depth"))
    located = located.withColumns({
        "centroid": is_centroid,
        "below": F.coalesce(through, F.lit(False)),
        "path": heavy,
    })
    located = saved(located.drop("u1", "u2", "way", "b1", "b2", "c1", "c2", "c_depth"), "located")
    sums = located.filter("below OR centroid").groupBy(*TOP).agg(
        F.sum("leaves").alias("t_leaves"), F.sum("tokens").alias("t_tokens")
    )
    path, zero = F.col("path"), F.lit(0)
    added = located.join(_shared(saved(sums, "totals")), TOP).select(
        *[c for c in active.columns if c not in (*TOP, "total", "state", "weight", "n_leaves", "saved_tokens")],
        (F.col("weight") - F.when(path & ~F.col("centroid"), F.col("c_weight")).otherwise(zero)).alias("weight"),
        (F.col("n_leaves") + F.when(path, F.col("t_leaves")).otherwise(zero)).alias("n_leaves"),
        (F.col("saved_tokens") + F.when(path, F.col("t_tokens")).otherwise(zero)).alias("saved_tokens"),
        F.when(F.col("below"), F.col("n1")).otherwise(F.col("t1")).alias("t1"),
        F.when(F.col("below"), F.col("n2")).otherwise(F.col("t2")).alias("t2"),
        "centroid",
    )
    added = saved(added, "split")
    tops = added.filter(~F.col("centroid") & (F.col("weight") > most) & (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")))
    large = _shared(saved(tops.select(*TOP, F.col("weight").alias("total")), "large"))
    state = F.when(F.col("centroid"), "done").when(F.col("total").isNull(), "small").otherwise("large")
    return added.join(large, TOP, "left").withColumn("state", state).drop("centroid")


def _shared(rows: DataFrame) -> DataFrame:
    """A row per large component, to be broadcast unless there are too many."""
    return F.broadcast(rows) if rows.count() <= SHARED_ROWS else rows


def take_apart(part: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What is to be added to (n_leaves, saved_tokens) of the nodes of whole components.

    Arrays: own and parent's key (n x 2), depth, component, weight, values (n x 2). All
    components are taken apart at once, in rounds: of each, the deepest node with more than half
    of the weight is the centroid; the values at and below it go to the path from it to the
    top; its children's subtrees and the rest are the next components.
    """
    n = len(part["depth"])
    own, up = (np.ascontiguousarray(part[c]).view("V16").ravel() for c in ("own", "up"))
    names, where = np.unique(np.concatenate((own, up)), return_inverse=True)
    row = np.full(len(names), -1)
    row[where[:n]] = np.arange(n)
    parent = row[where[n:]]
    comp, depth, weight = part["component"].copy(), part["depth"], part["weight"].copy()
    parent[(depth == 0) | (comp[parent] != comp)] = -1  # above the top of the component
    first, last = _intervals(parent, depth)
    added = np.zeros((n, 2), np.int64)
    order = np.argsort(first)
    alive = order[np.argsort(comp[order], kind="stable")]  # by component, then in preorder
    while len(alive):
        c, w = comp[alive], weight[alive]
        starts = np.concatenate(([0], np.flatnonzero(c[1:] != c[:-1]) + 1))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(alive))))
        path = 2 * w > np.maximum.reduceat(w, starts)[group]
        deep = np.where(path, depth[alive], -1)
        # Depths on a path differ, so one node of each component has the largest.
        centre = alive[np.flatnonzero(deep == np.maximum.reduceat(deep, starts)[group])]
        mine = centre[group]
        is_centre = alive == mine
        below = (first[alive] >= first[mine]) & (first[alive] <= last[mine])
        totals = np.add.reduceat(np.where(below[:, None], part["values"][alive], 0), starts)
        added[alive[path]] += totals[group[path]]
        above = path & ~is_centre
        weight[alive[above]] -= weight[mine[above]]
        # Below the centroid the next top is the nearest one before in preorder.
        top = (parent[alive] == mine) & below
        nearest = np.maximum.accumulate(np.where(top, np.arange(len(alive)), 0))
        inside = below & ~is_centre
        comp[alive[inside]] = n + alive[nearest[inside]]  # rows are no names of given components
        left = alive[~is_centre]
        order = left[np.argsort(first[left])]
        alive = order[np.argsort(comp[order], kind="stable")]
        comp[alive] = np.unique(comp[alive], return_inverse=True)[1]
    return added[:, 0], added[:, 1]


def _intervals(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last preorder number of each node's subtree, in a forest."""
    n = len(parent)
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    levels = np.split(by_depth, cuts)
    count = np.ones(n, np.int64)
    for level in reversed(levels):
        inner = level[parent[level] >= 0]
        np.add.at(count, parent[inner], count[inner])
    first = np.zeros(n, np.int64)
    tops = np.flatnonzero(parent < 0)
    first[tops] = np.cumsum(count[tops]) - count[tops]
    for level in levels:
        inner = level[parent[level] >= 0]
        if len(inner):
            inner = inner[np.argsort(parent[inner], kind="stable")]
            p, run = parent[inner], np.cumsum(count[inner]) - count[inner]
            starts = np.concatenate(([0], np.flatnonzero(p[1:] != p[:-1]) + 1))
            base = np.repeat(run[starts], np.diff(np.append(starts, len(inner))))
            first[inner] = first[p] + 1 + run - base
    return first, first + count - 1


def _finish(small: DataFrame, most: int) -> DataFrame:
    """Components of at most `most` turns, whole ones to a task."""
    ordered = small.repartition(*TOP).sortWithinPartitions(*TOP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, TOP, most):
            starts = group_starts(part, TOP)
            sizes = np.diff([*starts, part.num_rows])
            column = lambda name: part[name].to_numpy()
            pair = lambda a, b: np.column_stack((column(a), column(b)))
            parents = np.column_stack([part[c].fill_null(0).to_numpy() for c in ("p1", "p2")])
            found = take_apart({
                "own": pair("k1", "k2"), "up": parents, "depth": column("depth"),
                "component": np.repeat(np.arange(len(starts)), sizes),
                "weight": column("weight"), "values": pair("leaves", "tokens"),
            })
            for name, more in zip(("n_leaves", "saved_tokens"), found):
                at = part.schema.get_field_index(name)
                part = part.set_column(at, name, pa.array(column(name) + more))
            yield from part.to_batches()

    return ordered.mapInArrow(run, ordered.schema)


def _rolled_up(nodes: DataFrame, steps: DataFrame, most: int) -> DataFrame:
    """The nodes with `n_leaves` and `saved_tokens`, summed over their subtrees.

    By centroid decomposition: of an ancestor and a node below it, exactly one centroid lies
    between the two while they still share a component, and there the value is added. Weights
    halve, so there are at most log2(turns / most) rounds over large components.
    """
    zero = F.lit(0).cast("bigint")
    whole = nodes.withColumns({
        "n_leaves": zero, "saved_tokens": zero, "t1": zero, "t2": zero,
    })
    top = nodes.filter("depth = 0").select("weight").first()
    total = top[0] if top else 0
    kept = [c for c in whole.columns]
    if total <= most:
        return _finish(whole, most)
    active, done, small = saved(whole.withColumn("total", F.lit(total).cast("bigint")), "active"), [], []
    while True:
        parts = saved(_split(active, steps, most), "parts")
        done.append(parts.filter("state = 'done'").select(*kept))
        small.append(parts.filter("state = 'small'").select(*kept))
        active = parts.filter("state = 'large'").drop("state")
        if active.isEmpty():
            break
    for more in small[1:]:
        small[0] = small[0].unionByName(more)
    found = _finish(small[0], most)
    for more in done:
        found = found.unionByName(more)
    return found


def trie(convs: DataFrame, turns: DataFrame, *order: Column, piece: int = PIECE) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one on.

    `convs`: (conv, length) of every conversation, also of those without turns. `turns`: (conv,
    x1, x2, bytes) and the columns of `order`, which sorts the turns of a conversation without
    ties; x1, x2 are its tag (see turn_tags), so prefixes are told apart by 120 bits of the
    turns and 128 of the sequence.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): the smallest member, the number of turns, the parent's smallest member (null
    for the root), members, children, childless nodes and saved bytes in the subtree, and the
    digest of the ids that end here. No conversation: no row. `piece`: turns of a component
    that a task takes apart by itself.
    """
    steps = saved(running(turns, *order), "steps")
    nodes = saved(_with_family(_nodes(convs, steps)), "family")
    found = _rolled_up(nodes, steps, piece)
    ends = _ends(convs, steps)
    return found.join(ends, (found["k1"] == ends["e1"]) & (found["k2"] == ends["e2"]), "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """The trie over the rebuilt conversations of a table (conv_id, turn, role, text).

    Turns are ordered by `turn`, null first, then role and text. Rows without a conv_id belong
    to no conversation and are left out; other columns are not read. Repeated rows are turns of
    their own.
    """
    tagged = tagged_turns(conversations)
    turns = running(tagged, F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row"))
    convs, parts = rebuilt(saved(turns, "turns"))
    return trie(convs, parts, F.col("side"), F.col("at"), piece=piece)


PREFIX_SQL = """
WITH RECURSIVE bits AS (
    SELECT i::UBIGINT AS i, i::UBIGINT AS v, 0 AS step FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END, step + 1 FROM bits WHERE step < 8
), crc AS (
    SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8
), numbered AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv, conv - conv % 5 AS base, xor(4294967295::UBIGINT, list_reduce(
        list_transform(range(1, length(conv::VARCHAR) + 1), lambda p: ascii(substr(conv::VARCHAR, p::BIGINT, 1))::UBIGINT),
        lambda a, b: xor(a // 256, t[(xor(a % 256, b) + 1)::BIGINT]), 4294967295::UBIGINT)) % 9 AS h
    FROM (SELECT DISTINCT conv FROM numbered), crc
), parts AS (
    SELECT c.conv, 0 AS side, n.nth, role, text FROM convs c JOIN numbered n ON n.conv = c.base AND n.nth <= c.h
    UNION ALL
    SELECT c.conv, 1, n.nth, role, text FROM convs c JOIN numbered n ON n.conv = c.conv AND n.nth > c.h
), steps AS (
    SELECT conv, row_number() OVER w AS nth, list({'role': role, 'text': text}) OVER w AS prefix, strlen(text) AS bytes
    FROM parts WINDOW w AS (PARTITION BY conv ORDER BY side, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL
    SELECT conv, 0, [], 0 FROM convs
), named AS (
    SELECT *, min(conv) OVER (PARTITION BY nth, prefix) AS node, max(nth) OVER (PARTITION BY conv) AS length FROM steps
), up AS (
    SELECT a.conv, a.nth, a.node, b.node AS parent FROM named a LEFT JOIN named b ON b.conv = a.conv AND b.nth = a.nth - 1
), nodes AS (
    SELECT n.node, n.nth, any_value(u.parent) AS parent, count(*) AS n_convs, any_value(bytes) AS bytes,
        string_agg(n.conv::VARCHAR, ',' ORDER BY n.conv) FILTER (length = n.nth) AS ends
    FROM named n JOIN up u USING (conv, nth) GROUP BY n.node, n.nth
), counted AS (
    SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.nth = n.nth + 1 AND c.parent = n.node) AS n_children FROM nodes n
), sums AS (
    SELECT s.node, s.nth, sum((c.n_children = 0)::INT) AS n_leaves, sum((c.n_convs - 1) * c.bytes) AS saved_tokens
    FROM counted c JOIN named s ON s.conv = c.node AND s.nth <= c.nth GROUP BY s.node, s.nth
)
SELECT node AS conv_id, nth AS depth, parent AS parent_conv_id, n_convs, n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM counted JOIN sums USING (node, nth)
"""
