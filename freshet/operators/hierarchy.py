"""Parent-child links to full hierarchies: Euler tours ranked in parallel.

1. Peeling. Leaves are taken off round by round, and inner links of unbranched chains are spliced out on the way
   (those whose random mark is the largest of their neighbours'), so that the rounds grow with the logarithm of the
   size, not with the depth, and the work shrinks geometrically. What can't be peeled is one self-loop for each
   circle; its outgoing link is cut, and the circle becomes a tree below a pseudo-root.
2. Tour. Each node is entered and left once. The predecessor of each of these two steps follows from its parent,
   children and neighbouring siblings alone.
3. Ranking. Pointer jumping over the predecessors gives each step its position, its depth and its root at once.
   Node b lies under node a when they have the same root and enter(a) <= enter(b) <= leave(a).

Every loop writes each round to the shared folder, and nothing but row counts reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.session import cut, partitions

# Texts that stand for "no parent".
NO_PARENT = ("", "nan", "None", "wb-0")
#: Sub-families that the children of one parent are linked in, so that a huge family is no single task.
FAMILY_SPLITS = 64
#: Steps of a tour that one task handles together.
BLOCK_STEPS = 1 << 16
#: Neighbouring nodes of a tour that are kept in one row, and levels of depth whose nodes ask the same copy of such a row.
RUN_NODES = 256
COPY_LEVELS = 1 << 12
#: Pairs that one task makes, about.
TASK_PAIRS = 1 << 22
CYCLE = "CYCLE"


@dataclass
class Hierarchy:
    """nodes: nid, id, parent (nid), root (nid), root_id, depth, enter, leave, cyclic."""

    nodes: DataFrame


def _clean(c: Column) -> Column:
    return F.trim(c)


def _peel(links: DataFrame) -> DataFrame:
    """links(v, p) with p null at roots: one v of each circle."""
    live, k = links, 0
    while True:
        mark = lambda c, r=k: F.xxhash64(F.lit(r), c)
        kids = live.filter("p IS NOT NULL").groupBy("p").agg(F.count("*").alias("n"), F.max("v").alias("kid")).withColumnRenamed("p", "v")
        inner = live.join(kids, "v")  # leaves are gone
        splice = (F.col("n") == 1) & F.col("p").isNotNull() & (F.col("p") != F.col("v")) & (F.col("kid") != F.col("v"))
        splice &= (mark(F.col("v")) >= mark(F.col("kid"))) & ((F.col("p") == F.col("kid")) | (mark(F.col("v")) > mark(F.col("p"))))
        # of two nodes in a circle of two exactly one goes: the one with the larger mark
        splice &= (F.col("p") != F.col("kid")) | (mark(F.col("v")) > mark(F.col("kid")))
        inner = inner.withColumn("out", splice).select("v", "p", "out")
        up = inner.filter("out").select(F.col("v").alias("p"), F.col("p").alias("pp"))
        live = cut(inner.filter("NOT out").join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p")), live if k else None)
        k += 1
        if live.filter("p IS NULL OR p <> v").isEmpty():
            return live.select("v")


def _tour(nodes: DataFrame) -> DataFrame:
    """nodes(v, p), a forest: e, prev (element ids), c, d for both steps of each node; e is 2v to enter and 2v+1 to leave."""
    kids = nodes.filter("p IS NOT NULL").withColumn("s", F.pmod(F.xxhash64("v"), F.lit(FAMILY_SPLITS)))
    kids = kids.withColumn("before", F.lag("v").over(Window.partitionBy("p", "s").orderBy("v")))
    ends = kids.groupBy("p", "s").agg(F.max("v").alias("last"))
    w = Window.partitionBy("p").orderBy("s")
    ends = ends.withColumn("before_s", F.lag("last").over(w)).withColumn("final", F.lead("s").over(w).isNull())
    linked = kids.join(ends, ["p", "s"]).withColumn("before", F.coalesce("before", "before_s"))
    enter = linked.select((F.col("v") * 2).alias("e"), F.when(F.col("before").isNull(), F.col("p") * 2).otherwise(F.col("before") * 2 + 1).alias("prev"), F.col("before").isNull().cast("int").alias("d"))
    last = ends.filter("final").select(F.col("p").alias("v"), "last")
    leave = nodes.join(last, "v", "left").select((F.col("v") * 2 + 1).alias("e"), F.coalesce(F.col("last") * 2 + 1, F.col("v") * 2).alias("prev"), F.when(F.col("last").isNull(), 0).otherwise(-1).alias("d"))
    first = nodes.filter("p IS NULL").select((F.col("v") * 2).alias("e"), F.lit(None).cast("bigint").alias("prev"), F.lit(0).alias("d"))
    return enter.unionByName(leave).unionByName(first)


def _rank(tour: DataFrame) -> DataFrame:
    """e, start, pos, depth of every element of lists given by prev, by pointer jumping.

    d of an element is its depth less that of its predecessor: 1 to enter a first child, 0 to enter the next one or to leave a
    leaf, -1 to leave another node (after its last child was left, whose depth is one more).
    """
    s = tour.select("e", F.coalesce("prev", "e").alias("to"), F.col("prev").isNotNull().cast("bigint").alias("c"), F.col("d").cast("bigint").alias("d"), F.col("prev").isNull().alias("done"))
    s = cut(s)
    while True:
        t = s.select(F.col("e").alias("at"), F.col("to").alias("to2"), F.col("c").alias("c2"), F.col("d").alias("d2"), F.col("done").alias("done2"))
        # what is done all points to few starts; keys of its own keep these rows spread out
        s0, s = s, s.withColumn("at", F.when(F.col("done"), -1 - F.col("e")).otherwise(F.col("to"))).join(t, "at", "left")
        go = ~F.col("done")
        s = cut(s.select("e", F.when(go, F.col("to2")).otherwise(F.col("to")).alias("to"), F.when(go, F.col("c") + F.col("c2")).otherwise(F.col("c")).alias("c"), F.when(go, F.col("d") + F.col("d2")).otherwise(F.col("d")).alias("d"), F.when(go, F.col("done2")).otherwise(True).alias("done")), s0)
        if s.filter("NOT done").isEmpty():
            return s.select("e", F.col("to").alias("start"), F.col("c").alias("pos"), F.col("d").alias("depth"))


def build_hierarchy(links: DataFrame, id: str = "id", parent: str = "toid") -> Hierarchy:
    """The forest of links(id, parent), with its circles marked.

    The defined cases: ids and parents compare after trimming; null ids are left out; null parents, those of NO_PARENT and
    those that are no id of links end a path; repeated rows count once, and of an id with several parents the least
    one that is an id holds; nodes in a circle or leading into one are cyclic, with depth -1 and root_id 'CYCLE' in
    `summary`. An empty table gives an empty hierarchy. Other columns are ignored.
    """
    raw = links.select(_clean(F.col(id).cast("string")).alias("id"), _clean(F.col(parent).cast("string")).alias("to")).filter("id IS NOT NULL")
    raw = raw.withColumn("to", F.when(~F.col("to").isin(*NO_PARENT), F.col("to")))
    ids = cut(raw.select("id").distinct().withColumn("v", F.monotonically_increasing_id()))  # the numbers stay as written
    pairs = raw.filter("to IS NOT NULL").distinct().join(ids.select(F.col("id").alias("to"), F.col("v").alias("p")), "to")
    to = pairs.groupBy("id").agg(F.min(F.struct("to", "p")).alias("m")).select("id", F.col("m.p").alias("p"))
    nodes = cut(ids.join(to, "id", "left").select("id", "v", "p"))

    loops = _peel(nodes.select("v", "p")).withColumn("loop", F.lit(True))
    forest = cut(nodes.join(loops, "v", "left").select("id", "v", F.when(F.col("loop").isNull(), F.col("p")).alias("p"), F.coalesce("loop", F.lit(False)).alias("loop")))
    ranked = _rank(_tour(forest.select("v", "p")))
    both = ranked.groupBy(F.expr("e div 2").alias("v")).agg(F.min("pos").alias("enter"), F.max("pos").alias("leave"), F.min("depth").alias("depth"), F.min(F.expr("start div 2")).alias("root"))
    tree = both.join(forest, "v")
    tops = tree.filter("p IS NULL").select(F.col("v").alias("root"), F.col("id").alias("root_id"), F.col("loop").alias("cyclic"))
    return Hierarchy(cut(tree.join(tops, "root").select("id", F.col("v").alias("nid"), F.col("p").alias("parent"), "root", "root_id", "depth", "enter", "leave", "cyclic")))


def _common_ancestors(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(root, a, b), positions in one tour with a < b where nodes are entered: nid of their lowest common ancestor, a row for each pair.

    It is read off the lowest step between the two. A pair asks only the blocks of BLOCK_STEPS steps that its ends are in; the blocks
    between them are covered by two entries of a table of the lowest steps of 1, 2, 4, ... neighbouring blocks.
    """
    steps = nodes.select("root", F.explode(F.array(F.struct(F.col("enter").alias("pos"), F.col("depth").alias("low"), F.col("nid").alias("top")), F.struct(F.col("leave").alias("pos"), (F.col("depth") - 1).alias("low"), F.coalesce("parent", "nid").alias("top")))).alias("x")).select("root", "x.*")
    steps = steps.withColumn("block", F.expr(f"pos div {BLOCK_STEPS}"))
    placed = pairs.withColumn("ba", F.expr(f"a div {BLOCK_STEPS}")).withColumn("bb", F.expr(f"b div {BLOCK_STEPS}"))
    # an ask is for steps lo .. hi of one block
    ends = F.expr(f"if(ba = bb, array(struct(ba AS block, a AS lo, b AS hi)), array(struct(ba AS block, a AS lo, (ba + 1) * {BLOCK_STEPS} - 1 AS hi), struct(bb AS block, bb * {BLOCK_STEPS} AS lo, b AS hi)))")
    asks = placed.select(F.col("root").alias("q_root"), "a", "b", F.explode(ends).alias("q")).select("q_root", F.col("q.block").alias("q_block"), "a", "b", "q.lo", "q.hi")
    far = placed.filter("bb - ba > 1").withColumn("k", F.floor(F.log2(F.col("bb") - F.col("ba") - 1)).cast("int"))
    level = cut(steps.groupBy("root", "block").agg(F.min(F.struct("low", "top")).alias("m")))
    wide, width = level.withColumn("k", F.lit(0)), far.agg(F.max("k")).first()[0]
    for k in range(width or 0):  # as many levels as the longest pair needs; each has a row for a block at most
        level = cut(level.join(level.select("root", (F.col("block") - (1 << k)).alias("block"), F.col("m").alias("m2")), ["root", "block"]).select("root", "block", F.least("m", "m2").alias("m")))
        wide = wide.unionByName(level.withColumn("k", F.lit(k + 1)))
    between = far.select("root", "a", "b", "k", F.explode(F.expr("array(ba + 1, bb - shiftleft(1L, k))")).alias("block")).join(wide, ["root", "block", "k"]).select("root", "a", "b", "m.low", "m.top")
    shape = "root bigint, a bigint, b bigint, low bigint, top bigint"

    def lowest(st, ask):
        import numpy as np
        import pandas as pd

        if not len(ask):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("root", "a", "b", "low", "top")})
        st = st.sort_values("pos")
        pos, low, top = st["pos"].to_numpy(), st["low"].to_numpy(), st["top"].to_numpy()
        lo, hi = np.searchsorted(pos, ask["lo"].to_numpy()), np.searchsorted(pos, ask["hi"].to_numpy(), "right")
        code = np.append(low * (len(pos) + 1) + np.arange(len(pos)), np.iinfo(np.int64).max)
        cuts = np.column_stack([lo, hi]).ravel()
        got = np.minimum.reduceat(code, cuts)[::2] % (len(pos) + 1)
        return pd.DataFrame({"root": ask["q_root"], "a": ask["a"], "b": ask["b"], "low": low[got], "top": top[got]})

    got = steps.groupBy("root", "block").cogroup(asks.groupBy("q_root", "q_block")).applyInPandas(lowest, shape).unionByName(between)
    return got.groupBy("root", "a", "b").agg(F.min(F.struct("low", "top")).alias("m")).select("root", "a", "b", F.col("m.top").alias("nid"))


def upstream_distinct(h: Hierarchy, links: DataFrame, value: str, id: str = "id") -> DataFrame:
    """(nid, n): the number of distinct values at a node and all nodes under it.

    Each distinct (node, value) counts 1 where its node is entered; a value that comes again in the same tour counts -1 at the lowest
    common ancestor of the two neighbouring places, so that every subtree counts it once. The sums over the tour are taken block by
    block. Null values don't count.
    """
    raw = links.select(_clean(F.col(id).cast("string")).alias("id"), F.col(value).alias("value")).filter("id IS NOT NULL AND value IS NOT NULL").distinct()
    at = raw.join(h.nodes.select("id", "nid", "root", "enter"), "id")
    more = at.groupBy("root", "value").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    # only values with several places in one tour need pairs; a value with very many is ordered within blocks of the tour first
    again = at.join(more, ["root", "value"]).withColumn("block", F.expr(f"enter div {BLOCK_STEPS}"))
    again = again.withColumn("a", F.lag("enter").over(Window.partitionBy("root", "value", "block").orderBy("enter")))
    firsts = again.groupBy("root", "value", "block").agg(F.min("enter").alias("enter"), F.max("enter").alias("last"))
    firsts = firsts.withColumn("a", F.lag("last").over(Window.partitionBy("root", "value").orderBy("block"))).select("root", "enter", "a")
    pairs = again.select("root", "enter", "a").unionByName(firsts).filter("a IS NOT NULL").select("root", "a", F.col("enter").alias("b"))
    repeats = pairs.groupBy("root", "a", "b").agg(F.count("*").alias("k"))
    minus = _common_ancestors(h.nodes, repeats.drop("k")).join(repeats, ["root", "a", "b"]).groupBy("nid").agg((-F.sum("k")).alias("w"))
    weight = at.groupBy("nid").agg(F.count("*").alias("w")).unionByName(minus).groupBy("nid").agg(F.sum("w").alias("w"))

    n = h.nodes.select("nid", "root", "enter", "leave").join(weight, "nid", "left").withColumn("w", F.coalesce("w", F.lit(0)))
    steps = n.select("nid", "root", F.explode(F.array(F.struct(F.col("enter").alias("pos"), F.col("w").alias("w"), F.col("w").alias("own"), F.lit(1).alias("side")), F.struct(F.col("leave").alias("pos"), F.lit(0).cast("bigint").alias("w"), F.lit(0).cast("bigint").alias("own"), F.lit(-1).alias("side")))).alias("x")).select("nid", "root", "x.*")
    steps = steps.withColumn("block", F.expr(f"pos div {BLOCK_STEPS}"))
    sums = steps.groupBy("root", "block").agg(F.sum("w").alias("s"))
    carry = sums.withColumn("carry", F.sum("s").over(Window.partitionBy("root").orderBy("block")) - F.col("s")).drop("s")
    run = F.sum("w").over(Window.partitionBy("root", "block").orderBy("pos"))
    steps = steps.withColumn("run", run).join(carry, ["root", "block"]).withColumn("upto", F.col("run") + F.col("carry"))
    # everything counted from the step of entering to that of leaving
    return steps.groupBy("nid").agg(F.sum(-F.col("side") * F.col("upto") + F.col("own")).alias("n"))


def summary(links: DataFrame, id: str = "id", parent: str = "toid", value: str = "divide_id") -> DataFrame:
    """(id, root_id, depth, n_up): one row for each distinct id; see build_hierarchy and upstream_distinct.

    Nodes that never reach a root have root_id 'CYCLE', depth -1 and n_up -1.
    """
    h = build_hierarchy(links, id, parent)
    n = upstream_distinct(h, links, value, id)
    out = h.nodes.join(n, "nid", "left")
    free = ~F.col("cyclic")
    return out.select("id", F.when(free, F.col("root_id")).otherwise(CYCLE).alias("root_id"), F.when(free, F.col("depth")).otherwise(-1).alias("depth"), F.when(free, F.coalesce("n", F.lit(0))).otherwise(-1).cast("bigint").alias("n_up"))


def paths(h: Hierarchy) -> DataFrame:
    """(id, path): the ids from a node down to its root, both included; a null path for cyclic nodes.

    The tour is cut into blocks. A block starts with the nodes that are open at its first step (those whose interval
    spans it) and follows enters and leaves with a stack.
    """
    nodes = h.nodes.filter("NOT cyclic").select("root", "id", "enter", "leave")
    own = nodes.withColumn("block", F.expr(f"enter div {BLOCK_STEPS}"))
    over = nodes.withColumn("block", F.explode(F.expr(f"sequence(enter div {BLOCK_STEPS} + 1, greatest(leave div {BLOCK_STEPS}, enter div {BLOCK_STEPS} + 1))"))).filter(f"block <= leave div {BLOCK_STEPS}")

    def walk(key, pdf):
        import pandas as pd

        first = key[1] * BLOCK_STEPS
        stack: list[tuple[int, str]] = []
        ids, out = [], []
        for enter, leave, node in pdf.sort_values("enter")[["enter", "leave", "id"]].itertuples(index=False):
            while stack and stack[-1][0] < enter:
                stack.pop()
            stack.append((leave, node))
            if enter >= first:
                ids.append(node)
                out.append([x for _, x in reversed(stack)])
        return pd.DataFrame({"id": pd.Series(ids, dtype=object), "path": pd.Series(out, dtype=object)})

    found = own.unionByName(over).groupBy("root", "block").applyInPandas(walk, "id string, path array<string>")
    return found.unionByName(h.nodes.filter("cyclic").select("id", F.lit(None).cast("array<string>").alias("path")))


def _under(h: Hierarchy, of: DataFrame, rows: DataFrame, id: str) -> DataFrame:
    """id and the fields of rows(nid, rows), arrays of structs, for every node under each of of(id), the node itself included.

    Nodes are numbered in the order in which they are entered: before that come as many enters as leaves, and `depth` enters
    more. So the nodes under a node are one range of numbers, and only true pairs are made: the numbers are cut into runs, a
    range asks the runs that it meets, and takes its slice of each. Nodes that start before a run and reach into it lie on one
    path, so their depths differ, and a run with a copy for each COPY_LEVELS levels is asked by few nodes a copy.
    """
    nodes = h.nodes.filter("NOT cyclic").select("nid", "id", "root", "depth", F.expr("(enter + depth) div 2").alias("n"), F.expr("(leave - enter + 1) div 2").alias("m"))
    want = cut(of.select(_clean(F.col(id).cast("string")).alias("id")).distinct().join(nodes.drop("nid"), "id"))
    tasks = max(partitions(h.nodes.sparkSession), (want.agg(F.sum("m")).first()[0] or 0) // TASK_PAIRS + 1)
    asks = want.withColumn("run", F.explode(F.expr(f"sequence(n div {RUN_NODES}, (n + m - 1) div {RUN_NODES})"))).withColumn("copy", F.expr(f"depth div {COPY_LEVELS}"))
    asks = asks.withColumn("lo", F.expr(f"greatest(n - run * {RUN_NODES}, 0L)")).withColumn("many", F.expr(f"least(n + m - run * {RUN_NODES}, {RUN_NODES}L) - lo"))
    asks = asks.select("id", "root", "run", "copy", F.col("lo").cast("int").alias("lo"), F.col("many").cast("int").alias("many"))
    runs = nodes.drop("id").join(rows, "nid").groupBy("root", F.expr(f"n div {RUN_NODES}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("n", "rows"))).alias("run_rows"), F.max("depth").alias("deepest"))
    runs = runs.select("root", "run", F.expr("transform(run_rows, x -> x.rows)").alias("run_rows"), F.explode(F.expr(f"sequence(0L, deepest div {COPY_LEVELS})")).alias("copy"))
    at = ["root", "run", "copy"]
    pairs = asks.repartition(tasks, *at).join(runs.repartition(tasks, *at), at)
    return pairs.select("id", F.inline(F.flatten(F.slice("run_rows", F.col("lo") + 1, F.col("many")))))


def descendants(h: Hierarchy, of: DataFrame, id: str = "id") -> DataFrame:
    """(id, descendant): every node under each of of(id), the node itself included; none for cyclic nodes. See _under."""
    return _under(h, of, h.nodes.select("nid", F.array(F.struct(F.col("id").alias("descendant"))).alias("rows")), id)


def upstream(h: Hierarchy, links: DataFrame, value: str = "divide_id", id: str = "id") -> DataFrame:
    """(id, descendant, value): every node of links with all nodes under it, itself included, and their values.

    The defined cases: a node with several distinct values has a row for each, one without any has a row with null; a node in a
    circle or leading into one, whose `summary` has -1, has one row without descendant and value.
    """
    raw = links.select(_clean(F.col(id).cast("string")).alias("id"), F.col(value).alias("value"))
    values = raw.filter("id IS NOT NULL").groupBy("id").agg(F.collect_set("value").alias("values"))
    rows = h.nodes.select("nid", "id").join(values, "id")
    rows = rows.select("nid", F.expr("transform(if(size(values) = 0, array(null), values), x -> struct(id AS descendant, x AS value))").alias("rows"))
    none = h.nodes.filter("cyclic").select("id", F.lit(None).cast("string").alias("descendant"), F.lit(None).cast(raw.schema["value"].dataType).alias("value"))
    return _under(h, links, rows, id).unionByName(none)
