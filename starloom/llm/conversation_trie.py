"""Prefix trie of conversations: a z-fast trie kept in tables, filled in batches, its edges expanded at the end.

A conversation is a string of turns; a prefix is known by its depth and a 128-bit fingerprint, the exclusive or of hashes
that hold the place of each turn. The compacted trie has nodes where strings end or part; a node stands for the edge
(p, e] from its parent's depth to its own, and lies on the path of the string (`rep`) that made the edge, so (rep, e)
names it and the root is (0, 0). The handle of a node is its prefix at the 2-fattest depth of (p, e]: the multiple of the
largest power of two in there.

Strings find their exit node by fat binary search: the 2-fattest depth of what is left of (0, length] is looked up
among the handles; a hit moves the lower end to the depth of the node, a miss the upper end below the probe. All strings
search at once, a probe is a join, and a search takes as many as the length has binary digits.

A batch inserts one string for every place where strings leave the trie for the same next turn, the first by hash. The
others search again in the next batch, from a trie that holds a random one of them, which leaves a string half of its
company on average: the number of batches grows with the logarithm of the number of strings that share a turn.

Sums over subtrees double the distance they reach each turn. No step gathers the turns of a conversation, the members of
a node or the children of a turn in one task; the list behind a digest is streamed through one in bounded blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import give_back, written
from starloom.operators.skew import Columns, split_points, windows

HEAD = 6  # a conversation takes fewer turns than this from the first of its hundred
BLOCK = 1 << 16  # turns of a conversation that one task sees together
RUN = 4096  # numbers made at once where a row is multiplied
IDS = 13  # binary digits of the ids in a block of a digest's list
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOBODY = hashlib.sha256(b"").hexdigest()


def spread(df: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """A row for every whole number from `low` to `high`, made in runs; none where low is above high."""
    rows = df.withColumns({"_low": low.cast("long"), "_high": high.cast("long")}).filter("_low <= _high")
    runs = rows.withColumn("_run", F.explode(F.expr(f"sequence(_low div {RUN}, _high div {RUN})")))
    return runs.withColumn(name, F.explode(F.expr(f"sequence(greatest(_low, _run * {RUN}), least(_high, _run * {RUN} + {RUN - 1}))"))).drop("_low", "_high", "_run")


# --- conversations as strings of turns ---------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, before, n, x, y, size): equal turns of a conversation in a row, with the number of turns before them.

    Turns are ordered by `turn`, null first, ties by a hash of role and text. x and y are hashes of both, null as empty,
    size the code points of the text. A conversation of any length is cut at split points, not gathered.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.struct(F.xxhash64(F.lit(1), role, text).alias("x"), F.xxhash64(F.lit(2), text, role).alias("y")).alias("hash"), F.length(text).cast("long").alias("size"),
    )
    folded = written(rows.groupBy("conv_id", "turn", "hash").agg(F.max("size").alias("size"), F.count("*").alias("n")), "turns")
    columns = Columns("conv_id", "turn", "hash", "n")
    points = written(split_points(folded, "conv_id", {"by_time": columns.by_time()}), "points")
    placed = windows(folded, columns, points)
    return placed.select("conv_id", (F.col("running") - F.col("n")).alias("before"), "n", F.col("hash.x").alias("x"), F.col("hash.y").alias("y"), "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, x, y, size): turns of every rebuilt conversation, from depth 1; turnless ones have depth 0.

    A conversation c takes the first h turns of c - c % 100, h being crc32 of its decimal id modulo 6, then its own turns
    after the first h.
    """
    turns = written(turns, "numbered")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    ids = turns.groupBy("conv_id").agg(F.sum("n").alias("turns")).withColumns({"h": h, "first": F.col("conv_id") - F.col("conv_id") % 100})
    first = spread(turns.filter(F.col("before") < HEAD - 1), F.lit(1), F.least("n", HEAD - 1 - F.col("before")), "k")
    turn = F.struct((F.col("before") + F.col("k")).alias("depth"), "x", "y", "size")
    heads = first.groupBy(F.col("conv_id").alias("first")).agg(F.array_sort(F.collect_list(turn)).alias("head"))
    given = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    ids = ids.join(heads, "first", "left").withColumn("given", F.greatest(given, F.lit(0)))
    ids = written(ids.withColumn("length", F.col("given") + F.greatest(F.lit(0), F.col("turns") - F.col("h"))).select("conv_id", "h", "given", "length", "head"), "conversations")
    names = ["conv_id", "length", "depth", "x", "y", "size"]
    taken = ids.filter("given > 0").withColumn("t", F.explode(F.slice("head", F.lit(1), F.col("given").cast("int")))).select("conv_id", "length", "t.depth", "t.x", "t.y", "t.size")
    mine = turns.join(ids.select("conv_id", "h", "given", "length"), "conv_id")
    own = spread(mine, F.greatest(F.col("before"), F.col("h")) + 1, F.col("before") + F.col("n"), "place").withColumn("depth", F.col("place") - F.col("h") + F.col("given")).select(*names)
    nothing = ids.filter("length = 0").select("conv_id", "length", *[F.lit(0).cast("long").alias(c) for c in names[2:]])
    return taken.select(*names).union(own).union(nothing)


def prefixes(rows: DataFrame) -> DataFrame:
    """Fingerprint (x, y) of every prefix, that of the prefix before it (px, py), and the code points up to both.

    Conversations are summed in blocks of turns; only those longer than a block need the totals of the blocks before.
    """
    hashed = rows.select(
        "conv_id", "length", "depth", "size", F.shiftright("depth", BLOCK.bit_length() - 1).alias("block"),
        *[F.when(F.col("depth") > 0, F.xxhash64(F.lit(k), "depth", "x", "y")).otherwise(F.lit(0).cast("long")).alias(name) for k, name in ((1, "hx"), (2, "hy"))],
    )
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = hashed.withColumns({"lx": F.bit_xor("hx").over(here), "ly": F.bit_xor("hy").over(here), "lsize": F.sum("size").over(here)})
    totals = hashed.filter(F.col("length") >= BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("hx").alias("tx"), F.bit_xor("hy").alias("ty"), F.sum("size").alias("tsize"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = totals.select("conv_id", "block", *[F.coalesce(f(c).over(before), zero).alias(c) for f, c in ((F.bit_xor, "tx"), (F.bit_xor, "ty"), (F.sum, "tsize"))])
    joined = local.join(carried, ["conv_id", "block"], "left")
    x, y = (F.col(f"l{c}").bitwiseXOR(F.coalesce(f"t{c}", zero)) for c in "xy")
    upto = F.col("lsize") + F.coalesce("tsize", zero)
    return joined.select(
        "conv_id", "length", "depth", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("hx")).alias("px"), y.bitwiseXOR(F.col("hy")).alias("py"),
        upto.alias("upto"), (upto - F.col("size")).alias("until"),
    )


# --- the trie ------------------------------------------------------------------------------------------


def fattest(a: str, b: str) -> Column:
    """The multiple of the largest power of two in (a, b]; null if that is empty."""
    return F.expr(f"if({a} < {b}, shiftleft(shiftright({b}, length(bin({a} ^ {b})) - 1), length(bin({a} ^ {b})) - 1), NULL)")


class Trie:
    """Tables of the trie over `strings` (sid, length, x, y) and their prefixes (sid, depth, x, y, px, py, upto, until)."""

    def __init__(self, strings: DataFrame, prefix: DataFrame):
        self.strings, self.prefix = strings, prefix
        spark = strings.sparkSession
        # Paths of inserted strings: they leave the node (up, start); breaks: where nodes are on them.
        self.paths = spark.createDataFrame([], "rep long, start long, length long, up long")
        self.breaks = spark.createDataFrame([], "rep long, e long")
        self.ends = spark.createDataFrame([], "sid long, rep long, e long")

    def edges(self) -> DataFrame:
        """(rep, p, e, up): an edge for each break of a path. Breaks of one path share its turns up to each, so m of them take some m * m / 2 turns of input."""
        along = Window.partitionBy("rep").orderBy("e")
        return self.breaks.join(self.paths, "rep").select("rep", F.coalesce(F.lag("e").over(along), "start").alias("p"), "e", "start", "up")

    def _keyed(self, rows: DataFrame, sid: str, depth: Column, names: dict[str, str]) -> DataFrame:
        """Add columns of the prefix of a string at a depth, null where there is none. All lookups shuffle the same table the same way."""
        found = self.prefix.select(*[F.col(c).alias(f"_{c}") for c in ("sid", "depth", "x", "y", "px", "py")])
        wanted = rows.withColumn("_at", depth.cast("long"))
        joined = wanted.join(found, (F.col(sid) == F.col("_sid")) & (F.col("_at") == F.col("_depth")), "left")
        return joined.select(*rows.columns, *[F.col(f"_{c}").alias(n) for n, c in names.items()])

    def handles(self) -> DataFrame:
        """Edges with the handle (f, hx, hy), the whole prefix (ex, ey) and the first one beyond the parent (fx, fy)."""
        edges = self.edges().withColumn("f", fattest("p", "e"))
        edges = self._keyed(edges, "rep", F.col("f"), {"hx": "x", "hy": "y"})
        edges = self._keyed(edges, "rep", F.col("e"), {"ex": "x", "ey": "y"})
        return self._keyed(edges, "rep", F.col("p") + 1, {"fx": "x", "fy": "y"})

    def located(self, waiting: DataFrame, longest: int) -> DataFrame:
        """(sid, length, rep, e): where each string leaves the trie, a depth e on the path of rep, or of the root (0, 0)."""
        handles = written(self.handles(), "handles")
        node = ["rep", "p", "e", "ex", "ey"]
        listed = handles.select(F.col("f").alias("_f"), F.col("hx").alias("_hx"), F.col("hy").alias("_hy"), *[F.col(c).alias(f"_{c}") for c in node])
        zero = F.lit(0).cast("long")
        rows = waiting.select("sid", "length", "x", "y", zero.alias("a"), F.col("length").alias("b"), *[zero.alias(c) for c in node])
        for _ in range(max(1, longest.bit_length())):
            probe = self._keyed(rows.withColumn("f", fattest("a", "b")), "sid", F.col("f"), {"qx": "x", "qy": "y"})
            hit = probe.join(listed, (F.col("f") == F.col("_f")) & (F.col("qx") == F.col("_hx")) & (F.col("qy") == F.col("_hy")), "left")
            found = F.col("_e").isNotNull()
            moved = {c: F.coalesce(f"_{c}", c) for c in node}
            rows = hit.select("sid", "length", "x", "y", F.coalesce("_e", "a").alias("a"), F.when(found | F.col("f").isNull(), F.col("b")).otherwise(F.col("f") - 1).alias("b"), *[v.alias(c) for c, v in moved.items()])
        # The node found is the exit node if the string does not hold all of its prefix, else the exit is at it or on an edge below.
        rows = self._keyed(rows, "sid", F.col("e") + 1, {"nx": "x", "ny": "y", "mx": "px", "my": "py"})
        at_end = F.col("e") == F.col("length")
        whole = (F.when(at_end, F.col("x")).otherwise(F.col("mx")) == F.col("ex")) & (F.when(at_end, F.col("y")).otherwise(F.col("my")) == F.col("ey"))
        rows = rows.withColumn("below", (F.col("e") == 0) | F.coalesce(whole, F.lit(False)))
        first = handles.select((F.col("p") + 1).alias("_d"), F.col("fx").alias("_fx"), F.col("fy").alias("_fy"), F.col("rep").alias("_rep"), F.col("p").alias("_p"), F.col("e").alias("_e"))
        same = F.col("below") & (F.col("e") + 1 == F.col("_d")) & (F.col("nx") == F.col("_fx")) & (F.col("ny") == F.col("_fy"))
        rows = rows.join(first, same, "left")
        on_edge = ~F.col("below") | F.col("_e").isNotNull()
        rows = written(rows.select("sid", "length", on_edge.alias("on_edge"), F.coalesce("_rep", "rep").alias("rep"), F.coalesce("_p", "p").alias("p"), F.coalesce("_e", "e").alias("e")), "searched")
        # On an edge the first turn agrees; count the others that do.
        edge = rows.filter("on_edge")
        steps = spread(edge, F.col("p") + 2, F.least("e", "length"), "d").select("sid", "rep", "d")
        steps = self._keyed(self._keyed(steps, "sid", F.col("d"), {"ax": "x", "ay": "y"}), "rep", F.col("d"), {"bx": "x", "by": "y"})
        agree = steps.filter("ax = bx AND ay = by").groupBy("sid").agg(F.count("*").alias("agree"))
        left = edge.join(agree, "sid", "left").withColumn("e", F.col("p") + 1 + F.coalesce("agree", F.lit(0)))
        return left.select("sid", "length", "rep", "e").union(rows.filter("NOT on_edge").select("sid", "length", "rep", "e"))

    def fill(self) -> Trie:
        waiting, empty = self.strings, True
        while True:
            longest = waiting.agg(F.max("length")).first()[0]
            if longest is None:
                return self
            zero = F.lit(0).cast("long")
            rows = waiting.select("sid", "length", zero.alias("rep"), zero.alias("e")) if empty else self.located(waiting, longest)
            rows = written(self._keyed(rows, "sid", F.col("e") + 1, {"nx": "x", "ny": "y"}), "exits")
            inside, away = rows.filter("e = length"), rows.filter("e < length")
            one = F.min(F.struct(F.xxhash64("sid").alias("h"), "sid", "length", "rep", "e")).alias("one")
            chosen = written(away.groupBy("e", "nx", "ny").agg(one).select("one.sid", "one.length", "one.rep", "one.e"), "inserted")
            new_paths = chosen.select(F.col("sid").alias("rep"), F.col("e").alias("start"), "length", F.col("rep").alias("up"))
            splits = inside.select("rep", "e").union(chosen.filter("e > 0").select("rep", "e")).union(chosen.select("sid", "length"))
            self.paths = written(self.paths.union(new_paths), "paths")
            self.breaks = written(self.breaks.union(splits).distinct(), "breaks")
            self.ends = written(self.ends.union(inside.select("sid", "rep", "e")).union(chosen.select("sid", F.col("sid"), "length")), "ends")
            waiting = written(away.join(chosen.select("sid"), "sid", "left_anti").select("sid").join(self.strings, "sid"), "waiting")
            empty = False


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Sums over the subtree of each node (rep, e) with parent (up, p): n, total, leaves, length, and the least conv_id.

    In each turn a node gives what it has gathered to the node at twice the distance of the turn before.
    """
    sums = ["n", "total", "leaves", "length"]
    state = nodes.select("rep", "e", F.when(F.col("p") > 0, F.struct(F.col("up").alias("rep"), F.col("p").alias("e"))).alias("jump"), *sums, "conv_id")
    while True:
        state = written(state, "subtrees")
        if state.filter("jump IS NOT NULL").isEmpty():
            return state.drop("jump")
        given = state.filter("jump IS NOT NULL").groupBy(F.col("jump.rep").alias("rep"), F.col("jump.e").alias("e"))
        given = given.agg(*[F.sum(c).alias(f"g_{c}") for c in sums], F.min("conv_id").alias("g_conv_id"))
        more = state.join(given, ["rep", "e"], "left").select(
            "rep", "e", "jump", *[(F.col(c) + F.coalesce(f"g_{c}", F.lit(0).cast("long"))).alias(c) for c in sums], F.least("conv_id", "g_conv_id").alias("conv_id")
        )
        target = state.select(F.col("rep").alias("_rep"), F.col("e").alias("_e"), F.col("jump").alias("_jump"))
        state = more.join(target, (F.col("jump.rep") == F.col("_rep")) & (F.col("jump.e") == F.col("_e")), "left").select("rep", "e", F.col("_jump").alias("jump"), *sums, "conv_id")


def _digests(members: DataFrame) -> DataFrame:
    """(sid, digest): SHA-256 of the ascending conv_ids of each string, comma-joined.

    Ids are put into blocks by their leading digits, so a block is bounded however many conversations are equal; one
    task streams the blocks of a string, holding one at a time.
    """
    block = F.shiftright("conv_id", IDS)
    blocks = members.groupBy("sid", block.alias("block")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, digest = None, None
        for batch in batches:
            done = []
            for s, ids in zip(batch["sid"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if s != sid:
                    if digest:
                        done.append((sid, digest.hexdigest()))
                    sid, digest = s, hashlib.sha256()
                    digest.update(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pydict({"sid": [s for s, _ in done], "digest": [d for _, d in done]})
        if digest:
            yield pa.RecordBatch.from_pydict({"sid": [sid], "digest": [digest.hexdigest()]})
        give_back()

    return blocks.repartition("sid").sortWithinPartitions("sid", "block").select("sid", "ids").mapInArrow(stream, "sid long, digest string")


def nodes(conversations: DataFrame) -> DataFrame:
    """A row for every distinct sequence of first turns of the rebuilt conversations, from the root of depth 0.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Rows without conv_id take
    no part; null roles and texts count as empty; equal rows are turns each; texts of any length and extra columns of any
    name do no harm; without conversations there is no node. Prefixes are told apart by a 128-bit fingerprint.
    """
    table = written(prefixes(rebuilt(numbered(conversations))), "prefixes")
    last = table.filter("depth = length").select("conv_id", "length", "x", "y", "upto")
    strings = written(last.groupBy("length", "x", "y").agg(F.min("conv_id").alias("sid"), F.count("*").alias("n"), F.max("upto").alias("upto")), "strings")
    members = written(last.join(strings.select("length", "x", "y", "sid"), ["length", "x", "y"]).select("sid", "conv_id"), "members")
    digests = written(_digests(members), "digests")
    own = table.join(strings.filter("length > 0").select(F.col("sid").alias("conv_id")), "conv_id", "left_semi")
    prefix = written(own.withColumnRenamed("conv_id", "sid").drop("length"), "own-prefixes")
    trie = Trie(strings.filter("length > 0"), prefix).fill()

    # Compacted nodes: what ends there, their children, the code points of their edges.
    edges = written(trie.edges().withColumn("up", F.when(F.col("p") == F.col("start"), F.col("up")).otherwise(F.col("rep"))).select("rep", "p", "e", "up"), "edges")
    children = edges.groupBy(F.col("up").alias("rep"), F.col("p").alias("e")).agg(F.count("*").alias("children"))
    ended = trie.ends.join(strings.select("sid", "n", "upto"), "sid").join(digests, "sid").select("rep", "e", "sid", "n", (F.col("n") * F.col("upto")).alias("total"), "digest")
    zero = F.lit(0).cast("long")
    upto = prefix.select(F.col("sid").alias("_sid"), F.col("depth").alias("_depth"), "upto", "until")

    def with_size(rows: DataFrame, depth: Column, name: str, column: str) -> DataFrame:
        found = rows.withColumn("_at", depth).join(upto.select("_sid", "_depth", F.col(column).alias(name)), (F.col("rep") == F.col("_sid")) & (F.col("_at") == F.col("_depth")), "left")
        return found.drop("_sid", "_depth", "_at")

    compact = edges.join(ended, ["rep", "e"], "left").join(children, ["rep", "e"], "left")
    compact = with_size(with_size(compact, F.col("e"), "upto_e", "upto"), F.col("p") + 1, "upto_p", "until")
    compact = written(
        compact.select("rep", "p", "e", "up", "digest", "upto_p", F.coalesce("n", zero).alias("n"), F.coalesce("total", zero).alias("total"), F.coalesce("children", zero).alias("children"), F.col("children").isNull().cast("long").alias("leaves"), (F.col("upto_e") - F.col("upto_p")).alias("length"), F.col("sid").alias("conv_id")),
        "compact",
    )
    sums = _subtrees(compact)
    known = written(compact.select("rep", "p", "e", "up", "digest", "upto_p", "children").join(sums, ["rep", "e"]), "nodes")
    # The root is one row of sums.
    whole = known.filter("p = 0").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "total", "leaves", "length")], F.count("*").alias("children"), F.min("conv_id").alias("conv_id")).first()
    turnless = strings.filter("length = 0").join(digests, "sid").agg(F.max("sid").alias("sid"), F.coalesce(F.max("n"), zero).alias("n"), F.max("digest").alias("digest")).first()
    ids = [i for i in (whole["conv_id"], turnless["sid"]) if i is not None]
    top = [(min(ids), 0, None, whole["n"] + turnless["n"], whole["children"], whole["leaves"] or 1, whole["total"] - whole["length"], turnless["digest"] or NOBODY)] if ids else []
    root = conversations.sparkSession.createDataFrame(top, NODE)

    # Edges become nodes again: of all members, and the same children but for the last.
    above = known.select(F.col("rep").alias("_up"), F.col("e").alias("_p"), F.col("conv_id").alias("_conv"))
    named = known.join(above, (F.col("up") == F.col("_up")) & (F.col("p") == F.col("_p")), "left").withColumn("_root", F.lit(min(ids, default=None)).cast("long"))
    each = with_size(spread(named, F.col("p") + 1, F.col("e"), "depth"), F.col("depth"), "before", "until")
    at_node, at_top = F.col("depth") == F.col("e"), F.col("depth") == F.col("p") + 1
    saved = F.col("total") - F.col("n") * F.col("before") - (F.col("length") - (F.col("before") - F.col("upto_p")))
    grown = each.select(
        "conv_id", "depth", F.when(~at_top, F.col("conv_id")).when(F.col("p") == 0, F.col("_root")).otherwise(F.col("_conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(at_node, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce(F.when(at_node, F.col("digest")), F.lit(NOBODY)).alias("ends_sha256"),
    )
    return root.union(grown)
