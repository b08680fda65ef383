"""Conversations as a prefix trie: a z-fast trie in every task, whose expanded edges Spark merges into one trie."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import WORD, bounded_side, stored

FAMILY = 20
MOST_BORROWED = 3
BATCH_TURNS = 200_000
PACKED_IDS = 4096
# Salts of the two lanes of a 128-bit hash.
LANES = (11, 12)


def two_fattest(low: int, high: int) -> int:
    """The number above ``low`` and up to ``high`` that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A compacted node: the edge from depth ``low`` (not included) to ``high``, with a key and a weight for each depth on it."""

    __slots__ = ("low", "keys", "weights", "children", "ended", "least")

    def __init__(self, low: int, keys: list, weights: list) -> None:
        self.low, self.keys, self.weights = low, keys, weights
        self.children: dict = {}
        self.ended, self.least = 0, None  # members that end at the node's extent, and the least of them

    @property
    def high(self) -> int:
        return self.low + len(self.keys)

    def handle(self) -> tuple:
        depth = two_fattest(self.low, self.high)
        return depth, self.keys[depth - self.low - 1]


class ZFastTrie:
    """Paths of prefix keys below a common start, found by fat binary search over the handles of compacted nodes.

    A path is given by the keys of its prefixes (of depth ``start`` + 1, + 2, ...); equal keys mean equal prefixes. The
    handle of a node is its prefix whose depth is the two-fattest number on the node's edge.
    """

    def __init__(self, start: int) -> None:
        self.root = Node(start, [], [])
        self.handles: dict = {}

    def exit_node(self, keys: list) -> Node:
        """The node at whose edge or extent the path leaves the trie, by about log2(len(keys)) probes."""
        start = self.root.low
        node, low, high = self.root, start, start + len(keys)
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get((depth, keys[depth - start - 1]))
            if found is None:
                high = depth - 1
            elif found.high <= start + len(keys) and found.keys[-1] == keys[found.high - start - 1]:
                node, low = found, found.high
            else:
                return found
        rest = node.high - start
        return node.children.get(keys[rest], node) if rest < len(keys) else node

    def insert(self, keys: list, weights: list, member: int) -> None:
        start, size = self.root.low, len(keys)
        node = self.exit_node(keys)
        # how far the edge of the exit node agrees with the path: its keys do up to some depth and not beyond
        low, high = 0, min(len(node.keys), start + size - node.low)
        while low < high:
            middle = (low + high + 1) >> 1
            if node.keys[middle - 1] == keys[node.low + middle - start - 1]:
                low = middle
            else:
                high = middle - 1
        if low < len(node.keys):
            self._split(node, low)
        at = node.high - start
        if at < size:
            leaf = Node(node.high, keys[at:], weights[at:])
            node.children[keys[at]] = leaf
            self.handles[leaf.handle()] = leaf
            node = leaf
        node.ended += 1
        node.least = member if node.least is None else min(node.least, member)

    def _split(self, node: Node, at: int) -> None:
        """``node`` keeps the first ``at`` depths of its edge; a new node takes the rest and all that hung from it."""
        del self.handles[node.handle()]
        lower = Node(node.low + at, node.keys[at:], node.weights[at:])
        lower.children, lower.ended, lower.least = node.children, node.ended, node.least
        node.keys, node.weights = node.keys[:at], node.weights[:at]
        node.children, node.ended, node.least = {lower.keys[0]: lower}, 0, None
        self.handles[node.handle()] = node
        self.handles[lower.handle()] = lower

    def expanded(self) -> Iterator[tuple]:
        """(depth, key, weight, members, least member) of every depth on every edge."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        for node in reversed(order):  # children come after their parent in order
            for child in node.children.values():
                node.ended += child.ended
                if node.least is None or child.least is not None and child.least < node.least:
                    node.least = child.least
        for node in order:
            for i, (key, weight) in enumerate(zip(node.keys, node.weights, strict=True)):
                yield node.low + i + 1, key, weight, node.ended, node.least


_TRIE = "p long, q long, depth long, up long, uq long, words long, n long, conv long"


def _tries(batch_turns: int):
    """Rows of segments (conv, pid) in order of depth, as the expanded nodes of tries over batches of segments."""
    return lambda batches: _expanded_tries(batches, batch_turns)


def _expanded_tries(batches: Iterator[pa.RecordBatch], batch_turns: int) -> Iterator[pa.RecordBatch]:
    tries: dict[tuple, ZFastTrie] = {}
    held, segment, now = 0, [], None
    above: dict = {}  # of each key the key one turn shorter

    def insert() -> None:
        nonlocal held
        start, hung = segment[0][0] - 1, segment[0][3]
        trie = tries.get((start, hung))
        if trie is None:
            trie = tries[start, hung] = ZFastTrie(start)
        trie.insert([s[1] for s in segment], [s[2] for s in segment], now[0])
        for s in segment:
            above[s[1]] = s[3]
        held += len(segment)
        segment.clear()

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held
        rows = [(*key, depth, *above[key], words, n, least) for t in tries.values() for depth, key, words, n, least in t.expanded()]
        tries.clear(), above.clear()
        held = 0
        if rows:
            names = [c.split()[0] for c in _TRIE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    for b in batches:
        conv, pid, depth, words, p, q, up, uq = (c.to_pylist() for c in b.columns)
        for i in range(b.num_rows):
            if now != (conv[i], pid[i]):
                if segment:
                    insert()
                if held >= batch_turns:
                    yield from flush()
                now = (conv[i], pid[i])
            segment.append((depth[i], (p[i], q[i]), words[i], (up[i], uq[i])))
    if segment:
        insert()
    yield from flush()


def _packed(most: int):
    """Sorted (p, q, conv) as rows of up to ``most`` ids of one node, comma-joined."""
    return lambda batches: _packed_ids(batches, most)


def _packed_ids(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    now, ids = None, []
    for b in batches:
        rows: list[tuple] = []
        for p, q, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now != (p, q) or len(ids) == most:
                if ids:
                    rows.append((*now, ids[0], ",".join(map(str, ids))))
                now, ids = (p, q), []
            ids.append(conv)
        if rows:
            yield _ends(rows)
    if ids:
        yield _ends([(*now, ids[0], ",".join(map(str, ids)))])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["p", "q", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, fed piece by piece."""
    now, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([state.hexdigest()])], names=["p", "q", "sha"])

    for b in batches:
        for p, q, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now == (p, q):
                state.update(b"," + ids.encode())
                continue
            if now:
                yield done()
            now, state = (p, q), hashlib.sha256(ids.encode())
    if now:
        yield done()


def _in_ranges(rows: DataFrame, group: str, order: list, label: str) -> DataFrame:
    """``rows`` stored with the number ``pid`` of their range of (group, order): a group of any size is cut into ranges."""
    return stored(rows.repartitionByRange(group, *order).withColumn("pid", F.spark_partition_id()), label)


def turns(rows: DataFrame) -> DataFrame:
    """(conv, rank, x, y, words): turns in order, as 128 bits of role and text; rank counts from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(LANES[0]), role, text).alias("x"),
        F.xxhash64(F.lit(LANES[1]), role, text).alias("y"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")]
    ranged = _in_ranges(narrow, "conv", order, "turns")
    per = ranged.groupBy("conv", "pid").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = bounded_side(per.select("conv", "pid", F.sum("n").over(earlier).alias("before")).filter("before > 0"), "before")
    inside = Window.partitionBy("conv", "pid").orderBy(*order)
    ranked = ranged.withColumn("rank", F.row_number().over(inside).cast("long") - 1).join(before, ["conv", "pid"], "left")
    return stored(ranked.select("conv", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank"), "x", "y", "words"), "ranked")


def rebuilt(ordered: DataFrame, family: int = FAMILY, most: int = MOST_BORROWED) -> tuple[DataFrame, DataFrame]:
    """(conv, size): conversations with the turns they have once rebuilt, and their turns (conv, depth, size, x, y, words).

    The first h turns, h = crc32(conv) mod (``most`` + 1), come from the first conversation of the family.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h")
    count = stored(ordered.groupBy("conv").agg(F.count(F.lit(1)).alias("own")), "sizes")
    lent = count.select(F.col("conv").alias("source"), F.col("own").alias("lent"))
    sizes = count.select("conv", "own", h, F.expr(f"conv - conv % {family}").alias("source")).join(lent, "source", "left")
    sizes = sizes.withColumn("got", F.least("h", F.coalesce("lent", F.lit(0))))
    sizes = stored(sizes.withColumn("size", F.col("got") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "rebuilt-sizes")
    heads = ordered.filter((F.col("rank") < most) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "source")
    taken = sizes.join(heads, "source").filter("rank < h").select("conv", (F.col("rank") + 1).alias("depth"), "size", "x", "y", "words")
    kept = ordered.join(sizes.select("conv", "h", "got", "size"), "conv").filter("rank >= h")
    kept = kept.select("conv", F.expr("rank - h + got + 1").alias("depth"), "size", "x", "y", "words")
    return sizes.select("conv", "size"), taken.unionByName(kept)


def paths(rows: DataFrame) -> DataFrame:
    """(conv, pid, depth, size, words, p, q, up, uq): every prefix by two 64-bit lanes, and the prefix one turn shorter.

    A lane is the exclusive or of hashes of (depth, turn), so prefixes of a long conversation are computed range by
    range and only one value per range and conversation is carried on.
    """
    term = {c: F.xxhash64(F.lit(salt), "depth", "x", "y") for c, salt in zip(("s", "t"), LANES, strict=True)}
    ranged = _in_ranges(rows.select("conv", "depth", "size", "words", *[e.alias(c) for c, e in term.items()]), "conv", ["depth"], "prefixes")
    per = ranged.groupBy("conv", "pid").agg(F.bit_xor("s").alias("s"), F.bit_xor("t").alias("t"))
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("conv", "pid", F.bit_xor("s").over(earlier).alias("s0"), F.bit_xor("t").over(earlier).alias("t0")).filter("s0 IS NOT NULL")
    inside = Window.partitionBy("conv", "pid").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({"p": F.bit_xor("s").over(inside), "q": F.bit_xor("t").over(inside)})
    whole = summed.join(bounded_side(before, "before"), ["conv", "pid"], "left")
    whole = whole.withColumns({c: F.col(c).bitwiseXOR(F.coalesce(z, F.lit(0))) for c, z in (("p", "s0"), ("q", "t0"))})
    return stored(whole.select("conv", "pid", "depth", "size", "words", "p", "q", F.expr("p ^ s").alias("up"), F.expr("q ^ t").alias("uq")), "paths")


def _subtree_sums(nodes: DataFrame, prefixes: DataFrame, deepest: int) -> DataFrame:
    """(p, q, leaves, saved) summed over subtrees, by doubling: after k rounds a node has what lies less than 2**k below.

    The ancestor 2**k above a node is the prefix of its least member so much shorter, so no round depends on how
    many nodes share an ancestor, and the rounds grow with the logarithm of the depth.
    """
    now, reach = nodes.select("p", "q", "conv", "depth", "leaves", "saved"), 1
    places = prefixes.select("conv", F.col("depth").alias("to"), F.col("p").alias("ap"), F.col("q").alias("aq"))
    while reach <= deepest:
        below = now.filter(F.col("depth") >= reach).withColumn("to", F.col("depth") - reach)
        at_root = below.filter("to = 0").select(F.lit(0).cast("long").alias("ap"), F.lit(0).cast("long").alias("aq"), "leaves", "saved")
        others = below.filter("to > 0").join(places, ["conv", "to"]).select("ap", "aq", "leaves", "saved")
        given = others.unionAll(at_root).groupBy(F.col("ap").alias("p"), F.col("aq").alias("q")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        joined = now.join(given, ["p", "q"], "left")
        plus = {"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0))}
        now = stored(joined.withColumns(plus).select("p", "q", "conv", "depth", "leaves", "saved"), "subtrees")
        reach *= 2
    return now.select("p", "q", "leaves", "saved")


def prefix_trie(
    rows: DataFrame, family: int = FAMILY, most: int = MOST_BORROWED, batch_turns: int = BATCH_TURNS, packed_ids: int = PACKED_IDS
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Every task inserts its conversations, in batches, into z-fast tries and sends the expanded edges with the number
    of members, so that a prefix which many conversations share is one row for each batch; Spark adds these up.
    Prefixes are told apart by 128-bit hashes of their roles and texts.

    Nulls: a null role or text is empty, a null turn comes first; rows without a conv_id belong to no conversation and
    make no node. Turns with equal numbers are ordered by the hash of role and text, so repeated rows lie side by side.
    Texts are only hashed and counted, whatever their length. A conversation of any number of turns is cut into ranges
    of rows; only the ids hashed into one digest pass through one task, ``packed_ids`` a row, as a digest is sequential. No rows: no
    nodes. Other columns are not read, whatever their names.
    """
    sizes, turns_of = rebuilt(turns(rows), family, most)
    prefixes = paths(turns_of)
    total, least, deepest = sizes.agg(F.count(F.lit(1)), F.min("conv"), F.max("size")).first()
    segments = prefixes.repartition("conv", "pid").sortWithinPartitions("conv", "pid", "depth")
    found = segments.select("conv", "pid", "depth", "words", "p", "q", "up", "uq").mapInArrow(_tries(batch_turns), _TRIE)
    same = [F.max(c).alias(c) for c in ("depth", "up", "uq", "words")]
    merged = found.groupBy("p", "q").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *same)
    spark = rows.sparkSession
    top = spark.createDataFrame([(0, 0, total, least, 0, None, None, 0)] if total else [], "p long, q long, n long, conv long, depth long, up long, uq long, words long")
    nodes = stored(merged.unionByName(top), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("up").alias("p"), F.col("uq").alias("q")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["p", "q"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = {"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n") - 1) * F.col("words")}
    nodes = stored(nodes.withColumns(own), "trie")
    sums = _subtree_sums(nodes, prefixes, deepest or 0)
    ended = prefixes.filter("depth = size").select("p", "q", "conv")
    zero = F.lit(0).cast("long")
    ended = ended.unionAll(sizes.filter("size = 0").select(zero.alias("p"), zero.alias("q"), "conv"))
    packed = ended.repartitionByRange("p", "q", "conv").sortWithinPartitions("p", "q", "conv").mapInArrow(_packed(packed_ids), "p long, q long, first long, ids string")
    digests = packed.repartition("p", "q").sortWithinPartitions("p", "q", "first").select("p", "q", "ids").mapInArrow(_digested, "p long, q long, sha string")
    parents = nodes.select(F.col("p").alias("up"), F.col("q").alias("uq"), F.col("conv").alias("parent"))
    # children of the root need no lookup, so that they don't meet at one key
    deeper = nodes.filter("depth > 1").join(parents, ["up", "uq"])
    first = nodes.filter("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(least)).cast("long"))
    whole = deeper.unionByName(first).drop("leaves", "saved").join(sums, ["p", "q"]).join(digests, ["p", "q"], "left")
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt in families of 20."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = """
WITH original AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), counted AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 20 AS source,
         [CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps
  FROM original GROUP BY conv_id
), sizes AS (
  SELECT conv_id, own, source,
         xor(list_reduce(steps, lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
                                                       ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295) % 4 AS h
  FROM counted
), rebuilt AS (
  SELECT s.conv_id, o.i + 1 AS d, o.role, o.text FROM sizes s JOIN original o ON o.conv_id = s.source AND o.i < s.h
  UNION ALL
  SELECT s.conv_id, o.i - s.h + 1 + least(s.h, coalesce(l.own, 0)) AS d, o.role, o.text
  FROM sizes s JOIN original o ON o.conv_id = s.conv_id AND o.i >= s.h LEFT JOIN sizes l ON l.conv_id = s.source
), members AS (
  SELECT conv_id, 0 AS d, '' AS k, 0 AS words FROM sizes
  UNION ALL
  SELECT conv_id, d,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d) AS k,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt
), lengths AS (
  SELECT conv_id, max(d) AS m FROM members GROUP BY conv_id
), nodes AS (
  SELECT m.k, m.d, min(m.conv_id) AS conv, count(*) AS n, (count(*) - 1) * max(m.words) AS saved,
         coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (WHERE l.m = m.d), '') AS ended
  FROM members m JOIN lengths l ON l.conv_id = m.conv_id GROUP BY m.k, m.d
), linked AS (
  SELECT n.*, u.k AS uk FROM nodes n LEFT JOIN members u ON u.conv_id = n.conv AND u.d = n.d - 1
), children AS (
  SELECT uk AS k, d - 1 AS d, count(*) AS c FROM linked WHERE d > 0 GROUP BY 1, 2
), full_nodes AS (
  SELECT n.*, coalesce(c.c, 0) AS c FROM linked n LEFT JOIN children c ON c.k = n.k AND c.d = n.d
), sums AS (
  SELECT a.k, a.d, CAST(sum(CASE WHEN n.c = 0 THEN 1 ELSE 0 END) AS BIGINT) AS leaves, CAST(sum(n.saved) AS BIGINT) AS saved
  FROM full_nodes n JOIN members a ON a.conv_id = n.conv AND a.d <= n.d GROUP BY a.k, a.d
)
SELECT n.conv AS conv_id, CAST(n.d AS BIGINT) AS depth, u.conv AS parent_conv_id, n.n AS n_convs, n.c AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM full_nodes n JOIN sums s ON s.k = n.k AND s.d = n.d LEFT JOIN nodes u ON u.k = n.uk AND u.d = n.d - 1
"""
