"""The prefix trie of conversations by vertical bitmaps.

Conversations are put in order of their ids and cut into shards of neighbouring ids. A
shard indexes every (position, turn) to the bitset of its conversations that have that
turn there. A depth-first walk starts from all conversations and intersects a node's bitset
with the postings of the next position: every non-empty intersection is a child, its
bits are the members and their count, and the bits of conversations that end there are
the end list, in order of the ids. Shards leave one row per node, and nodes that several
shards have found are put together.

A node is named by the sum modulo two of two 64-bit hashes of (position, turn) over its
path, so any stretch of a conversation gives its share of the name by itself: long
conversations are cut into stretches of ``SPAN`` turns, each walked on its own from the
node the earlier stretches lead to. A node all of whose members lie in one shard gets its
subtree sums there. For the others, which form the top of the tree, the sums are found by
pointer doubling: in round k a node hands its sum to the ancestor 2**k steps above,
which takes as many rounds as the depth of that top has binary digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import lookup, partitions, prefix_sums
from barline.plans import land

FAMILY = 100
HEADS = 6
SPAN = 4096
# Conversations and turns of one shard.
SHARD = 4096
SHARD_TURNS = 65_536
EMPTY = hashlib.sha256(b"").hexdigest()


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family: the CRC-32 of
    its decimal number, modulo ``HEADS``."""
    return F.crc32(conv.cast("string")) % F.lit(HEADS)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """One row per turn of the rebuilt conversations: ``_conv``, ``_pos``, ``_digest``,
    ``_chars``; a conversation without turns has one row with a null position."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = land(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("bigint").alias("_conv"),
            F.col("turn").alias("_turn"),
            F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias(
                "_digest"
            ),
            F.char_length(text).cast("bigint").alias("_chars"),
            F.monotonically_increasing_id().alias("_row"),
            F.lit(1).alias("_one"),
        ),
        "turns",
    )
    # Numbered over the whole table, then from the first row of the conversation.
    numbered = prefix_sums(turns, ["_conv", "_turn", "_digest", "_row"], {"_at": "_one"}, "ordered-turns")
    first = numbered.groupBy("_conv").agg(F.min("_at").alias("_first"))
    placed = land(
        lookup(numbered, first, ["_conv"], "_part").select(
            "_conv", "_part", (F.col("_at") - F.col("_first") + 1).alias("_pos"), "_digest", "_chars"
        ),
        "placed-turns",
    )
    base = F.col("_conv") - F.col("_conv") % F.lit(FAMILY)
    heads = (
        placed.where((F.col("_conv") == base) & (F.col("_pos") < HEADS))
        .groupBy(F.col("_conv").alias("_base"))
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_digest", "_chars"))).alias("_head"))
    )
    families = land(
        first.select("_conv", base.alias("_base"), head_length(F.col("_conv")).alias("_h"))
        .join(heads.withColumn("_size", F.size("_head")), "_base", "left")
        .withColumn("_taken", F.coalesce(F.least("_h", "_size"), F.lit(0)))
        .withColumn("_head", F.when(F.col("_taken") > 0, F.slice("_head", F.lit(1), F.col("_taken").cast("int"))))
        .select("_conv", "_h", "_taken", "_head"),
        "families",
    )
    own = (
        lookup(placed, families.select("_conv", "_h", "_taken"), ["_conv"], "_part")
        .where(F.col("_pos") > F.col("_h"))
        .select("_conv", (F.col("_taken") + F.col("_pos") - F.col("_h")).alias("_pos"), "_digest", "_chars")
    )
    lent = families.select("_conv", F.explode_outer("_head").alias("_t")).select(
        "_conv", F.col("_t._pos").alias("_pos"), F.col("_t._digest").alias("_digest"), F.col("_t._chars").alias("_chars")
    )
    return own.unionByName(lent)


def stretches(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per conversation and stretch of ``span`` turns: the names of its turns, their
    lengths, the name of the path before it, and whether the conversation ends in it."""
    names = {f"_d{s}": F.xxhash64(F.lit(s), F.col("_pos"), F.col("_digest")) for s in (1, 2)}
    known = F.col("_pos").isNotNull()
    parts = land(
        turns.withColumns(names)
        .withColumn("_seg", F.coalesce(F.floor((F.col("_pos") - 1) / F.lit(span)), F.lit(0)))
        .groupBy("_conv", "_seg")
        .agg(
            F.array_sort(F.collect_list(F.when(known, F.struct("_pos", "_d1", "_d2", "_chars")))).alias("_t"),
            *[F.bit_xor(F.when(known, F.col(d))).alias(f"_x{d}") for d in names],
        ),
        "stretches",
    )
    path = Window.partitionBy("_conv").orderBy("_seg")
    before = path.rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_conv",
        "_seg",
        *[F.coalesce(F.bit_xor(f"_x{d}").over(before), F.lit(0)).alias(f"_b{d[-1]}") for d in names],
        F.lead("_seg").over(path).isNull().alias("_ends"),
    )
    return parts.join(starts, ["_conv", "_seg"]).select(
        "_seg",
        "_conv",
        "_b1",
        "_b2",
        "_ends",
        *[F.col(f"_t.{c}").alias(c) for c in ("_d1", "_d2", "_chars")],
    )


_NODE = {
    "k1": "bigint",
    "k2": "bigint",
    "p1": "bigint",
    "p2": "bigint",
    "depth": "bigint",
    "conv": "bigint",
    "up": "bigint",
    "n": "bigint",
    "chars": "bigint",
    "kids": "bigint",
    "leaves": "bigint",
    "saved": "bigint",
    "unfinished": "boolean",
    "ends": "string",
}


def shard_nodes(rows: list[tuple], seg: int, span: int = SPAN) -> list[list]:
    """The nodes of one shard; ``rows`` are (conv, b1, b2, ends, d1, d2, chars) by conv.

    Bit i of a bitset is row i, so the lowest bit is the smallest id.
    """
    postings: dict[tuple[int, int], int] = {}
    starts: dict[tuple[int, int], int] = {}
    ends: dict[int, int] = {}
    goes_on = 0
    for i, (_, b1, b2, last, d1, d2, _) in enumerate(rows):
        bit = 1 << i
        starts[b1, b2] = starts.get((b1, b2), 0) | bit
        for turn in zip(d1, d2, strict=True):
            postings[turn] = postings.get(turn, 0) | bit
        if last:
            ends[len(d1)] = ends.get(len(d1), 0) | bit
        else:
            goes_on |= bit

    nodes: list[list] = []

    def visit(step: int, name: tuple[int, int], members: int, above: int | None) -> int | None:
        """Note the node of a path; that of an earlier stretch is noted there."""
        if step == 0 and seg:
            return None
        first = rows[(members & -members).bit_length() - 1]
        ended, names = members & ends.get(step, 0), []
        while ended:
            low = ended & -ended
            names.append(str(rows[low.bit_length() - 1][0]))
            ended ^= low
        n, chars = members.bit_count(), first[6][step - 1] if step else 0
        nodes.append(
            [
                *name,
                above,
                seg * span + step,
                first[0],
                n,
                chars,
                0,
                0,
                (n - 1) * chars,
                bool(members & goes_on),
                ",".join(names) or None,
                step,
            ]
        )
        return len(nodes) - 1

    for start, members in starts.items():
        stack = [(0, start, members, visit(0, start, members, None), start)]
        while stack:
            step, name, members, at, _ = stack.pop()
            left = members & ~ends.get(step, 0)
            while left:
                row = rows[(left & -left).bit_length() - 1]
                if step >= len(row[4]):  # goes on in the next stretch
                    left &= left - 1
                    continue
                d1, d2 = row[4][step], row[5][step]
                child = left & postings[d1, d2]
                left ^= child
                inner = (name[0] ^ d1, name[1] ^ d2)
                here = visit(step + 1, inner, child, at)
                if at is None:
                    nodes[here].append(name)
                stack.append((step + 1, inner, child, here, name))

    out: list[list] = []
    for node in reversed(nodes):  # children come after their parents
        above = None if node[2] is None else nodes[node[2]]
        node[8] = node[8] or 1
        if above is not None:
            above[7] += 1
            above[8] += node[8]
            above[9] += node[9]
    for node in nodes:
        k1, k2, above, depth, conv, n, chars, kids, leaves, saved, unfinished, ids = node[:12]
        if above is not None:
            parent, up = tuple(nodes[above][:2]), nodes[above][4]
        elif len(node) > 13:  # the node before is of an earlier stretch
            parent, up = node[13], None
        else:
            parent, up = (None, None), None
        out.append([k1, k2, *parent, depth, conv, up, n, chars, kids, leaves, saved, unfinished, ids])
    return out


def found_nodes(
    parts: DataFrame, span: int = SPAN, shard: int = SHARD, turns: int = SHARD_TURNS
) -> DataFrame:
    """Nodes of all shards. Ranges of ids come sorted, and a task cuts its range into shards as it
    reads, so it holds one shard at a time."""
    names = list(_NODE)

    def frame(rows: list[tuple], seg: int) -> pd.DataFrame:
        # Typed one by one: whole numbers beside a null would come as doubles.
        kinds = {"bigint": "Int64", "boolean": "bool", "string": "object"}
        columns = zip(*shard_nodes(rows, seg, span), strict=True)
        return pd.DataFrame(
            {c: pd.array(v, dtype=kinds[_NODE[c]]) for c, v in zip(names, columns, strict=True)}
        )

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seg = [], 0, 0
        for batch in batches:
            for s, conv, b1, b2, last, d1, d2, chars in batch.itertuples(index=False):
                if held and (s != seg or len(held) >= shard or size >= turns):
                    yield frame(held, seg)
                    held, size = [], 0
                seg = int(s)
                held.append((int(conv), int(b1), int(b2), bool(last), d1.tolist(), d2.tolist(), chars.tolist()))
                size += len(d1)
        if held:
            yield frame(held, seg)

    n = partitions(parts.sparkSession)
    return land(
        parts.select("_seg", "_conv", "_b1", "_b2", "_ends", "_d1", "_d2", "_chars")
        .repartitionByRange(n, "_seg", "_conv")
        .sortWithinPartitions("_seg", "_conv")
        .mapInPandas(walked, ", ".join(f"{c} {k}" for c, k in _NODE.items())),
        "shard-nodes",
    )


def end_digests(nodes: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and the SHA-256 of a node's end list. The shards' lists come sorted by
    their first ids and go through the digest one after the other; no list is held."""

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, digest = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in batch.itertuples(index=False):
                if name == (k1, k2):
                    digest.update(b"," + ids.encode())
                    continue
                if name is not None:
                    out.append((*name, digest.hexdigest()))
                name, digest = (k1, k2), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["k1", "k2", "sha"])
        if name is not None:
            yield pd.DataFrame([(*name, digest.hexdigest())], columns=["k1", "k2", "sha"])

    first = F.substring_index("ends", ",", 1).cast("bigint")
    return (
        nodes.where(F.col("ends").isNotNull())
        .select("k1", "k2", "ends", first.alias("_first"))
        .repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "_first")
        .select("k1", "k2", "ends")
        .mapInPandas(digested, "k1 bigint, k2 bigint, sha string")
    )


def subtree_sums(tree: DataFrame) -> DataFrame:
    """``k1``, ``k2`` with ``leaves`` and ``saved`` summed over the subtree; ``tree`` has them
    per node, with the parent's name in ``p1`` and ``p2`` (null for the root)."""
    state = land(
        tree.select("k1", "k2", F.col("p1").alias("a1"), F.col("p2").alias("a2"), "leaves", "saved").withColumn(
            "_run", F.spark_partition_id()
        ),
        "subtrees",
    )
    while True:
        below = state.where(F.col("a1").isNotNull())
        if below.isEmpty():
            return state.select("k1", "k2", "leaves", "saved")
        handed = below.groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
        )
        jumps = state.where(F.col("a1").isNotNull()).select(
            F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("_a1"), F.col("a2").alias("_a2")
        )
        further = lookup(below.select("k1", "k2", "a1", "a2", "_run"), jumps, ["a1", "a2"]).select(
            "k1", "k2", F.col("_a1").alias("a1"), F.col("_a2").alias("a2")
        )
        state = land(
            state.drop("a1", "a2", "_run")
            .join(handed, ["k1", "k2"], "left")
            .join(further, ["k1", "k2"], "left")
            .select(
                "k1",
                "k2",
                "a1",
                "a2",
                *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")],
                F.spark_partition_id().alias("_run"),
            ),
            "subtrees",
        )


def prefix_trie(
    conversations: DataFrame, span: int = SPAN, shard: int = SHARD, turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns go by ``turn`` (null first), those of one number by a digest of role and text; a
    repeated row is a turn of its own. Null roles and texts are empty. ``conv_id % 100`` has
    the sign of the id, so the family of -105 is that of -100. Rows with a null conv_id belong
    to no conversation and are left out. An empty table has no conversation and gives an
    empty result, without a root. Other columns are not looked at.
    """
    nodes = found_nodes(stretches(rebuilt(conversations), span), span, shard, turns)
    same = ("p1", "p2", "depth", "chars", "kids", "leaves", "saved", "unfinished", "up")
    merged = land(
        nodes.groupBy("k1", "k2")
        .agg(
            F.min("conv").alias("conv"),
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("_parts"),
            *[F.max(c).alias(c) for c in same],
        )
        .withColumns(
            {
                "top": (F.col("_parts") > 1) | F.col("unfinished"),
                "_run": F.spark_partition_id(),
            }
        )
        .drop("_parts", "unfinished"),
        "nodes",
    )
    top = merged.where("top")
    parents = top.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("_up")
    )
    below = merged.where(F.col("p1").isNotNull()).select("p1", "p2", "_run").distinct().join(
        parents, ["p1", "p2"]
    )
    linked = land(merged.join(below, ["p1", "p2", "_run"], "left"), "linked-nodes")
    done = lambda c: F.coalesce(F.sum(F.when(~F.col("top"), F.col(c))), F.lit(0))
    kids = (
        linked.where(F.col("_up").isNotNull())
        .groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("_kids"), done("leaves").alias("_leaves"), done("saved").alias("_saved"))
    )
    tree = land(
        top.select("k1", "k2", "p1", "p2", "n", "chars")
        .join(kids, ["k1", "k2"], "left")
        .select(
            "k1",
            "k2",
            "p1",
            "p2",
            F.coalesce("_kids", F.lit(0)).alias("_kids"),
            F.coalesce("_leaves", F.lit(1)).alias("leaves"),
            ((F.col("n") - 1) * F.col("chars") + F.coalesce("_saved", F.lit(0))).alias("saved"),
        ),
        "tree-top",
    )
    sums = subtree_sums(tree).select(
        "k1", "k2", F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved")
    )
    totals = tree.select("k1", "k2", "_kids").join(sums, ["k1", "k2"])
    return (
        linked.join(totals, ["k1", "k2"], "left")
        .join(end_digests(nodes), ["k1", "k2"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.coalesce("_up", "up").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.coalesce("_kids", "kids").alias("n_children"),
            F.coalesce("_leaves", "leaves").alias("n_leaves"),
            F.coalesce("_saved", "saved").alias("saved_tokens"),
            F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


ORACLE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations
    WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(list_reduce(
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda crc, byte: list_reduce(
                   [0, 0, 0, 0, 0, 0, 0, 0],
                   lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END,
                   xor(crc, byte)),
               4294967295), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
),
lent AS (
    SELECT c.conv_id, t.pos, t.role, t.words
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
),
sizes AS (SELECT conv_id, count(*) AS k FROM lent GROUP BY conv_id),
whole AS (
    SELECT * FROM lent
    UNION ALL
    SELECT t.conv_id, coalesce(s.k, 0) + t.pos - c.h, t.role, t.words
    FROM turns t JOIN convs c USING (conv_id) LEFT JOIN sizes s USING (conv_id)
    WHERE t.pos > c.h
),
paths AS (
    SELECT conv_id, pos AS depth, length(words) AS chars,
           sha256(string_agg(length(role) || ':' || length(words) || ':' || role || words, ';')
               OVER (PARTITION BY conv_id ORDER BY pos)) AS node
    FROM whole
    UNION ALL
    SELECT conv_id, 0, 0, 'root' FROM convs
),
nodes AS (
    SELECT node, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n
    FROM paths GROUP BY node, depth
),
edges AS (
    SELECT DISTINCT c.node, p.node AS parent
    FROM paths c JOIN paths p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1
),
kids AS (SELECT parent, count(*) AS n FROM edges GROUP BY parent),
above AS (
    SELECT DISTINCT c.node, a.node AS ancestor
    FROM paths c JOIN paths a ON a.conv_id = c.conv_id AND a.depth <= c.depth
),
sums AS (
    SELECT a.ancestor, count(*) FILTER (k.n IS NULL) AS leaves, sum((n.n - 1) * n.chars) AS saved
    FROM above a JOIN nodes n ON n.node = a.node LEFT JOIN kids k ON k.parent = a.node
    GROUP BY a.ancestor
),
last AS (
    SELECT conv_id, max(depth) AS depth, arg_max(node, depth) AS node FROM paths GROUP BY conv_id
),
ended AS (
    SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
    FROM last GROUP BY node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN edges USING (node)
LEFT JOIN nodes p ON p.node = edges.parent
LEFT JOIN kids k ON k.parent = n.node
JOIN sums s ON s.ancestor = n.node
LEFT JOIN ended e ON e.node = n.node
"""
