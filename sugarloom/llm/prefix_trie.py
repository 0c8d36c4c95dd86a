"""The prefix trie of conversations, its subtree totals by parallel tree contraction.

Turns are numbered, and prefixes told apart, by prefix sums over bounded blocks, so that a conversation of any length is
spread over tasks. The nodes' totals come from contraction: each round rakes all leaves into their parents and splices
unary nodes that no neighbour precedes out of their chains, one join round for both; then the rounds are gone through
backwards, and each spliced node gets its total from the child that it had.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sugarloom.llm.common import drop_stage, staged, table

#: Turns of one block of a conversation, and bytes of one piece of a list of ids.
BLOCK, CHUNK = 4096, 1 << 20
#: Heads of at most HEADS - 1 turns come from the conversation at the start of each SPAN of ids.
HEADS, SPAN = 6, 100


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, role, text) to turns(conv_id, start, m, a, b, chars), m equal turns from place start on, and
    sizes(conv_id, n). Equal rows are counted first; a sorted range of turns is numbered in its task, ranges by sums."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(role, 1, 64).alias("tie1"), F.substring(text, 1, 64).alias("tie2"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.char_length(text).cast("long").alias("chars"),
    )
    keys = ["conv_id", "turn", "tie1", "tie2", "a", "b", "chars"]
    order = [F.col("turn").asc_nulls_first(), "tie1", "tie2", "a", "b"]
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.groupBy(*keys).agg(F.count("*").alias("m")).repartitionByRange(tasks, "conv_id", *order).withColumn("part", F.spark_partition_id())
    ranges = staged(ranges, "turns")
    inside = W.partitionBy("part", "conv_id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sums = ranges.groupBy("part", "conv_id").agg(F.sum("m").alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("part", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    start = F.col("offset") + F.coalesce(F.sum("m").over(inside), F.lit(0))
    turns = ranges.join(offsets, ["part", "conv_id"]).select("conv_id", start.alias("start"), "m", "a", "b", "chars")
    out = staged(turns, "numbered")
    sizes = staged(sums.groupBy("conv_id").agg(F.sum("n").alias("n")), "sizes")
    drop_stage(ranges)
    return out, sizes


def _single(turns: DataFrame) -> DataFrame:
    """A row a turn: copies of a turn are set out block by block."""
    blocks = turns.withColumn("block", F.explode(F.expr(f"sequence(0L, (m - 1) div {BLOCK})")))
    place = F.explode(F.expr(f"sequence(start + block * {BLOCK}, start + least(m, (block + 1) * {BLOCK}) - 1)"))
    return blocks.select("conv_id", place.alias("pos"), "a", "b", "chars")


def rebuilt(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns and sizes of numbered() to the rebuilt turns (conv_id, pos, a, b, chars) and sizes (conv_id, n).

    Conversation c has the first h turns of conversation c - c % SPAN, as far as there are any, then its own turns after
    its first h; h is crc32 of c's digits modulo HEADS.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    plan = sizes.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % SPAN).alias("base"))
    bases = sizes.where(F.col("conv_id") % SPAN == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    plan = staged(plan.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0)))), "plan")
    heads = _single(turns.where((F.col("conv_id") % SPAN == 0) & (F.col("start") < HEADS)).withColumn("m", F.least("m", F.lit(HEADS) - F.col("start"))))
    heads = heads.withColumnRenamed("conv_id", "base").join(plan.select("conv_id", "base", "k"), "base").where("pos < k")
    # a row of the plan for each block of its turns, so that a long conversation is many keys
    blocks = plan.select("conv_id", "h", "k", F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK})")).alias("block"))
    own = _single(turns).where(F.col("pos") >= h).withColumn("block", F.expr(f"pos div {BLOCK}")).join(blocks.drop("h"), ["conv_id", "block"])
    own = own.select("conv_id", (F.col("pos") - h + F.col("k")).alias("pos"), "a", "b", "chars")
    size = plan.select("conv_id", (F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n"))
    return own.unionByName(heads.select("conv_id", "pos", "a", "b", "chars")), size


def prefixes(turns: DataFrame) -> DataFrame:
    """Rebuilt turns to (conv_id, depth, p1, p2, q1, q2, chars): p stands for the turns up to this one, q for those before.

    A prefix is the exclusive or of a hash of each turn and its place, twice 64 bits: different prefixes of n agree with
    odds of about n * n / 2**129.
    """
    terms = turns.select("conv_id", "pos", "chars", F.expr(f"pos div {BLOCK}").alias("block"), F.xxhash64(F.lit(3), "a", "b", "pos").alias("x1"), F.xxhash64(F.lit(4), "b", "a", "pos").alias("x2"))
    terms = staged(terms, "terms")
    sums = terms.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", *(F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(s) for s in ("s1", "s2")))
    inside = W.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = terms.select("*", F.bit_xor("x1").over(inside).alias("r1"), F.bit_xor("x2").over(inside).alias("r2")).join(sums, ["conv_id", "block"])
    p1, p2 = F.col("s1").bitwiseXOR(F.col("r1")), F.col("s2").bitwiseXOR(F.col("r2"))
    out = staged(runs.select("conv_id", (F.col("pos") + 1).alias("depth"), p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("x1")).alias("q1"), p2.bitwiseXOR(F.col("x2")).alias("q2"), "chars"), "prefixes")
    drop_stage(terms)
    return out


def joined_digests(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, value) to (key, sha256): the digest of each key's values in ascending order, comma-joined.

    Values are sorted in ranges over all tasks and joined to pieces of about CHUNK bytes there; a key's digest then runs
    over its pieces in order, one in memory at a time, as a digest is a chain.
    """
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in key)

    def pieces(batches):
        at, begin, parts, size = None, None, [], 0
        for batch in batches:
            *keys, values = (batch.column(i).to_pylist() for i in range(len(key) + 1))
            out = []
            for k, v in zip(zip(*keys, strict=True), values, strict=True):
                if k != at or size >= CHUNK:
                    if parts:
                        out.append((*at, begin, ",".join(parts)))
                    at, begin, parts, size = k, v, [], 0
                parts.append(str(v))
                size += len(parts[-1]) + 1
            if out:
                yield _batch(out, [*key, "begin", "piece"])
        if parts:
            yield _batch([(*at, begin, ",".join(parts))], [*key, "begin", "piece"])

    def chains(batches):
        at, sha = None, None
        for batch in batches:
            *keys, _, texts = (batch.column(i).to_pylist() for i in range(len(key) + 2))
            out = []
            for k, piece in zip(zip(*keys, strict=True), texts, strict=True):
                if k != at:
                    if sha:
                        out.append((*at, sha.hexdigest()))
                    at, sha = k, hashlib.sha256()
                    sha.update(piece.encode())
                else:
                    sha.update(f",{piece}".encode())
            if out:
                yield _batch(out, [*key, "sha256"])
        if sha:
            yield _batch([(*at, sha.hexdigest())], [*key, "sha256"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select(*key, value).repartitionByRange(tasks, *key, value).sortWithinPartitions(*key, value)
    joined = ranged.mapInArrow(pieces, f"{kinds}, begin long, piece string")
    return joined.repartition(*key).sortWithinPartitions(*key, "begin").mapInArrow(chains, f"{kinds}, sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)


# -- contraction ----------------------------------------------------------------------------------


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """tree(node, up, depth, *values), up null at roots, to (node, *values): each value summed over the node's subtree.

    node may be of any orderable type; depth is 0 at roots and only orders the splicing. A round takes all leaves, and of
    every chain of unary nodes those that come before both neighbours: first odd depths, then odd multiples of two, and
    so on, ties by hash. So a chain shrinks by half a round and rounds grow with the logarithm of the nodes, whatever the
    tree's depth. Messages to a node are summed where they arise, so a parent of many children is no hot key.
    """
    sums = lambda cols: [F.sum(c).alias(c) for c in cols]
    rank = F.struct(F.expr("bit_count((depth & -depth) - 1)").alias("tz"), F.xxhash64("node").alias("h"), F.col("node").alias("node"))
    state = staged(tree.select("node", "up", rank.alias("rank"), *values, F.lit("live").alias("status"), F.lit(None).cast(tree.schema["node"].dataType).alias("only")), "tree")
    rounds: list[DataFrame] = []
    while True:
        rounds.append(state)
        alive = state.where("status = 'live'").drop("status", "only")
        if len(rounds) > 1:
            # nodes spliced in the last round: their child's parent is theirs, and their sums go to it
            gone = state.where("status = 'spliced'")
            nothing = [F.lit(0).cast("long").alias(v) for v in values]
            told = gone.select(F.explode(F.array(
                F.struct(F.col("only").alias("to"), F.col("up").alias("new"), *nothing),
                F.struct(F.col("up").alias("to"), F.lit(None).cast(tree.schema["node"].dataType).alias("new"), *(F.col(v).cast("long").alias(v) for v in values)),
            )).alias("m")).select("m.*").groupBy("to").agg(F.max("new").alias("new"), *(F.sum(v).alias(f"add_{v}") for v in values))
            alive = alive.join(told, F.col("node") == F.col("to"), "left").select("node", F.coalesce("new", "up").alias("up"), "rank", *((F.col(v) + F.coalesce(f"add_{v}", F.lit(0))).alias(v) for v in values))
        children = alive.where("up IS NOT NULL").groupBy(F.col("up").alias("of")).agg(F.count("*").alias("n"), F.min("node").alias("only"))
        now = alive.join(children, F.col("node") == F.col("of"), "left").drop("of")
        leaf, unary = F.col("n").isNull() & F.col("up").isNotNull(), (F.col("n") == 1) & F.col("up").isNotNull()
        null_rank = F.lit(None).cast(state.schema["rank"].dataType)
        said = lambda to, over, under, leafy: F.struct(to.alias("to"), over.alias("over"), under.alias("under"), F.lit(leafy).alias("leafy"), *(F.when(F.lit(leafy), F.col(v)).otherwise(0).cast("long").alias(v) for v in values))
        messages = (
            now.select(F.explode(F.when(leaf, F.array(said(F.col("up"), null_rank, null_rank, True)))
            .when(unary, F.array(said(F.col("only"), F.col("rank"), null_rank, False), said(F.col("up"), null_rank, F.col("rank"), False)))).alias("m"))
            .select("m.*").groupBy("to").agg(F.min("over").alias("over"), F.min("under").alias("under"), F.max("leafy").alias("leafy"), *(F.sum(v).alias(f"add_{v}") for v in values))
        )
        first = lambda side: F.col(side).isNull() | (F.col("rank") < F.col(side))
        status = F.when(leaf, "raked").when(unary & ~F.coalesce("leafy", F.lit(False)) & first("over") & first("under"), "spliced").otherwise("live")
        state = staged(
            now.join(messages, F.col("node") == F.col("to"), "left").select("node", "up", "rank", *((F.col(v) + F.coalesce(f"add_{v}", F.lit(0))).alias(v) for v in values), status.alias("status"), "only"), "tree"
        )
        if not state.where("status <> 'live'").limit(1).count():
            break
    # what is left are roots; then backwards: raked nodes are whole, spliced ones lack their child's total
    done = [state.select("node", *values)]
    for old in reversed(rounds):
        whole = old.where("status = 'raked'").select("node", *values)
        total = reduce(DataFrame.union, done)
        lack = old.where("status = 'spliced'").select("node", "only", *values)
        below = total.select(F.col("node").alias("of"), *(F.col(v).alias(f"add_{v}") for v in values))
        again = lack.join(below, F.col("only") == F.col("of")).select("node", *((F.col(v) + F.col(f"add_{v}")).alias(v) for v in values))
        done.append(staged(whole.union(again), "totals"))
    out = staged(reduce(DataFrame.union, done), "totals")
    for x in (*rounds, state, *done):
        drop_stage(x)
    return out


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, ...) to a row a node of the trie of rebuilt conversations (see rebuilt()).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Null roles and texts are empty; turns go null first, equal ones by role, by the text's first 64 code points and by
    hash; repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left out. A
    conversation that ends up without turns is a member of the root. No conversations give no rows, not even a root.
    conv_id must be an integer. Other columns are not read.
    """
    turns, sizes = numbered(conversations)
    rebuilt_turns, length = rebuilt(turns, sizes)
    seqs = prefixes(rebuilt_turns)
    key = ["depth", "p1", "p2"]
    everyone = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = everyone.select(F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("p1", "p2", "q1", "q2")), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = seqs.groupBy(*key).agg(F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"))
    nodes = staged(nodes.unionByName(root), "nodes")
    # the parents of nodes: a node with many children is split by Spark's skew join, all its rows being on one side
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    placed = staged(nodes.join(parents, ["depth", "q1", "q2"], "left"), "placed")
    node = F.struct(F.col("conv_id").alias("conv_id"), F.col("depth").alias("depth"))
    up = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    children = placed.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    placed = placed.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    ends = seqs.join(length.withColumnRenamed("n", "depth"), ["conv_id", "depth"]).select(*key, "conv_id").union(length.where("n = 0").select(*(F.lit(0).cast("long") for _ in key), "conv_id"))
    placed = staged(placed.join(joined_digests(ends, key, "conv_id"), key, "left"), "placed")
    weights = placed.select(node.alias("node"), up.alias("up"), "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = subtree_sums(weights, ["n_leaves", "saved_tokens"]).select("node.conv_id", "node.depth", "n_leaves", "saved_tokens")
    empty = hashlib.sha256(b"").hexdigest()
    for x in (turns, sizes, seqs, nodes):
        drop_stage(x)
    return placed.join(totals, ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.lit(empty)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (  -- crc32 bit by bit: each byte comes with the first of its eight steps
  SELECT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS steps
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT conv_id, xor(4294967295, list_reduce(steps, lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), 4294967295::BIGINT)) % 6 AS h FROM bits),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
plan AS MATERIALIZED (
  SELECT s.conv_id, h, s.conv_id - s.conv_id % 100 AS base, least(h, coalesce(b.n, 0)) AS k, least(h, coalesce(b.n, 0)) + greatest(0, s.n - h) AS n
  FROM sizes s JOIN heads USING (conv_id) LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % 100),
rebuilt AS MATERIALIZED (
  SELECT p.conv_id, pos, role, text FROM plan p JOIN turns t ON t.conv_id = base AND pos < h
  UNION ALL SELECT p.conv_id, pos - h + k, role, text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND pos >= h),
seqs AS MATERIALIZED (
  SELECT conv_id, pos + 1 AS depth, length(text) AS chars, list([role, text]) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, [] FROM plan),
nodes AS MATERIALIZED (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
  FROM seqs JOIN plan USING (conv_id) GROUP BY depth, path),
places AS MATERIALIZED (SELECT s.conv_id, s.depth, n.conv_id AS node FROM seqs s JOIN nodes n ON s.depth = n.depth AND s.path = n.path),
tree AS MATERIALIZED (
  SELECT n.conv_id, n.depth, n.n_convs, n.chars, n.ends_sha256, p.node AS parent_conv_id
  FROM nodes n LEFT JOIN places p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM tree WHERE depth > 0 GROUP BY ALL),
counted AS MATERIALIZED (SELECT t.*, coalesce(c.n, 0) AS n_children FROM tree t LEFT JOIN children c ON c.conv_id = t.conv_id AND c.depth = t.depth),
totals AS (
  SELECT p.node AS conv_id, p.depth, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM counted c JOIN places p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM counted JOIN totals USING (conv_id, depth)
"""
