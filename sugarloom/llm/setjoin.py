"""Exact set-similarity linking with a prefix tree, and the distributed plan around it.

Sets are stored in one global order, rare members first, in a path-compressed trie. A probe walks the
trie once for all sets of a block: sets that begin alike share the overlap counted so far, and a subtree
is left as soon as the lengths that remain below it can't reach the wanted overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import drop_stage, staged

_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

#: Sets of one block, and members of all its sets: what one trie and one task's memory hold.
BLOCK, BLOCK_MEMBERS = 384, 1 << 20


class Linked:
    """Union-find over the places of a block."""

    def __init__(self, n: int):
        self.up, self.parts = list(range(n)), n

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[j] = i
        self.parts -= 1
        return True


class SetTrie:
    """A path-compressed trie of ascending integer arrays, its nodes in depth-first order.

    Of each node: the members on its edge, the depth at its end, the first node after its subtree, the
    smallest and largest set below it, and the sets that end there.
    """

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.edge: list[np.ndarray] = []
        self.depth: list[int] = []
        self.after: list[int] = []
        self.least: list[int] = []
        self.most: list[int] = []
        self.ends: list[list[int]] = []
        shared = [0]
        for a, b in zip(order, order[1:], strict=False):
            x, y = sets[a], sets[b]
            n = min(len(x), len(y))
            apart = np.flatnonzero(x[:n] != y[:n])
            shared.append(int(apart[0]) if len(apart) else n)
        self._grow(sets, order, shared, 0, len(order), 0)

    def _grow(self, sets, order, shared, lo, hi, depth) -> None:
        stack = [(lo, hi, depth, -1)]
        while stack:
            lo, hi, depth, node = stack.pop()
            if node >= 0:  # the subtree that began at node is whole
                self.after[node] = len(self.edge)
                continue
            first = sets[order[lo]]
            deep = min([len(first), *shared[lo + 1 : hi]]) if hi - lo > 1 else len(first)
            at = len(self.edge)
            sizes = [len(sets[order[k]]) for k in range(lo, hi)]
            self.edge.append(first[depth:deep])
            self.depth.append(deep)
            self.after.append(0)
            self.least.append(min(sizes))
            self.most.append(max(sizes))
            ends, k = [], lo
            while k < hi and len(sets[order[k]]) == deep:
                ends.append(order[k])
                k += 1
            self.ends.append(ends)
            stack.append((lo, hi, depth, at))
            children = []
            while k < hi:
                begin = k
                k += 1
                while k < hi and shared[k] > deep:
                    k += 1
                children.append((begin, k, deep, -1))
            stack += reversed(children)

    def probe(self, probe: np.ndarray, marked: np.ndarray, num: int, den: int) -> Iterator[int]:
        """Places of the sets whose overlap with probe gives num/den Jaccard or more; marked: probe as flags."""
        n, at, end = len(probe), 0, len(self.edge)
        overlaps = [0]  # of the path to the node, by its nesting
        closes = [end]
        need = lambda m: -(-num * (n + m) // (num + den))
        while at < end:
            while closes[-1] <= at and len(closes) > 1:
                closes.pop()
                overlaps.pop()
            low, high = self.least[at], self.most[at]
            if den * high < num * n or den * n < num * low:
                at = self.after[at]
                continue
            edge = self.edge[at]
            overlap = overlaps[-1] + (int(np.count_nonzero(marked[edge])) if len(edge) else 0)
            # what can still come: members below, and members of the probe after the edge's last
            left = n - int(np.searchsorted(probe, edge[-1], "right")) if len(edge) else n
            deep = self.depth[at]
            reach = min(high, den * n // num)
            if overlap + reach - deep < need(reach) or overlap + left < need(max(low, -(-num * n // den))):
                at = self.after[at]
                continue
            for place in self.ends[at]:
                m = deep
                if den * overlap >= num * (n + m - overlap):
                    yield place
            overlaps.append(overlap)
            closes.append(self.after[at])
            at += 1


def links_within(sets: list[np.ndarray], num: int, den: int, split: int | None = None) -> list[tuple[int, int]]:
    """Links that connect the places of `sets` as all links of num/den Jaccard or more would.

    Sets are arrays in global order. A probe stops once the block is one part. With `split`, only pairs
    across that place are looked at.
    """
    if len(sets) < 2:
        return []
    every, flat = np.unique(np.concatenate(sets), return_inverse=True)
    local, at = [], 0
    for s in sets:
        local.append(np.sort(flat[at : at + len(s)]).astype(np.uint32))
        at += len(s)
    linked, out, marked = Linked(len(sets)), [], np.zeros(len(every), bool)
    if split is None:
        trie, probes, base = SetTrie(local), range(len(local)), 0
    else:
        trie, probes, base = SetTrie(local[split:]), range(split), split
    for i in probes:
        if linked.parts == 1:
            break
        marked[local[i]] = True
        for j in trie.probe(local[i], marked, num, den):
            if linked.join(i, base + j):
                out.append((i, base + j))
        marked[local[i]] = False
    return out


def pack(keys: np.ndarray) -> bytes:
    """The upper 48 bits of ascending sort keys, byte planes apart and compressed.

    Of n members two share those bits, and so count as one, with a chance of n * n / 2**43.
    """
    planes = (keys >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return _PACKER.compress(np.ascontiguousarray(planes.T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNPACKER.decompress(raw), np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return out.reshape(-1).view("<u8")


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal keys in sorted batches, as lists of (side, member, set)."""
    held, now = [], None
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in (*keys, "side", "member", "members")]
        for row in zip(*cols, strict=True):
            key = row[: len(keys)]
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(row[len(keys) :])
    if held:
        yield now, held


def _link_blocks(rows: DataFrame, keys: list[str], num: int, den: int, across: bool) -> DataFrame:
    """rows(*keys, side, member, members): the links (a, b) of each block; side 0 is held against side 1 if across.

    Blocks of several parts also give rows (head, rest): members that their block doesn't connect to the head.
    """

    def run(batches):
        for key, block in _blocks(batches, keys):
            seen, ids, sets, split = set(), [], [], 0
            for side, member, raw in sorted(block, key=lambda x: (x[0], x[1])):
                if (side, member) in seen:
                    continue
                seen.add((side, member))
                split += side == 0
                ids.append(member)
                sets.append(unpack(raw))
            found = links_within(sets, num, den, split if across else None)
            links = [(ids[i], ids[j], None, None) for i, j in found if ids[i] != ids[j]]
            if not across and key[2] > 1:
                linked = Linked(len(ids))
                for i, j in found:
                    linked.join(i, j)
                main = linked.find(ids.index(key[0])) if key[0] in ids else None
                links += [(None, None, key[0], m) for i, m in enumerate(ids) if linked.find(i) != main]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["a", "b", "head", "rest"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "side", "member", "members").mapInArrow(run, "a long, b long, head long, rest long")


def prefix_length(n: int, num: int, den: int, more: int = 0) -> int:
    """How many of a set's first members are looked at: two sets of num/den Jaccard or more share one of n - ceil(n *
    num / den) + 1, and l of them if l - 1 more are looked at. l is `more` hundredths of n."""
    return min(n, n - -(-num * n // den) + max(1, more * n // 100))


def shared_at_least(n: Column, num: int, den: int, more: int) -> Column:
    """Tokens that a set of n shares within both prefixes with any set it is alike to, the smallest of which has num/den
    of n members."""
    return F.greatest(F.lit(1), F.floor(F.ceil(n * num / den) * more / 100))


def heads_of(entries: DataFrame, num: int, den: int, more: int = 0) -> DataFrame:
    """entries(token, n, cls) to distinct (head, member, n): groups that hold every pair of classes that can be num/den
    alike; a head is a member of its own group unless it can be alike to none.

    The classes of a token are taken by size. Where the next is larger than den/num times the last, no
    pair across that gap can be alike, so a new group begins; its first class is its head. A class that
    shares fewer tokens with others than `shared_at_least` is alike to none and falls out, and so do groups
    of one. Only a token's current group is remembered, whatever the token's number of rows. A row is made for
    each token that a head and a member share, in whatever task; Spark counts them by pair.
    """

    def run(batches):
        last: tuple | None = None  # token, size, head, the head's size, class, whether the head has company
        for batch in batches:
            token, n, cls = (batch.column(x).to_numpy() for x in ("token", "n", "cls"))
            if not len(token):
                continue
            # copies of a class in other tasks are one row
            new = np.append(True, (token[1:] != token[:-1]) | (num * n[1:] > den * n[:-1]))
            twice = np.append(False, (token[1:] == token[:-1]) & (cls[1:] == cls[:-1]))
            if last is not None and token[0] == last[0]:
                new[0] = num * n[0] > den * last[1]
                twice[0] = cls[0] == last[4]
            starts = np.flatnonzero(new)
            at = np.cumsum(new) - 1
            heads = cls[starts[np.maximum(at, 0)]] if len(starts) else np.full(len(cls), last[2])
            sizes = n[starts[np.maximum(at, 0)]] if len(starts) else np.full(len(cls), last[3])
            if at[0] < 0:
                heads[at < 0], sizes[at < 0] = last[2], last[3]
            follow = ~new & ~twice & (heads != cls)
            # the head's own token counts once for each group that has a second class
            run_id = at[follow]
            first = np.append(True, run_id[1:] != run_id[:-1]) if len(run_id) else np.empty(0, bool)
            own = np.flatnonzero(follow)[first]
            if len(own) and at[own[0]] < 0 and last is not None and last[5]:
                own = own[1:]  # it was counted in the batch before
            rows = [np.concatenate(x) for x in ((heads[follow], heads[own]), (cls[follow], heads[own]), (n[follow], sizes[own]))]
            open_ = bool(follow[at == at[-1]].any()) or (at[-1] < 0 and last is not None and last[5])
            last = (int(token[-1]), int(n[-1]), int(heads[-1]), int(sizes[-1]), int(cls[-1]), open_)
            if len(rows[0]):
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32())], names=["head", "member", "n"])

    ordered = entries.select("token", "n", "cls").repartition("token").sortWithinPartitions("token", "n", "cls")
    found = staged(ordered.mapInArrow(run, "head long, member long, n int").groupBy("head", "member", "n").agg(F.count("*").alias("tokens")), "groups")
    able = found.groupBy("member", "n").agg(F.sum("tokens").alias("tokens")).where(F.col("tokens") >= shared_at_least(F.col("n"), num, den, more)).select("member")
    kept = found.join(able, "member", "left_semi").select("head", "member", "n")
    several = kept.groupBy("head").agg(F.count("*").alias("k")).where("k > 1").select("head")
    out = staged(kept.join(several, "head", "left_semi"), "groups")
    drop_stage(found)
    return out


def group_links(groups: DataFrame, sets: DataFrame, num: int = 75, den: int = 100, block: int = BLOCK, label: str = "links") -> DataFrame:
    """groups(head, member, n), sets(member, members as packed sort keys; repeated rows do no harm) to links (a, b).

    Two members of one group that are num/den Jaccard or more alike are connected by the links given, if
    not always directly. A head is in its group too if it has a set.

    n is the member's size. A group of up to `block` members and BLOCK_MEMBERS in all is one block. A
    larger one is dealt over blocks by hash, each with the head, so no task gets more; what its blocks
    connect to the head is one component. Only members that they don't (the rest) can miss links across
    blocks, and they are held, block by block, against all of their group.
    """
    groups = groups.select("head", "member", "n").where("head <> member").distinct()
    sizes = groups.groupBy("head").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / BLOCK_MEMBERS)).cast("int").alias("parts"))
    dealt = groups.join(sizes, "head")
    dealt = dealt.withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("member"), F.col("parts"))).otherwise(0).cast("int"))
    heads = sizes.select("head", F.col("head").alias("member"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts")
    keys = ["head", "part", "parts"]
    rows = dealt.select(*keys, "member").union(heads.select(*keys, "member")).join(sets, "member").withColumn("side", F.lit(0))
    first = staged(_link_blocks(rows, keys, num, den, False), label)
    links = first.where("a is not null").select("a", "b")
    if not first.where("rest is not null").limit(1).count():
        return links
    large = staged(dealt.where("parts > 1").select("head", "part", "parts", "member", "n"), label)
    rest = large.join(first.where("rest is not null").select("head", F.col("rest").alias("member")), ["head", "member"], "left_semi")
    waiting = rest.groupBy("head").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / BLOCK_MEMBERS)).cast("int").alias("turns"))
    probes = rest.join(waiting, "head").withColumn("turn", F.pmod(F.xxhash64("member", F.lit(1)), F.col("turns")).cast("int"))
    probes = probes.select("head", "turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "member", F.lit(0).alias("side"))
    against = large.join(waiting, "head").select("head", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "part", "member", F.lit(1).alias("side"))
    second = probes.unionByName(against).join(sets, "member")
    return links.union(staged(_link_blocks(second, ["head", "turn", "part"], num, den, True), label).where("a is not null").select("a", "b"))
