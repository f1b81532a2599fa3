"""Exact Jaccard self-join of word n-gram sets, with a prefix tree.

Sets that are equal are one node. For the others, sets of similar size are cut into so many parts (by key) that two
linked sets must agree on a certain number of parts that are not empty in them. Pairs that agree on so many are joined
into blocks. Parts that many sets share are left out of that count, and so many fewer are asked for; only sets with
few other parts are joined to the others of the kind that share such a part. Linked sets always meet in a block. In a
block the n-grams get one order, the ordered sets are stored in a tree of shared prefixes, and each set walks the tree once: it carries the overlap of the prefix, and leaves a branch when the
n-grams that remain on either side cannot reach the threshold. Branches that already belong to the walker's
component are left too, as another link there says nothing new.

A block of more n-grams than fit a task is cut into chunks which all hold the block's leader. What does not get
linked to the leader meets every chunk in a second step, so a hot group of near copies costs time in proportion to
its size, and no link is lost.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.words import blocks, give_back, in_parts, lists, mix, signed, small, spans, unsigned, words_of
from tidelog.session import materialize

# N-grams of one chunk of a block, and set digests that a task remembers.
CHUNK_GRAMS = 600_000
SEEN_SETS = 200_000

# Part keys of one bucket in bytes, buckets of one task, bytes of text for a word, and pairs that are counted at once.
# Spark hands a task's buckets to Python in one Arrow batch, so a task has few of them.
BUCKET_BYTES = 8 << 20
TASK_BUCKETS = 2
WORD_BYTES = 6
PAIRS = 1 << 18

# Rows that a task gives at once.
ROWS = 1 << 15

# Bits of the filter for the documents whose sets are needed.
FILTER_BITS = 1 << 24

# Nodes of a key of which all pairs are counted. A key of more nodes is heavy: it counts for no pair.
LARGE = 24

# Sets of up to so many n-grams are cut into more parts than they have n-grams.
SHORT = 64

# A part's key, the node that has it, and how many keys a linked node shares with that node.
PART = np.dtype([("key", "<u8"), ("node", "<i8"), ("need", "<u2")])

_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def gram_keys(key: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the word n-grams of a block and their bounds by document; a shorter document is one n-gram."""
    count = first[1:] - first[:-1]
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    doc = np.repeat(np.arange(len(count)), made)
    at = first[:-1][doc] + np.arange(bounds[-1]) - bounds[:-1][doc]
    keys = np.zeros(len(at), np.uint64)
    full = count[doc] >= size
    weight = np.cumprod(np.full(size, _A, np.uint64))
    for i in range(size):
        if full.all():
            keys += key[at + i] * weight[i]
        else:
            inside = full | (i < count[doc])
            keys[inside] += key[at[inside] + i] * weight[i]
    keys[~full] += count[doc][~full].astype(np.uint64)
    return mix(keys), bounds


def _bounds(percent: int) -> np.ndarray:
    """First sizes of the size classes: linked sets are in one class or in neighbouring ones."""
    found = [percent // (100 - percent)]
    while found[-1] < 1 << 40:
        found.append(found[-1] * 100 // percent + 1)
    return np.array(found)


class Scheme:
    """How sets are cut whose smaller one of a pair is in this size class.

    Linked sets differ in at most ``most`` n-grams, so of ``parts`` parts at least ``parts - most`` are equal. At most
    ``empty`` of them may be empty in a set that leaves its empty parts out; ``need`` are equal and not left out. Of the
    filled parts of a set that leaves out the others, all but ``most`` are equal in a linked one.
    """

    def __init__(self, number: int, bounds: np.ndarray, percent: int):
        small = int(bounds[number + 1]) - 1
        large = small * 100 // percent
        most = self.most = (small + large) * (100 - percent) // (100 + percent)
        self.empty = 4 + most // 10 + (small if small <= SHORT else 0)
        self.need = min(1 + most // 12, 255)
        self.parts = most + self.empty + self.need


def signatures(grams: np.ndarray, percent: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of a set, from the sum of the n-gram keys in each, and how many of them a linked set shares."""
    own = int(np.searchsorted(bounds, len(grams), "right")) - 1
    found, needs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]
    spread = grams >> np.uint64(32)
    for number in (own, own - 1):
        if number < 0:
            continue
        scheme = Scheme(number, bounds, percent)
        part = ((spread * np.uint64(scheme.parts)) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(scheme.parts, np.uint64)
        np.add.at(total, part, grams)
        filled = np.bincount(part, minlength=scheme.parts) > 0
        name = np.arange(scheme.parts, dtype=np.uint64) * _A + np.full(scheme.parts, number, np.uint64) * _B
        keys, need = mix(mix(total) + name), scheme.need
        if scheme.parts - filled.sum() <= scheme.empty:
            keys, need = keys[filled], min(int(filled.sum()) - scheme.most, 0xFFFF)
        found.append(keys)
        needs.append(np.full(len(keys), need, np.uint16))
    return np.concatenate(found), np.concatenate(needs)


def _sets(texts: pa.Array, size: int):
    for _, _, offsets, raw in blocks(texts):
        words = words_of(offsets, raw)
        keys, bounds = gram_keys(words.key, words.first, size)
        for part in spans(keys, bounds):
            yield np.unique(part)


def _digest(grams: np.ndarray) -> int:
    """Key of a set (order does not matter), as a long."""
    total = np.array([np.add.reduce(grams)], np.uint64) + np.array([len(grams)], np.uint64) * _A
    return int(signed(mix(total))[0])


def _groups(parts: np.ndarray, heavy: np.ndarray):
    """Parts by key and node without repeats, the first place of each key, its nodes, and whether it is heavy."""
    order = np.lexsort((parts["node"], parts["key"]))
    parts, heavy = parts[order], heavy[order]
    new = np.ones(len(parts), bool)
    new[1:] = parts["key"][1:] != parts["key"][:-1]
    begin = np.flatnonzero(new)
    marked = np.logical_or.reduceat(heavy, begin) if len(begin) else heavy
    once = new.copy()
    once[1:] |= parts["node"][1:] != parts["node"][:-1]
    parts, new = parts[once], new[once]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(parts)))
    return parts, begin, count, marked | (count > LARGE)


def _once(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a table, and how often each is there."""
    links = links[:, np.lexsort(links[::-1])]
    first = np.flatnonzero(np.concatenate([[True], (links[:, 1:] != links[:, :-1]).any(axis=0)])[: links.shape[1]])
    return links[:, first], np.diff(np.append(first, links.shape[1]))


_LINKS = {"id": "long", "row": "long", "n": "long", "node": "long", "other": "long", "key": "long", "shared": "long", "need": "long", "other_need": "long"}


def _rows(bucket, **given):
    """Rows with the given columns; the others are null."""
    kinds = {name: pa.int64() for name in _LINKS} | {"pairs": pa.binary(), "heavy": pa.binary()}
    made = [pa.array(given[name], kind) if name in given else pa.nulls(len(bucket), kind) for name, kind in kinds.items()]
    return pa.record_batch([pa.array(bucket, pa.int32()), *made], ["bucket", *kinds])


def _members_of(parts, count, large):
    """The nodes of heavy keys."""
    held = parts[np.repeat(large, count)]
    return {"node": held["node"], "key": held["key"].view(np.int64), "need": held["need"].astype(np.int64)}


def _packs(parts: np.ndarray, buckets: int):
    """Bucket numbers, and the parts of each as bytes."""
    bucket = ((parts["key"] >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    names, begin = np.unique(bucket[order], return_index=True)
    return names, [part.tobytes() for part in np.split(parts[order], begin[1:])] if len(names) else []


@in_parts
def _describe(batches, size: int, percent: int, buckets: int):
    """Size and node of each document, and the part keys of the nodes, packed by bucket of the key.

    A task gives the keys of a node once. Where many nodes of a batch share a key, they are given as its members and
    one of them goes to the key's bucket, marked as heavy. So no bucket gets many rows of a key from one batch.
    """
    seen: set[int] = set()
    limits = _bounds(percent)
    for batch in small(batches):
        n, node, made = [], [], []
        for grams in _sets(batch.column("text"), size):
            n.append(len(grams))
            node.append(_digest(grams) if len(grams) else None)
            if len(grams) and node[-1] not in seen:
                keys, needs = signatures(grams, percent, limits)
                parts = np.empty(len(keys), PART)
                parts["key"], parts["node"], parts["need"] = keys, node[-1], needs
                made.append(parts)
                seen.add(node[-1])
                if len(seen) > SEEN_SETS:
                    seen.clear()
        spread = np.array([(x or 0) % buckets for x in node], np.int32)
        yield _rows(spread, id=batch.column("id"), row=batch.column("row"), n=n, node=node)
        if not made:
            continue
        parts = np.concatenate(made)
        parts, begin, count, large = _groups(parts, np.zeros(len(parts), bool))
        found = _members_of(parts, count, large)
        yield _rows(found["node"] % buckets, **found)
        names, packs = _packs(parts[~np.repeat(large, count)], buckets)
        yield _rows(names, pairs=packs)
        names, packs = _packs(parts[begin[large]], buckets)
        yield _rows(names, heavy=packs)


def _pairs(parts, begin, count, large):
    """Pairs of nodes in the groups that are not large: both, what either needs, and the number of keys they share.

    So many pairs are counted at once, and a pair may come several times with a part of its count.
    """
    held, waiting = [], 0
    for size in range(2, LARGE + 1):
        at = begin[(count == size) & ~large]
        a, b = np.triu_indices(size, 1)
        step = max(1, PAIRS // len(a))
        for few in (at[i : i + step] for i in range(0, len(at), step)):
            group = parts[few[:, None] + np.arange(size)]
            columns = [group[name][:, at].ravel().astype(np.int64) for name in ("node", "need") for at in (b, a)]
            held.append(np.stack(columns))
            waiting += held[-1].shape[1]
            if waiting >= PAIRS:
                yield _once(np.concatenate(held, axis=1))
                held, waiting = [], 0
    if held:
        yield _once(np.concatenate(held, axis=1))


@in_parts
def _link(batches):
    """Pairs of nodes that share keys and members of heavy keys, one bucket after the other; other rows pass."""

    def flush():
        light, heavy = (np.frombuffer(b"".join(x), PART) for x in (held, marked))
        parts, begin, count, large = _groups(np.concatenate([light, heavy]), np.arange(len(light) + len(heavy)) >= len(light))
        del light, heavy
        yield from given(_members_of(parts, count, large))
        for (node, other, need, other_need), shared in _pairs(parts, begin, count, large):
            yield from given({"node": node, "other": other, "need": need, "other_need": other_need, "shared": shared})

    def given(columns):
        for row in range(0, len(columns["node"]), ROWS):
            few = {name: values[row : row + ROWS] for name, values in columns.items()}
            yield _rows(np.zeros(len(few["node"]), np.int32), **few).drop_columns(["bucket", "pairs", "heavy"])

    held, marked, now = [], [], None
    for batch in batches:
        packed = pc.or_(batch.column("pairs").is_valid(), batch.column("heavy").is_valid())
        yield batch.filter(pc.invert(packed)).drop_columns(["bucket", "pairs", "heavy"])
        packs = batch.filter(packed)
        for bucket, pairs, heavy in zip(packs.column("bucket").to_pylist(), packs.column("pairs"), packs.column("heavy")):
            if bucket != now and (held or marked):
                yield from flush()
                held, marked = [], []
                give_back()
            now = bucket
            if pairs.is_valid:
                held.append(pairs.as_py())
            else:
                marked.append(heavy.as_py())
        del packs, packed
    if held or marked:
        yield from flush()
        held, marked = [], []
    give_back()


@in_parts
def _members(batches, size: int):
    """Sets of the documents that stand for their nodes."""
    for batch in small(batches):
        kept = list(_sets(batch.column(2), size))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array([_digest(g) for g in kept], pa.int64()), lists([signed(g) for g in kept])],
            ["node", "block", "digest", "grams"],
        )


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


class Branch:
    """A run of n-grams that the sets below share, and what is known of those sets."""

    __slots__ = ("run", "has", "below", "ends", "depth", "least", "most", "one")

    def __init__(self, run, depth, size, one):
        self.run, self.has, self.depth = run, frozenset(run), depth
        self.below, self.ends = {}, []
        self.least = self.most = size
        self.one = one  # a set of the only component below, or None


class PrefixTree:
    """Ordered sets in a tree of shared prefixes, with a walk that finds the linked ones."""

    def __init__(self, percent: int, union: Union):
        self.percent, self.union = percent, union
        self.root = Branch((), 0, 0, None)
        self.root.least = 1 << 60

    def add(self, item: int, ranks: list[int]) -> None:
        size, at, branch = len(ranks), 0, self.root
        find = self.union.find
        while True:
            branch.least, branch.most = min(branch.least, size), max(branch.most, size)
            if branch.one is not None and find(branch.one) != find(item):
                branch.one = None
            if at == size:
                branch.ends.append(item)
                return
            child = branch.below.get(ranks[at])
            if child is None:
                child = branch.below[ranks[at]] = Branch(tuple(ranks[at:]), size, size, item)
                child.ends.append(item)
                return
            same, run = 1, child.run
            most = min(len(run), size - at)
            while same < most and run[same] == ranks[at + same]:
                same += 1
            if same < len(run):  # the run parts here
                upper = Branch(run[:same], at + same, 0, child.one)
                upper.least, upper.most = child.least, child.most
                child.run, child.has = run[same:], frozenset(run[same:])
                upper.below[run[same]] = child
                branch.below[ranks[at]] = child = upper
            at, branch = at + same, child

    def links(self, item: int | None, ranks: list[int]):
        """Items linked with a set; with ``item`` given, branches of its own component are left out."""
        p, size, own = self.percent, len(ranks), frozenset(ranks)
        low, high = -(-size * p // 100), size * 100 // p
        find = self.union.find
        stack = [(child, 0) for child in self.root.below.values()]
        while stack:
            branch, overlap = stack.pop()
            if branch.most < low or branch.least > high:
                continue
            if item is not None and branch.one is not None and find(branch.one) == find(item):
                continue
            overlap += len(own & branch.has)
            need = -(-p * (size + max(branch.least, low)) // (100 + p))
            left = min(size - bisect_right(ranks, branch.run[-1]), branch.most - branch.depth)
            if overlap + left < need:
                continue
            if branch.ends and 100 * overlap >= p * (size + branch.depth - overlap):
                yield from branch.ends
            stack += [(child, overlap) for child in branch.below.values()]


def _ordered(sets: list[np.ndarray]) -> list[list[int]]:
    """Sets as ascending ranks in one order of all their n-grams: those of most sets first, then by key."""
    if not sets:
        return []
    names, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(names), np.int64)
    rank[np.lexsort((names, -count))] = np.arange(len(names))
    ranks = rank[where]
    ends = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(part).tolist() for part in np.split(ranks, ends)]


def _sets_in(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    prefix = "" if "node" in table.schema.names else table.schema.names[0][:2]
    nodes = table.column(f"{prefix}node").to_pylist()
    grams = table.column(f"{prefix}grams").combine_chunks()
    flat, at = unsigned(grams.flatten().to_numpy(zero_copy_only=False)), grams.offsets.to_numpy()
    return nodes, [flat[a - at[0] : b - at[0]] for a, b in zip(at[:-1], at[1:])]


def _join_chunk(table: pa.Table, percent: int) -> pa.Table:
    """The smallest node of its component for each set of a chunk, and whether the leader is in it."""
    table = table.sort_by("node")
    nodes, sets = _sets_in(table)
    keep = [i for i in range(len(nodes)) if i == 0 or nodes[i] != nodes[i - 1]]
    nodes, sets = [nodes[i] for i in keep], [sets[i] for i in keep]
    lead = table.column("leader")[0].as_py()
    union = Union(len(nodes))
    tree = PrefixTree(percent, union)
    for item, ranks in enumerate(_ordered(sets)):
        for other in tree.links(item, ranks):
            union.join(item, other)
        tree.add(item, ranks)
    root = [union.find(i) for i in range(len(nodes))]
    main = root[nodes.index(lead)] if lead in nodes else -1
    return pa.table(
        {
            "block": pa.array([table.column("block")[0].as_py()] * len(nodes), pa.int64()),
            "node": pa.array(nodes, pa.int64()),
            "root": pa.array([nodes[r] for r in root], pa.int64()),
            "main": pa.array([r == main for r in root], pa.bool_()),
        }
    )


def _join_rest(rest: pa.Table, chunk: pa.Table, percent: int) -> pa.Table:
    """Links between the sets that missed the leader and a chunk, one for each pair of components here."""
    if not rest.num_rows or not chunk.num_rows:
        return pa.table({"node": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    left, left_sets = _sets_in(rest)
    right, right_sets = _sets_in(chunk)
    ranked = _ordered(left_sets + right_sets)
    union = Union(len(ranked))
    tree = PrefixTree(percent, union)
    for item in range(len(left)):
        tree.add(item, ranked[item])
    for item in range(len(left), len(ranked)):
        for other in tree.links(item, ranked[item]):
            union.join(item, other)
    names = left + right
    rows = [(names[i], names[r]) for i in range(len(names)) if (r := union.find(i)) != i]
    return pa.table({"node": pa.array([a for a, _ in rows], pa.int64()), "root": pa.array([b for _, b in rows], pa.int64())})


def _solve(sets: DataFrame, percent: int, chunk_grams: int) -> DataFrame:
    """Node and root for all sets of blocks with more than one set."""
    size = F.sum(F.size("grams")).cast("long")
    heads = sets.groupBy("block").agg(size.alias("total"), F.min("node").alias("leader"))
    split = materialize(heads.where(F.col("total") > chunk_grams), "split")
    split = split.withColumn("chunks", F.ceil(F.col("total") / F.lit(chunk_grams)).cast("int"))
    join = partial(_join_chunk, percent=percent)
    schema = "block long, node long, root long, main boolean"
    whole = sets.join(split.select("block"), "block", "left_anti").withColumn("leader", F.lit(None).cast("long"))
    few = whole.groupBy("block").applyInArrow(lambda t: join(t), schema).select("node", "root")
    if not split.limit(1).count():
        return few
    # The leader of a block is in all of its chunks.
    large = sets.join(split, "block").withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)").cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    at = F.when(F.col("node") == F.col("leader"), everywhere).otherwise(F.array("chunk"))
    placed = large.withColumn("chunk", F.explode(at)).select("block", "chunk", "node", "leader", "grams")
    solved = materialize(placed.groupBy("block", "chunk").applyInArrow(lambda t: join(t), schema), "solved", fine=True)
    # What the leader did not reach meets all chunks, in groups of bounded size.
    missed = solved.where("not main").select("block", "node").distinct()
    rest = materialize(missed.join(large.select("node", "chunks", "grams"), "node"), "rest")
    groups = rest.groupBy("block").agg(F.ceil(size / F.lit(chunk_grams)).cast("int").alias("groups"))
    groups = materialize(groups, "groups")
    left = rest.join(groups, "block").withColumn("group", F.expr("pmod(xxhash64(node, 1), groups)").cast("int"))
    left = left.withColumn("chunk", F.explode(everywhere)).select("block", "chunk", "group", "node", "grams")
    right = sets.join(split, "block").withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)").cast("int"))
    right = right.join(groups, "block").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    right = right.select("block", "chunk", "group", "node", "grams")
    by = ["block", "chunk", "group"]
    left, right = left.toDF(*(f"l_{c}" for c in left.columns)), right.toDF(*(f"r_{c}" for c in right.columns))
    met = left.groupBy(*(f"l_{c}" for c in by)).cogroup(right.groupBy(*(f"r_{c}" for c in by)))
    links = met.applyInArrow(lambda a, b: _join_rest(a, b, percent), "node long, root long")
    return few.union(components(solved.select("node", "root").union(links), "node", "root"))


def _position(column: str):
    return F.expr(f"pmod(xxhash64({column}), {FILTER_BITS}L)").cast("int")


def _filter_table(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size that passes all of the ids, and few others unless they are many."""
    word, bits = F.shiftright("at", 5).alias("word"), F.expr("bit_or(shiftleft(1L, at & 31))").alias("bits")
    found = ids.select(_position(column).alias("at")).groupBy(word).agg(bits).toArrow()
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table


def _pass(batches, table: np.ndarray):
    """Rows whose id may be wanted, so that a join moves few texts that it does not want."""
    for batch in batches:
        at = batch.column("at").to_numpy()
        yield batch.filter(pa.array((table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)).drop_columns(["at"])


def _candidates(found: DataFrame) -> DataFrame:
    """Pairs ``node, other`` that connect all nodes which may be linked.

    The two schemes of a set ask for different numbers of keys, which tells them apart. Of the keys that linked nodes
    share, at most so many are heavy as either has of them. If that leaves one or more for either, the pair is among
    those that share light keys. If it does not, both have few light keys, and the pair shares a light or a heavy one.
    """
    members = found.where("key is not null").select("node", "key", "need").distinct()
    heavy = materialize(members.groupBy("node", "need").agg(F.count("*").alias("n_heavy")), "heavy")
    pairs = found.where("other is not null").groupBy("node", "other", "need", "other_need").agg(F.sum("shared").alias("shared"))
    others = heavy.select(F.col("node").alias("other"), F.col("need").alias("other_need"), F.col("n_heavy").alias("other_heavy"))
    both = pairs.join(heavy, ["node", "need"], "left").join(others, ["other", "other_need"], "left")
    left = F.greatest(F.col("need") - F.coalesce("n_heavy", F.lit(0)), F.col("other_need") - F.coalesce("other_heavy", F.lit(0)))
    light = both.where(F.col("shared") >= left).select("node", "other")
    few = members.join(heavy.where("need <= n_heavy"), ["node", "need"]).select("node", "key").distinct()
    least = few.groupBy("key").agg(F.min("node").alias("other"))
    return light.union(few.join(least, "key").where("node <> other").select("node", "other")).distinct()


def linked_rows(rows: DataFrame, size: int, percent: int, chunk_grams: int = CHUNK_GRAMS) -> DataFrame:
    """``id, row, n, group`` from ``id, row, text``; linked rows have one group, texts without words have none.

    ``row`` tells rows apart and must be the same in every pass.
    """
    # Two schemes of about most + most / 5 parts for a set of as many n-grams as words.
    share = 2 * 1.2 * 2 * (100 - percent) / (100 + percent) * PART.itemsize / WORD_BYTES
    written = share * (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = 64 + math.ceil(written / BUCKET_BYTES)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // TASK_BUCKETS)
    describe = partial(_describe, size=size, percent=percent, buckets=buckets)
    columns = ", ".join(f"{name} {kind}" for name, kind in _LINKS.items())
    packed = rows.select("id", "row", "text").mapInArrow(describe, f"bucket int, {columns}, pairs binary, heavy binary")
    met = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = materialize(met.mapInArrow(_link, columns), "sets", fine=True)
    described = found.where("other is null and key is null").select("id", "row", "n", "node")
    links = components(_candidates(found), "node", "other")
    block = materialize(links, "candidates").select("node", F.col("root").alias("block"))
    # One text for each node of a block; the sets are made again from it, as few rows need them.
    stands = described.join(block, "node").groupBy("node", "block").agg(F.min("row").alias("row"))
    stands = materialize(stands, "stands")
    placed = rows.select("row", "text", _position("row").alias("at"))
    likely = placed.mapInArrow(partial(_pass, table=_filter_table(stands, "row")), "row long, text string")
    texts = likely.join(stands, "row").select("node", "block", "text")
    made = texts.mapInArrow(partial(_members, size=size), "node long, block long, digest long, grams array<long>")
    sets = materialize(made.where("digest = node").drop("digest"), "members", fine=True)
    root = _solve(sets, percent, chunk_grams)
    return described.join(root, "node", "left").select("id", "row", "n", F.coalesce("root", "node").alias("group"))


def jaccard_components(
    docs: DataFrame,
    size: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_grams: int = CHUNK_GRAMS,
) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for each row.

    Rows link when the Jaccard similarity of their word n-gram sets is ``percent`` / 100 or more; ``component_id`` is the
    smallest id that links reach. Texts without words (null, empty, white space) have no n-grams and link with nothing.
    Equal rows link as any equal texts do. A row with a null id is a document whose component has the smallest
    id that is not null, or null if there is none. Other columns are not looked at.
    """
    text = F.col(text_col).cast("string").alias("text")
    numbered = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), text)
    named = linked_rows(materialize(numbered, "rows"), size, percent, chunk_grams)
    least = named.where("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    joined = named.join(least, "group", "left")
    return joined.select("id", F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))
