"""Trie of conversation prefixes, from ternary search trees per range shard.

A turn is a symbol of fixed width: a 128-bit mark of role and text, and the text's length. A
rebuilt conversation is the string of its symbols, its *path*. Paths are dealt out by range, so
a shard holds neighbours. In a shard the symbols are dictionary-encoded in their order, the
distinct paths go into a ternary search tree over these codes, the median first, and nodes are
walked from the last one made to the first (a parent is always made before its children), which
adds up members, leaves and savings.

A node that lies in several shards is on the path a shard begins or ends with. Such boundary
nodes are reported per shard, as one row for its first and its last path, and are merged by
folding these few rows in the order of the shards with a stack as deep as a path.

A path shared by very many conversations is no hot key: conversations are dealt out by (path, id),
each task joins its ids to long strings, and only those strings, in order, pass through the hash
of the path's members. No text leaves its first task.

Defined cases: null role or text is empty; turns order by number, null first, then by their mark
(turns with equal number, role and text are alike); rows without a conv_id belong to no
conversation; a repeated row is a further turn; bases of negative ids follow the remainder's sign
(-7 % 100 = -7); an empty table has no nodes, not even the root; other columns are ignored. A
conversation's symbols must fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.plans.bounded import settle

#: Conversations of a base, and by how much heads differ in length.
BASE, HEADS = 100, 6
#: Bytes of a mark and of a symbol.
MARK, SYMBOL = 16, 24
#: Ids joined to one string, and rows of a result batch.
JOINED_IDS, BATCH = 4096, 8192
#: Turns of a shard, about.
SHARD_TURNS = 500_000

_NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("node_key", pa.binary()),
]
_NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, node_key binary"
)
#: A chain of boundary nodes: a path, and for its last nodes (the others are told by the chain
#: before) the lists of what the shard knows about them.
_CHAIN_LISTS = ["least", "members", "children", "leaves", "saved"]
_CHAIN = [("path", pa.binary()), ("ends", pa.list_(pa.string())), *((c, pa.list_(pa.int64())) for c in _CHAIN_LISTS)]
_CHAIN_DDL = "path binary, ends array<string>, " + ", ".join(f"{c} array<long>" for c in _CHAIN_LISTS)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def symbols(conversations: DataFrame) -> DataFrame:
    """(conv, turns) with the symbols of a conversation in order, as hexadecimal text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    symbol = F.concat(mark, F.lower(F.lpad(F.hex(F.length(text).cast("long")), 16, "0")))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), symbol.alias("symbol")
    )
    # Nulls sort first in a struct, as the order of turns asks for.
    ordered = F.sort_array(F.collect_list(F.struct("turn", "symbol")))
    return rows.groupBy("conv").agg(ordered.alias("t")).select("conv", F.transform("t", lambda t: t["symbol"]).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv, path) of every conversation: the head of its base, then its own turns after it."""
    given = stored(symbols(conversations), "turns")
    heads = given.where(F.col("conv") % BASE == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    own = given.select("conv", "turns", (F.col("conv") - F.col("conv") % BASE).alias("base"), h.cast("int").alias("h"))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv", F.unhex(F.array_join(F.concat(head, rest), "")).alias("path"))


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, first, n, ids): runs of equal paths with their ids as text, in order."""
    path, ids = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"path": pa.array([path], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "n": pa.array([len(ids)], pa.int64()), "ids": [",".join(map(str, ids))]}
        )

    for batch in batches:
        for p, conv in zip(batch.column("path").to_pylist(), batch.column("conv").to_pylist()):
            if ids and (p != path or len(ids) == JOINED_IDS):
                yield out()
                ids = []
            path = p
            ids.append(conv)
    if ids:
        yield out()


def member_runs(paths: DataFrame, tasks: int) -> DataFrame:
    """Equal paths in runs of a bounded number of ids, the runs of a path in the order of ids."""
    dealt = paths.repartitionByRange(tasks, "path", "conv").sortWithinPartitions("path", "conv")
    return dealt.mapInArrow(_joined_ids, "path binary, first long, n long, ids string")


class Shard:
    """A ternary search tree over the paths of a shard, and the trie that it spells."""

    def __init__(self, paths: list[bytes], least: list[int], members: list[int], ends: list[str]):
        """Distinct ascending paths with their smallest id, number of ids and hash of ids."""
        self.paths = paths
        lengths = [len(p) // SYMBOL for p in paths]
        book, codes = np.unique(np.frombuffer(b"".join(paths), f"S{SYMBOL}"), return_inverse=True)
        # Trailing zero bytes are cut off by the text type; the width is put back where read.
        self.book = [bytes(b).ljust(SYMBOL, b"\0") for b in book.tolist()]
        cuts = np.cumsum([0, *lengths])
        self.codes = [codes[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
        # Node 0 is the root. The search tree's links hold 0 for none; `eq` is a node's first child.
        self.code, self.lo, self.eq, self.hi, self.parent, self.depth = [-1], [0], [0], [0], [-1], [0]
        self.least: list[int | None] = [None]
        self.members, self.ends = [0], [_NO_ENDS]
        spans = [(0, len(paths))]
        while spans:
            first, last = spans.pop()
            if first < last:
                middle = (first + last) // 2
                node = self._insert(self.codes[middle])
                self.members[node], self.least[node], self.ends[node] = members[middle], least[middle], ends[middle]
                spans += [(first, middle), (middle + 1, last)]

    def _child(self, node: int, code: int, make: bool) -> int:
        """The child of a node by its code: a search among its children's tree."""
        links, at = self.eq, node
        while links[at]:
            found = links[at]
            if code == self.code[found]:
                return found
            links, at = (self.lo if code < self.code[found] else self.hi), found
        if not make:
            return 0
        links[at] = new = len(self.code)
        for column, value in (
            (self.code, code), (self.lo, 0), (self.eq, 0), (self.hi, 0), (self.parent, node), (self.depth, self.depth[node] + 1),
            (self.least, None), (self.members, 0), (self.ends, _NO_ENDS),
        ):
            column.append(value)
        return new

    def _insert(self, codes: list[int]) -> int:
        node = 0
        for code in codes:
            node = self._child(node, code, True)
        return node

    def walk(self, codes: list[int]) -> list[int]:
        """The nodes of a path, from the root on."""
        nodes = [0]
        for code in codes:
            nodes.append(self._child(nodes[-1], code, False))
        return nodes

    def sums(self, boundary: set[int]) -> None:
        """Members, smallest ids, children, leaves and savings of every node. A boundary node
        gets no leaves, savings or children from boundary children, and none of its own: what
        it is worth is known after merging."""
        count = len(self.code)
        self.children, self.leaves, self.saved = [0] * count, [0] * count, [0] * count
        for node in range(count - 1, -1, -1):
            up, edge = self.parent[node], node in boundary
            if not edge:
                if not self.children[node]:
                    self.leaves[node] = 1
                if node:
                    self.saved[node] += (self.members[node] - 1) * int.from_bytes(self.book[self.code[node]][MARK:], "big")
            if up < 0:
                continue
            self.members[up] += self.members[node]
            if self.least[up] is None or self.least[node] < self.least[up]:
                self.least[up] = self.least[node]
            if not edge:
                self.children[up] += 1
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.blake2b(path[: depth * SYMBOL], digest_size=16).digest()


def _batches(rows: Iterator[tuple], fields: list) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(fields)
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _paths_of(batches: Iterable[pa.RecordBatch]) -> tuple[list, list, list, list]:
    """Distinct paths of a shard, with smallest id, number and hash of their ids. The hash takes
    the runs of a path one after the other."""
    paths, least, members, ends, running = [], [], [], [], None
    for batch in batches:
        for path, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "n", "ids"))):
            if paths and paths[-1] == path:
                running.update(b"," + ids.encode())
                members[-1] += n
                continue
            if running:
                ends.append(running.hexdigest())
            running = hashlib.sha256(ids.encode())
            paths.append(path)
            least.append(first)
            members.append(n)
    if running:
        ends.append(running.hexdigest())
    return paths, least, members, ends


def _shard_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The nodes that lie in this shard alone, and the chains of the others."""
    paths, least, members, ends = _paths_of(batches)
    if not paths:
        return
    shard = Shard(paths, least, members, ends)
    first, last = shard.walk(shard.codes[0]), shard.walk(shard.codes[-1])
    boundary = {*first, *last}
    shard.sums(boundary)
    # Prefixes up to boundary nodes, for the keys of their other children.
    place = {n: (p, d) for p, chain in ((paths[0], first), (paths[-1], last)) for d, n in enumerate(chain)}
    none = (None,) * len(_CHAIN)
    for node in range(1, len(shard.code)):
        if node not in boundary:
            up = shard.parent[node]
            edge = up in boundary
            yield (
                shard.least[node], shard.depth[node], None if edge else shard.least[up], _key(*place[up]) if edge else None,
                shard.members[node], shard.children[node], shard.leaves[node], shard.saved[node], shard.ends[node], None, *none,
            )
    common = sum(a == b for a, b in zip(first, last))
    for path, chain in ((paths[0], first), (paths[-1], last[common:])):
        if chain:
            lists = ([column[n] for n in chain] for column in (shard.ends, shard.least, shard.members, shard.children, shard.leaves, shard.saved))
            yield (*(None,) * len(_NODE), path, *lists)


def _merged_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Boundary nodes from chains in the order of their paths, whole once the path leaves them."""
    path, stack = b"", []  # a node: [least, members, children, leaves, saved, ends]

    def left(depth: int) -> Iterator[tuple]:
        while len(stack) > depth:
            least, members, children, leaves, saved, ends = stack.pop()
            at = len(stack)
            leaves = leaves if children else 1
            if at:
                saved += (members - 1) * int.from_bytes(path[(at - 1) * SYMBOL + MARK : at * SYMBOL], "big")
                up = stack[-1]
                up[2] += 1
                up[3] += leaves
                up[4] += saved
            yield (least, at, None, _key(path, at - 1) if at else None, members, children, leaves, saved, ends, _key(path, at))

    for batch in batches:
        for row in batch.to_pylist():
            new, nodes = row["path"], [list(n) for n in zip(*(row[c] for c in _CHAIN_LISTS), row["ends"])]
            skip = len(new) // SYMBOL + 1 - len(nodes)  # nodes told by the chain before
            same = 0
            while same < min(len(stack) - 1, len(new) // SYMBOL) and path[same * SYMBOL : (same + 1) * SYMBOL] == new[same * SYMBOL : (same + 1) * SYMBOL]:
                same += 1
            yield from left(min(same + 1, len(stack)))
            path = new
            for depth, node in enumerate(nodes, skip):
                if depth == len(stack):
                    stack.append(node)
                    continue
                held = stack[depth]
                held[0] = min(held[0], node[0])
                for k in range(1, 5):
                    held[k] += node[k]
                if node[5] != _NO_ENDS:
                    held[5] = node[5]
    yield from left(0)


def nodes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    spark = conversations.sparkSession
    paths = stored(rebuilt(conversations), "paths")
    turns = paths.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    tasks = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // (SYMBOL * SHARD_TURNS) + 1)
    runs = stored(member_runs(paths, tasks), "runs")
    # The runs of a path meet in one shard: they are few, as each holds many ids.
    dealt = runs.repartitionByRange(tasks, "path").sortWithinPartitions("path", "first")
    mixed = stored(dealt.mapInArrow(lambda b: _batches(_shard_rows(b), _NODE + _CHAIN), f"{_NODE_DDL}, {_CHAIN_DDL}"), "shards")
    chains = mixed.where("path is not null").select([c for c, _ in _CHAIN])
    # Two rows per shard, whatever the number of conversations. A shard's second chain comes
    # after its first, as its path is larger.
    folded = chains.repartition(1).sortWithinPartitions("path")
    merged = stored(folded.mapInArrow(lambda b: _batches(_merged_rows(b), _NODE), _NODE_DDL), "boundary")
    inner = mixed.where("path is null").select([c for c, _ in _NODE])
    parents = settle(merged.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("_up"))).df
    return inner.unionByName(merged).join(parents, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_up").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
