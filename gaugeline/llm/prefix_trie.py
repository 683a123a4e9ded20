"""Trie of conversation prefixes, by adaptive radix trees over turn ids.

A turn has an id of fixed width, big-endian bytes: a digest of role and text, and the bytes of the text. A
conversation is a path, the ids of its turns one after the other. Paths are sorted and dealt to tasks by
ranges of path and conversation, so a path or a first turn that very many conversations share lies in
many tasks. Each task builds an adaptive radix tree over a block of paths at a time: inner nodes grow from
4 to 16, 48 and 256 children, and bytes without a branch are kept in one piece. Each depth in bytes that is
a whole number of turns is a node of the trie.

A node of a block is whole unless the first or the last path of the block begins with it: only these
edges, one path each, may go on in the next block. Whole nodes leave with all their figures. The rows of the
edges, a few for each block whatever its size, pass through one stack in the order of the paths, which
joins the parts of a node. What that stack holds is one path; what passes it are the edges alone.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import ragged
from gaugeline.llm.tables import written

DIGEST = 16
#: Bytes of a turn's id: a digest, and the length of the text in 4 bytes.
WIDTH = DIGEST + 4
#: A block ends with this many conversations or bytes of paths.
BLOCK_PATHS = 20_000
BLOCK_BYTES = 8 << 20
#: Conversation ids in one row of an edge.
_LISTED = 256


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn. Null role or text is empty. Two different turns share an id with a probability of
    2**-128, as it is half of a SHA-256 digest of the role's length, the role and the text."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def paths(turns: DataFrame) -> DataFrame:
    """``(conv_id, path)`` of each conversation in ``turns(conv_id, turn, role, text)``: its turn ids by turn,
    null turns first, turns of one number by their id. Repeated rows are turns of their own; rows without
    conv_id are left out. Other columns are ignored, whatever their names. Texts stay where they are: 20 bytes a turn are
    shuffled. A conversation is one path and so one row, however long it is."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("id"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    ids = F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.hex(t["id"]))
    return rows.groupBy("conv_id").agg(ids.alias("ids")).select("conv_id", F.unhex(F.array_join("ids", "")).alias("path"))


def rebuilt(whole: DataFrame) -> DataFrame:
    """Paths that share beginnings: conversation c takes the first h turns of conversation c - c % 5, all if
    it has fewer and none without it, and its own after its first h, where h = crc32(c) % 9."""
    shared = whole.select(F.col("conv_id").alias("first"), F.col("path").alias("lead")).where("first % 5 = 0")
    rows = whole.withColumn("first", F.col("conv_id") - F.col("conv_id") % 5).join(shared, "first", "left")
    cut = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int") * WIDTH
    lead = F.coalesce(F.substring(F.col("lead"), F.lit(1), cut), F.lit(b""))
    own = F.substring(F.col("path"), cut + 1, F.length("path"))
    return rows.select("conv_id", F.concat(lead, own).alias("path"))


class Node:
    """An inner node: a compressed run of bytes, children by their next byte, and the place of the path that
    ends here. Children lie in a layout of 4 or 16 sorted bytes, of an index of 256 bytes into 48 slots, or
    of 256 slots; a full layout gives way to the next."""

    __slots__ = ("run", "keys", "slots", "place")
    SORTED, INDEXED = 16, 48

    def __init__(self, run: bytes):
        self.run, self.keys, self.slots, self.place = run, bytearray(), [], None

    def child(self, byte: int) -> Node | None:
        if self.keys is None:
            return self.slots[byte]
        if len(self.keys) == 256:
            slot = self.keys[byte]
            return self.slots[slot - 1] if slot else None
        i = bisect_left(self.keys, byte)
        return self.slots[i] if i < len(self.keys) and self.keys[i] == byte else None

    def put(self, byte: int, child: Node) -> None:
        """Add or replace a child."""
        if self.keys is None:
            self.slots[byte] = child
        elif len(self.keys) == 256:
            if self.keys[byte]:
                self.slots[self.keys[byte] - 1] = child
            elif len(self.slots) < self.INDEXED:
                self.slots.append(child)
                self.keys[byte] = len(self.slots)
            else:
                self.slots = [self.slots[s - 1] if s else None for s in self.keys]
                self.keys = None
                self.slots[byte] = child
        else:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.slots[i] = child
            elif len(self.keys) < self.SORTED:
                self.keys.insert(i, byte)
                self.slots.insert(i, child)
            else:
                index = bytearray(256)
                for slot, key in enumerate(self.keys):
                    index[key] = slot + 1
                self.keys = index
                self.put(byte, child)

    def children(self) -> list[Node]:
        """Children by ascending byte."""
        if self.keys is None:
            return [c for c in self.slots if c is not None]
        if len(self.keys) == 256:
            return [self.slots[s - 1] for s in self.keys if s]
        return list(self.slots)


def _common(a: bytes, b: bytes) -> int:
    """Bytes with which both begin."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # the first difference lies between
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


class Tree:
    """An adaptive radix tree of paths."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, path: bytes, place: int) -> None:
        node, above, at = self.root, None, 0
        while True:
            same = _common(node.run, path[at:at + len(node.run)])
            if same < len(node.run):  # the path leaves within the run: part the run there
                upper = Node(node.run[:same])
                node.run = node.run[same:]
                upper.put(node.run[0], node)
                if above is None:
                    self.root = upper
                else:
                    above.put(upper.run[0], upper)
                node = upper
            at += same
            if at == len(path):
                node.place = place
                return
            below = node.child(path[at])
            if below is None:
                leaf = Node(path[at:])
                leaf.place = place
                node.put(path[at], leaf)
                return
            above, node = node, below

    def walk(self) -> Iterator[tuple[int, int, int | None]]:
        """``(low, high, place)`` of each node after all below it, in bytes: a node stands for the depths from
        ``low``, left out, to ``high``; the root for depth 0 too. Children come by ascending byte."""
        stack = [(self.root, -1, len(self.root.run), iter(self.root.children()))]
        while stack:
            node, low, high, left = stack[-1]
            below = next(left, None)
            if below is None:
                stack.pop()
                yield low, high, node.place
            else:
                stack.append((below, high, high + len(below.run), iter(below.children())))


class _Open:
    """A node of the trie while nodes below it are still coming. ``below`` has the rows that wait for it."""

    __slots__ = ("turn", "conv", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, turn: bytes):
        self.turn, self.conv, self.n, self.children, self.leaves, self.saved, self.ends, self.below = turn, None, 0, 0, 0, 0, (), []

    def members(self, conv: int | None, n: int) -> None:
        if n:
            self.conv, self.n = conv if self.conv is None else min(self.conv, conv), self.n + n

    def add(self, children: int, leaves: int, saved: int) -> None:
        self.children, self.leaves, self.saved = self.children + children, self.leaves + leaves, self.saved + saved

    def close(self) -> None:
        """All below it has come: it counts itself."""
        self.leaves += not self.children
        self.saved += (self.n - 1) * int.from_bytes(self.turn[DIGEST:], "big")  # 0 at the root, which has no turn


#: Figures of a node, or of the part of it that a block has, and the key of the edge above it, if any. A
#: part of an edge also has its place among all parts, its own key, and conversations that end there.
_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("turn_id", pa.binary()), ("above", pa.binary())]
_PARTS = pa.schema([*_NODE, ("task", pa.int64()), ("place", pa.int64()), ("key", pa.binary()), ("ends", pa.string())])
_JOINED = pa.schema([*_NODE, ("key", pa.binary())])
_TYPES = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_TYPES[f.type]}" for f in schema)


def _keys(path: bytes) -> list[bytes]:
    """A key for each beginning of a path in turns, the empty one first."""
    digest, found = hashlib.sha256(), []
    for at in range(0, len(path) + 1, WIDTH):
        found.append(digest.copy().digest()[:DIGEST])
        digest.update(path[at:at + WIDTH])
    return found


def block_parts(ids: list[int], block: list[bytes]) -> Iterator[tuple]:
    """Whole nodes and parts of edges, as rows of ``_PARTS`` without task and place, of a block of paths in
    order, equal ones by id. The parts of the edges come last, in the order of the paths."""
    begins = [i for i, path in enumerate(block) if not i or path != block[i - 1]]
    bounds = [*begins, len(ids)]
    tree = Tree()
    for place, begin in enumerate(begins):
        tree.insert(block[begin], place)
    first, last = block[0], block[-1]
    keys = {False: _keys(first), True: _keys(last)}
    fork = _common(first, last) // WIDTH  # to this depth both edges are one
    edges: dict[tuple[int, bool], _Open] = {}
    waiting: dict[int, _Open] = {}  # open nodes by depth, all of one path
    path, on_first, on_last = first, 0, 0
    for low, high, place in tree.walk():
        if place is not None:  # else the path before goes through this node too
            path = block[begins[place]]
            on_first, on_last = _common(path, first) // WIDTH, _common(path, last) // WIDTH
        turn = lambda depth: path[max(depth - 1, 0) * WIDTH:depth * WIDTH]
        for depth in range(high // WIDTH, low // WIDTH, -1):
            node = waiting.pop(depth, None) or _Open(turn(depth))
            if place is not None and depth * WIDTH == high:
                node.ends = ids[bounds[place]:bounds[place + 1]]
                node.members(node.ends[0], len(node.ends))
            if depth:
                above = waiting.setdefault(depth - 1, _Open(turn(depth - 1)))
                above.members(node.conv, node.n)
            if depth <= max(on_first, on_last):
                side = depth > on_first
                edges[depth, side] = node
                yield from ((*row, keys[side][depth], None, None) for row in node.below)
                node.below = []
                continue
            node.close()
            above.add(1, node.leaves, node.saved)
            above.below.append((node.conv, depth, None, node.n, node.children, node.leaves, node.saved, _sha(_listed(node.ends)), node.turn))
            yield from ((*row[:2], node.conv, *row[3:], None, None, None) for row in node.below)
    for side, depths in (False, range(len(keys[False]))), (True, range(fork + 1, len(keys[True]))):
        for depth in depths:
            node, key = edges[depth, side], keys[side][depth]
            above = keys[side][depth - 1] if depth else None
            figures = node.conv, node.n, node.children, node.leaves, node.saved
            for at in range(0, max(len(node.ends), 1), _LISTED):
                conv, n, *rest = figures
                yield (conv, depth, None, n, *rest, None, node.turn, above, key, _listed(node.ends[at:at + _LISTED]))
                figures = None, 0, 0, 0, 0


def _listed(ids: Sequence[int]) -> str:
    return ",".join(map(str, ids))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    ids, block, size = [], [], 0
    for batch in batches:
        for conv, path in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist()):
            if ids and (len(ids) >= BLOCK_PATHS or size >= BLOCK_BYTES):
                yield ids, block
                ids, block, size = [], [], 0
            ids.append(conv)
            block.append(path)
            size += len(path)
    if ids:
        yield ids, block


def _tables(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, 4096)):
        yield ragged.table(schema, list(zip(*some)))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, places = TaskContext.get().partitionId(), itertools.count()
    rows = itertools.chain.from_iterable(block_parts(ids, block) for ids, block in _blocks(batches))
    return _tables(_PARTS, ((*row[:10], task, next(places), *row[10:]) for row in rows))


def join_edges(parts: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of ``_JOINED`` from the parts of all edges in the order of the paths, ``(conv_id, depth, n_convs,
    n_children, n_leaves, saved_tokens, turn_id, above, key, ends)``.

    The stack holds the open node of each depth of one path. A part of the node on the stack adds to it;
    another turn at its depth closes it and all below, as paths are in order."""
    stack: list[tuple[_Open, bytes, bytes, object]] = []

    def close():
        node, above, key, ends = stack.pop()
        node.close()
        if stack:
            stack[-1][0].add(1, node.leaves, node.saved)
        return (node.conv, len(stack), None, node.n, node.children, node.leaves, node.saved, ends.hexdigest(), node.turn, above, key)

    for conv, depth, n, children, leaves, saved, turn, above, key, ends in parts:
        while len(stack) > depth and stack[depth][0].turn != turn:
            yield close()
        if len(stack) == depth:
            stack.append((_Open(turn), above, key, hashlib.sha256()))
        node, _, _, listed = stack[depth]
        node.members(conv, n)
        node.add(children, leaves, saved)
        if ends:
            listed.update(("," * bool(node.ends) + ends).encode())
            node.ends = True
    while stack:
        yield close()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "turn_id", "above", "key", "ends")
    rows = (row for batch in batches for row in zip(*(batch.column(name).to_pylist() for name in names)))
    return _tables(_JOINED, join_edges(rows))


def trie(whole: DataFrame) -> DataFrame:
    """One row for each distinct beginning of the paths in ``whole(conv_id, path)``, the empty one among them:
    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn_id)``.

    ``conv_id`` is the smallest member, a path that begins so; ``depth`` counts turns; ``parent_conv_id`` is the
    ``conv_id`` of the beginning one turn shorter, null at the root. ``n_convs`` counts members, ``n_children``
    beginnings one turn longer, ``n_leaves`` those without children in the subtree, top included.
    ``saved_tokens`` sums ``n_convs - 1`` times the bytes of the last text over the subtree. ``ends_sha256``
    is a digest of the ids of the members that end there, ascending and joined by commas. ``turn_id`` is the id
    of the last turn. A null path is empty; an empty table has no root and gives no rows.

    Memory is bounded by a block, or a single longer path. Ids of an ending that lies in several blocks pass
    the last step as text, as a digest must read them in order; nothing of it is held.
    """
    rows = whole.select(F.col("conv_id").cast("long"), F.coalesce("path", F.lit(b"")).alias("path"))
    dealt = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(dealt.mapInArrow(_parts, _ddl(_PARTS)), "trie-parts")
    edges = parts.where("key is not null").repartition(1).sortWithinPartitions("task", "place")
    joined = written(edges.mapInArrow(_edges, _ddl(_JOINED)), "trie-edges")
    names = [name for name, _ in _NODE if name != "above"]
    nodes = parts.where("key is null").unionByName(joined.drop("key"), allowMissingColumns=True)
    uppers = joined.select(F.col("key").alias("above"), F.col("conv_id").alias("upper"))
    found = nodes.join(uppers, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "upper"))
    return found.select(*names)
