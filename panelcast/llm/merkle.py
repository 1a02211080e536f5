"""Merkle manifest of a dataset by time-forward processing.

A node's label is (tree, level, position). Digests travel from children to parents
as messages kept in a priority queue ordered by the label of the receiver, so a
node is hashed when all its messages have arrived. The queue is external: Spark's
shuffle and sort carry messages between blocks of ``BLOCK`` consecutive nodes, and
a heap carries them inside a block, three levels at a time. The reversed sweep
sends each block the proof suffix of its top node, and the block hands it down to
its leaves. No task holds more than a block and no tree passes through the driver.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import fresh, stored
from panelcast.session import ship_package

#: Children of a node.
FAN = 16
#: Levels hashed inside one block, and the nodes of a block.
LEVELS = 3
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64


def digest(parts) -> str:
    """Lowercase hex sha256 of the parts written one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*columns):
    """Column: sha256 of each value as `-` (null) or `<UTF-8 bytes>:<value>`."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
             for c in (col.cast("string") for col in columns)]
    return F.sha2(F.concat(*parts), 256)


# ------------------------------------------------------------------ positions

def positions(rows: DataFrame, group: str, order: list, name: str = "pos") -> DataFrame:
    """``rows`` with the position (from 0) of each row in its group by ``order``, stored.

    The rows are dealt by ranges of (group, order), so a large group spans many
    partitions; a partition numbers its own rows and the rows before it are added
    from the counts of the partitions, of which only the first group of each
    partition can have any. Nulls sort first. Rows that tie in full are told apart
    by their place in the input.
    """
    tie = fresh(rows, "tie")
    keys = [F.col(group).asc_nulls_first(), *order, F.col(tie).asc()]
    cols = rows.columns
    ranged = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = T.StructType([*rows.schema.fields, T.StructField("part", T.LongType()), T.StructField("here", T.LongType())])
    at = cols.index(group)
    ship_package(rows.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        part, last, seen = TaskContext.get().partitionId(), (), 0
        for b in batches:
            here = []
            for v in b.column(at).to_pylist():
                seen = seen + 1 if last == (v,) else 0
                last = (v,)
                here.append(seen)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(cols)], pa.array([part] * len(here), pa.int64()), pa.array(here, pa.int64())],
                names=[*cols, "part", "here"])

    numbered = stored(ranged.select(*cols).mapInArrow(run, out), "merkle-rows")
    counts = numbered.groupBy("part", group).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # at most one group of a partition goes on from earlier ones: as many rows as partitions
    offsets = (counts.withColumn("before", before).filter("before > 0")
               .select("part", F.col(group).alias("its"), "before"))
    return (numbered.join(F.broadcast(offsets), (numbered["part"] == offsets["part"]) & numbered[group].eqNullSafe(offsets["its"]), "left")
            .select(*[numbered[c] for c in cols], (numbered["here"] + F.coalesce("before", F.lit(0))).alias(name)))


# ------------------------------------------------------------------ sweeps inside a block

def forward(level: list[str], levels: int | None) -> list[list[str]]:
    """Levels of digests above ``level``, first one included, by time-forward processing.

    Messages (level, position of the child, digest) leave the queue in label order;
    the children of one node are next to each other. ``levels`` None: up to one node.
    """
    queue = [(0, i, d) for i, d in enumerate(level)]
    heapify(queue)
    rows: list[list[str]] = [[] for _ in range((levels or 64) + 1)]
    sizes = [len(level)]
    while queue:
        height, position, own = heappop(queue)
        rows[height].append(own)
        if levels is None and sizes[height] == 1 or height == levels:
            continue
        if len(sizes) == height + 1:
            sizes.append(-(-sizes[height] // FAN))
        group = [own]
        while queue and queue[0][0] == height and queue[0][1] // FAN == position // FAN:
            group.append(heappop(queue)[2])
            rows[height].append(group[-1])
        heappush(queue, (height + 1, position // FAN, digest(group)))
    return [r for r in rows if r]


def suffix_of(siblings: list[str], place: int) -> bytes:
    """One step of a proof: the node's place in its run, the number of siblings, their digests."""
    return bytes([place, len(siblings)]) + "".join(siblings).encode()


def steps(proof: bytes):
    at = 0
    while at < len(proof):
        place, n = proof[at], proof[at + 1]
        yield place, proof[at + 2:at + 2 + n * HEX]
        at += 2 + n * HEX


def fold(node: str, proof: bytes) -> str:
    """The root that ``node`` leads to with the siblings of ``proof``."""
    for place, hexes in steps(proof):
        node = hashlib.sha256(hexes[:place * HEX] + node.encode() + hexes[place * HEX:]).hexdigest()
    return node


def proof_digest(proof: bytes) -> str:
    return hashlib.sha256(b"".join(h for _, h in steps(proof))).hexdigest()


def backward(rows: list[list[str]], top: bytes) -> list[bytes]:
    """Reversed sweep: proof suffixes of the lowest level, from the suffix of the top node."""
    suffixes = [top]
    for level in reversed(rows[:-1]):
        down = []
        for i in range(len(level)):
            run = level[i // FAN * FAN:i // FAN * FAN + FAN]
            place = i % FAN
            down.append(suffix_of(run[:place] + run[place + 1:], place) + suffixes[i // FAN])
        suffixes = down
    return suffixes


def _levels(first: bool, nodes: int) -> int | None:
    """A full block, and any but the first, climbs three levels; a first block that is
    not full is its whole tree and climbs until one node is left."""
    return None if first and nodes < BLOCK else LEVELS


# ------------------------------------------------------------------ sweeps between blocks

def climb(nodes: DataFrame) -> list[DataFrame]:
    """(tree, pos, digest, ...) -> stored tables of nodes, each one the block tops of the
    one before; the last has one node in each tree."""
    tables = [nodes]
    while tables[-1].filter("pos > 0").limit(1).count():
        tables.append(stored(_tops(tables[-1]), "merkle-level"))
    return tables


def _block():
    return F.floor(F.col("pos") / BLOCK).cast("long").alias("block")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions(F.col("tree").asc_nulls_first(), "block", "pos")


def _groups(batches):
    """(tree, block) and its rows, one block after the other; rows come sorted and
    begin with tree and block."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:2] != key and rows:
                yield key, rows
                rows = []
            key = row[:2]
            rows.append(row)
    if rows:
        yield key, rows


def _tops(nodes: DataFrame) -> DataFrame:
    ship_package(nodes.sparkSession)
    out = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string())])

    def run(batches):
        for (tree, block), rows in _groups(batches):
            top = forward([r[3] for r in rows], _levels(block == 0, len(rows)))[-1]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.string()), pa.array([block]), pa.array(top)], schema=out)

    return _dealt(nodes.select("tree", _block(), "pos", "digest")).mapInArrow(run, "tree string, pos long, digest string")


def descend(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Messages (tree, pos, suffix, subroot, root) for the blocks of the lowest table.

    ``tops`` holds them for each tree's last node: the proof suffix from there on and
    the two digests that leaves are told.
    """
    found = tops.select("tree", F.lit(0).cast("long").alias("pos"), "suffix", "subroot", "root")
    for nodes in reversed(tables[1:-1]):
        found = stored(_down(nodes, found), "merkle-suffix")
    return found


def _with_messages(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes by block, each block headed by the message of its top."""
    extra = [c for c in nodes.columns if c not in ("tree", "pos", "digest")]
    own = nodes.select("tree", _block(), "pos", "digest", F.lit(None).cast("binary").alias("suffix"),
                       F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"), *extra)
    sent = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"),
                        "suffix", "subroot", "root", *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra])
    return _dealt(own.union(sent))


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The messages for the nodes of a table, from those for the tops of its blocks."""
    ship_package(nodes.sparkSession)
    out = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("suffix", pa.binary()), ("subroot", pa.string()), ("root", pa.string())])

    def run(batches):
        for (tree, block), rows in _groups(batches):
            (*_, top, subroot, root), mine = rows[0], rows[1:]
            found = backward(forward([r[3] for r in mine], _levels(block == 0, len(mine))), top)
            for a in range(0, len(mine), 512):
                n = len(mine[a:a + 512])
                yield pa.RecordBatch.from_arrays([
                    pa.array([tree] * n, pa.string()), pa.array([r[2] for r in mine[a:a + 512]]), pa.array(found[a:a + 512], pa.binary()),
                    pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string())], schema=out)

    return (_with_messages(nodes.select("tree", "pos", "digest"), above)
            .mapInArrow(run, "tree string, pos long, suffix binary, subroot string, root string"))


class Folder:
    """Roots that nodes of one block lead to; what several leaves share is hashed once."""

    def __init__(self, levels: list[list[str]], top: bytes):
        self.levels, self.top, self.known = levels, top, {}

    def root(self, node: str, position: int, height: int = 0) -> str:
        key = (height, position, node)
        if key not in self.known:
            if height == len(self.levels) - 1:
                self.known[key] = fold(node, self.top)
            else:
                first = position // FAN * FAN
                run = self.levels[height][first:first + FAN]
                run[position - first] = node
                self.known[key] = self.root(digest(run), position // FAN, height + 1)
        return self.known[key]


def _leaves(nodes: DataFrame, above: DataFrame) -> DataFrame:
    ship_package(nodes.sparkSession)
    spec = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, proof binary"
    out = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                     ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("proof", pa.binary())])

    def run(batches):
        for (_, block), rows in _groups(batches):
            (_, _, _, _, top, subroot, root, *_), mine = rows[0], rows[1:]
            levels = forward([r[3] for r in mine], _levels(block == 0, len(mine)))
            folder, found = Folder(levels, top), backward(levels, top)
            for a in range(0, len(mine), 512):
                part, proofs = mine[a:a + 512], found[a:a + 512]
                folded = [folder.root(r[8] or r[3], a + i) for i, r in enumerate(part)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[7] for r in part], pa.int64()), pa.array([r[3] for r in part]),
                    pa.array([subroot] * len(part)), pa.array([root] * len(part)),
                    pa.array([proof_digest(p) for p in proofs]), pa.array(folded), pa.array(proofs, pa.binary())], schema=out)

    return _with_messages(nodes.select("tree", "pos", "digest", "doc_id", "tampered"), above).mapInArrow(run, spec)


# ------------------------------------------------------------------ the manifest

def build(leaves: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, tampered) -> one row per leaf with subroot, root, proof and
    the root folded from the tampered digest, or from the leaf's own where that is null."""
    none = F.lit(None).cast("string")
    placed = positions(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()])
    tables = climb(placed)
    subroots = tables[-1].select(F.lit("root").alias("tree"), F.col("tree").alias("its"), "digest")
    ranked = positions(subroots, "tree", [F.col("its").asc_nulls_first()])
    upper = climb(ranked)
    top = upper[-1].first()
    root = top["digest"] if top else None
    start = leaves.sparkSession.range(1).select(F.lit("root").alias("tree"), F.lit(b"").alias("suffix"), none.alias("subroot"), F.lit(root).cast("string").alias("root"))
    told = stored(_down(ranked, descend(upper, start)), "merkle-suffix")
    own = ranked.select("pos", "its", F.col("digest").alias("own"))
    tops = (told.join(own, "pos").select(F.col("its").alias("tree"), "suffix", F.col("own").alias("subroot"), "root"))
    return _leaves(placed, descend(tables, tops))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified, and the proof itself (per level: place in the run, number of siblings, their
    digests in hex).

    Nulls: a null field is hashed as `-` and differs from an empty one; documents of the
    null source are a tree of their own, first in order; a null doc_id comes first in its
    source and is never tampered with. Repeated rows and ids keep a leaf each, ordered by
    leaf digest. Texts are hashed whole. An empty table gives no rows. Other columns are
    ignored.
    """
    text, lower = F.col("text").cast("string"), "abcdefghijklmnopqrstuvwxyz"
    fields = [F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                         leaf_digest(*fields).alias("digest"),
                         F.when(chosen, leaf_digest(*fields[:-1], F.translate(text, lower.upper(), lower))).alias("tampered"))
    return build(leaves).withColumn("verified", F.col("folded_root") == F.col("root")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof")
