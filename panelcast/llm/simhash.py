"""SimHash near-duplicates with pigeonring candidate search.

Two 64-bit fingerprints are linked when at most ``BUDGET`` bits differ. The bits
form a ring of ``SEGMENTS`` segments. If the differences of all segments sum to
at most the budget, some chain of consecutive segments exists in which every
prefix of length l has at most ``l * budget / segments`` differences (the
pigeonring principle). With 8 segments and 3 bits the prefix budgets are
0, 0, 1, 1, 1, 2, 2, 3: the first two segments agree, and of the next three at
least two agree. The join key is therefore four equal segments (32 bits), 24
keys for a fingerprint. Candidates under a key must keep the whole chain before
their Hamming distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LONG, fresh, map_rows, schema, stored, whole_text
from panelcast.llm.components import components
from panelcast.session import ship_package

SHINGLE, BUDGET, SEED = 3, 3, 42
SEGMENTS, WIDTH = 8, 8
#: Groups up to this size are compared pair by pair; larger ones are split first.
SMALL, DIRECT = 16, 1024

_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Unsigned SimHash of UTF-8 text; 0 without words."""
    import xxhash

    words = text.translate(_FOLD).split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - k + 1)
    if len(words) <= k:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        spans = zip((ends - size)[:n].tolist(), ends[k - 1:].tolist())
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, [line[a:b] for a, b in spans], repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp): one row per document, fp as signed long."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(whole_text(), "UTF-8").alias("text"))

    def make():
        def step(batch):
            out = []
            for i, text in zip(batch["doc_id"], batch["text"]):
                fp = fingerprint(text, k)
                out.append((i, fp - (1 << 64) if fp >> 63 else fp))
            return out
        return step

    return map_rows(src, schema(doc_id=LONG, fp=LONG), make)


def _prefix_budgets(budget: int, segments: int = SEGMENTS) -> list[int]:
    return [length * budget // segments for length in range(1, segments + 1)]


def _key_masks() -> list[tuple[int, int]]:
    """(chain start, mask of four whole segments) for each of the 24 keys."""
    seg = [((1 << WIDTH) - 1) << (WIDTH * j) for j in range(SEGMENTS)]
    out = []
    for i in range(SEGMENTS):
        for pair in combinations(((i + 2) % SEGMENTS, (i + 3) % SEGMENTS, (i + 4) % SEGMENTS), 2):
            out.append((i, seg[i] | seg[(i + 1) % SEGMENTS] | seg[pair[0]] | seg[pair[1]]))
    return out


def _chain_kept(x: np.ndarray, start: np.ndarray, budget: int) -> np.ndarray:
    """Does the chain that begins at segment ``start`` keep every prefix budget?
    ``x`` holds differing bits. The last prefix is the whole Hamming distance."""
    turn = (start * WIDTH).astype(np.uint64)
    back = (np.uint64(64) - turn) % np.uint64(64)
    ring = np.where(turn == 0, x, (x >> turn) | (x << back))
    ok = np.ones(len(x), bool)
    for length, most in enumerate(_prefix_budgets(budget), 1):
        low = np.uint64((1 << (WIDTH * length)) - 1)
        ok[ok] = np.bitwise_count(ring[ok] & low) <= most
    return ok


def _spread(f: np.ndarray, budget: int) -> Iterator[np.ndarray]:
    """Edges (rows of two values) that connect what is linked within one large group,
    a spanning set rather than all pairs. Values must be distinct.

    Groups over ``DIRECT`` are dealt by the varying bits in ``budget + 1`` parts: a
    linked pair agrees in one part at least, so it meets again in a smaller group.
    """
    if len(f) < 2:
        return
    if len(f) <= DIRECT:
        near = np.bitwise_count(f[:, None] ^ f[None, :]) <= budget
        label = np.arange(len(f))
        while True:
            least = np.where(near, label[None, :], len(f)).min(1)
            least = least[least]
            if (least == label).all():
                break
            label = least
        far = label != np.arange(len(f))
        if far.any():
            yield np.stack([f[far], f[label[far]]], 1)
        return
    varies = int(np.bitwise_or.reduce(f ^ f[0]))
    bits = [b for b in range(64) if varies >> b & 1]
    for part in range(budget + 1):
        mask = np.uint64(sum(1 << b for b in bits[part::budget + 1]))
        key = f & mask
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for run in np.split(f[order], cuts):
            yield from _spread(run, budget)


def links(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Distinct ``fp`` -> edges (u, v) that connect all fingerprints within ``budget``
    bits. Under a key every linked pair of a small group is returned, of a large
    group a spanning set (its ends are connected, though not always next to each other),
    so a group of copies never becomes all of its pairs.
    """
    if not 0 <= budget <= BUDGET:
        raise ValueError(f"the key plan covers 0 to {BUDGET} bits")
    masks = _key_masks()
    signed = [m - (1 << 64) if m >> 63 else m for _, m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(signed)])
    rows = (fps.select("fp", F.explode(keys).alias("s")).select("s.k", "s.key", "fp")
            .repartition(F.col("k"), F.col("key")).sortWithinPartitions("k", "key", "fp"))
    ship_package(fps.sparkSession)
    starts = np.array([i for i, _ in masks], np.int64)
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def edges_of(k, key, f):
        """Edges of whole groups; the arrays are sorted by (k, key)."""
        new = np.r_[True, (k[1:] != k[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        small = size[group] <= SMALL
        ks, fs, gs = k[small], f[small], group[small]
        for lag in range(1, SMALL):
            at = np.flatnonzero(gs[lag:] == gs[:-lag]) if len(gs) > lag else np.empty(0, int)
            if not len(at):
                break
            x = fs[at] ^ fs[at + lag]
            ok = _chain_kept(x, starts[ks[at]], budget)
            yield np.stack([fs[at][ok], fs[at + lag][ok]], 1)
        for g in np.flatnonzero(size > SMALL):
            first = np.searchsorted(group, g)
            yield from _spread(f[first:first + size[g]], budget)

    def run(batches):
        rest = None
        def emit(k, key, f):
            found = list(edges_of(k, key, f))
            e = np.concatenate(found).view(np.int64) if found else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], schema=out)
        for b in batches:
            cols = [np.asarray(c) for c in b.columns]
            cols = [cols[0].astype(np.int64), cols[1], cols[2].view(np.uint64)]
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols)]
            k, key, f = cols
            last = np.flatnonzero((k != k[-1]) | (key != key[-1])) if len(k) else np.empty(0, int)
            cut = last[-1] + 1 if len(last) else 0     # the last group may go on in the next batch
            if cut:
                yield emit(k[:cut], key[:cut], f[:cut])
            rest = [c[cut:] for c in cols]
        if rest is not None and len(rest[0]):
            yield emit(*rest)

    return rows.mapInArrow(run, schema(u=LONG, v=LONG))


def simhash_groups(docs: DataFrame, k: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id.

    Documents with equal fingerprints, or linked through a chain of fingerprints
    at ``budget`` or fewer differing bits, share the smallest doc_id among them.
    Null, empty and wordless texts have fingerprint 0 and are linked like any
    other. Repeated rows each keep a row. Null doc_ids are left out of the
    minimum; a component without any id has a null component_id. Other columns
    are ignored. An empty table gives no rows.
    """
    marked = stored(fingerprints(docs, k), "simhash-docs")
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    root = components(links(fps.select("fp"), budget))
    root = root.select(F.col("node").alias("fp"), "root").join(fps, "fp")
    whole = root.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = root.select("fp", "root").join(whole, "root").select("fp", "component_id")
    ids = (fps.join(linked, "fp", "left")
           .select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return marked.join(stored(ids, "simhash-ids"), "fp", "left").select("doc_id", "fp", "component_id")


def _marked(docs: DataFrame, k: int) -> DataFrame:
    """(fp, doc_id, h, n): distinct rows by doc_id and text, with a hash of the text, and how often each occurs."""
    text = whole_text()
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("text"), F.xxhash64(text).alias("h"))

    def make():
        def step(batch):
            fps = ((i, fingerprint(text, k), h) for i, text, h in zip(*batch.values()))
            return [(i, fp - (1 << 64) if fp >> 63 else fp, h) for i, fp, h in fps]
        return step

    return map_rows(src, schema(doc_id=LONG, fp=LONG, h=LONG), make).groupBy("fp", "doc_id", "h").agg(F.count("*").alias("n"))


def one_of_each(docs: DataFrame, k: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """Documents with one row of each component, all columns as they are: the row with the
    smallest doc_id (a missing one comes last), of equal ids that with the smallest hash
    of its text.

    Rows are told apart by doc_id and text, so unrelated texts under one doc_id each stay;
    of rows that repeat both, one stays. Null and empty texts are one component. An empty
    table gives no rows.
    """
    name = fresh(docs, "row_key")
    marked = stored(_marked(docs, k), "simhash-docs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n")).alias("first")
    fps = stored(marked.groupBy("fp").agg(first), "simhash-fps")
    root = components(links(fps.select("fp"), budget)).select(F.col("node").alias("fp"), "root")
    least = fps.join(root, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    keep = stored(least.select(F.to_json(F.struct(F.col("first.doc_id").alias("i"), F.col("first.h").alias("h"))).alias(name), "first.n"), "simhash-keep")
    tagged = docs.withColumn(name, F.to_json(F.struct(F.col("doc_id").cast("long").alias("i"), F.xxhash64(whole_text()).alias("h"))))
    kept = tagged.join(keep.select(name), name, "left_semi")
    again = keep.filter("n > 1").select(name)
    if again.limit(1).count():
        kept = (kept.join(again, name, "left_anti")
                .union(kept.join(again, name, "left_semi").dropDuplicates([name])))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
