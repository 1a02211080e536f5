"""Removal of byte strings that were already seen, by suffix sorting.

Every start of a ``length``-byte string belongs to the smallest k-gram hash inside
that string, so equal strings meet under the same hash. Starts whose hash occurs
once in the corpus cannot repeat; the others travel with their bytes to the bucket
of the hash. A bucket sorts its suffixes in two stages: those smaller than their
successor are sorted directly, the others are induced from them by scanning the
bucket character by character. Neighbours with a common prefix of ``length`` bytes
or more hold the same string, of which all but the earliest start repeat.

The corpus is stored once; what is found out about its documents comes back to the
tasks that read them in files by block (a partition of the stored corpus), so texts
are never shuffled as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import open_uri, slices
from panelcast.session import scratch_path, ship_package

LENGTH = 100
#: A hash with more starts than this is dealt by the strings themselves instead.
HOT = 4096
#: Starts of one text looked at together; bytes of segments sorted together; keys held by a task.
CHUNK, SORT_BYTES, HELD = 1 << 20, 1 << 20, 1 << 20
BLOCK_BITS = 33      # monotonically_increasing_id: partition above, row below

_ODD, _MIX = 0xD6E8FEB86659FD93, np.uint64(0x7FB5D329728EA185)


# ------------------------------------------------------------------ hashes of windows

def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit polynomial hash of each k bytes in a row, built by doubling."""
    power = [np.uint64(pow(_ODD, m, 1 << 64)) for m in (1 << i for i in range(k.bit_length()))]
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    out, done, size, i = None, 0, 1, 0
    while True:
        if k & size:
            if out is None:
                out = h
            else:
                n = len(h) - done
                out = out[:n] * power[i] + h[done:done + n]
            done += size
        if size * 2 > k:
            break
        n = len(h) - size
        h = h[:n] * power[i] + h[size:size + n]
        size, i = size * 2, i + 1
    out = out ^ (out >> np.uint64(31))
    out = out * _MIX
    return out ^ (out >> np.uint64(27))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v, size = np.minimum(v[:len(v) - size], v[size:]), size * 2
    if size < width:
        v = np.minimum(v[:len(v) - (width - size)], v[width - size:])
    return v


def runs_of(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first start, number of starts) of the runs of starts in ``b`` whose
    ``length``-byte strings have their smallest k-gram at the same place."""
    k = max(1, length * 8 // 25)
    h = gram_hashes(b, k)
    packed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)   # ties: the leftmost
    place = (sliding_min(packed, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1]
    return h[place[first]].view(np.int64), first, np.diff(np.r_[first, len(place)])


def chunks(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) pieces that together hold every start of ``text`` once."""
    b = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(b) - length + 1), CHUNK):
        yield at, b[at:at + CHUNK + length - 1]


# ------------------------------------------------------------------ two-stage suffix sorting

def suffix_order(t: np.ndarray, ends: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Places ``starts`` (a mask over ``t``) in the order of their suffixes, compared on
    ``depth`` bytes at least; a suffix stops at the end of its segment. Which of two
    suffixes equal that far comes first is open.

    Suffixes smaller than their successor are sorted directly. The others follow from
    the order of their successors: the characters are scanned upwards, and each suffix
    met hands its predecessor to the bucket of the predecessor's first character.
    """
    n = len(t)
    begins = np.r_[0, ends[:-1]]
    step = np.zeros(n, np.int8)
    step[:-1] = (t[1:] > t[:-1]).astype(np.int8) - (t[1:] < t[:-1])
    step[ends - 1] = -1                                     # nothing is smaller than the end
    at = np.where(step != 0, np.arange(n), n)
    smaller = step[np.minimum.accumulate(at[::-1])[::-1]] > 0    # than the successor
    # the suffixes that decide the order of the starts: up to the next smaller one
    needed = starts.copy()
    nxt = np.minimum.accumulate(np.where(smaller, np.arange(n), n)[::-1])[::-1]
    count = np.add.reduceat(starts.astype(np.int64), begins)
    last = begins + count - 1                               # starts lead their segment
    stop = np.minimum(nxt[np.maximum(last, 0)], ends - 1)
    extra = np.where(count > 0, stop - last, 0)
    hit = np.flatnonzero(extra)
    if len(hit):
        size = extra[hit]
        needed[np.repeat(last[hit] + 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())] = True

    padded = np.zeros(n + depth, np.uint8)
    padded[:n] = t
    direct = np.flatnonzero(needed & smaller)
    keys = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))[direct]
    left = np.repeat(ends, ends - begins)[direct] - direct
    short = np.flatnonzero(left < depth)
    if len(short):
        part = keys[short]
        part[np.arange(depth)[None, :] >= left[short][:, None]] = 0
        keys[short] = part
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").ravel(), kind="stable")]
    del keys

    def by_first(places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        c = t[places]
        order = np.argsort(c, kind="stable")
        c = c[order]
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        for run in np.split(order, cuts):
            if len(run):
                yield int(t[places[run[0]]]), places[run]

    gives = np.zeros(n, bool)                               # its predecessor is induced from it
    gives[1:] = (needed & ~smaller)[:-1]
    gives[begins] = False
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    own: list[np.ndarray | None] = [None] * 256
    for c, places in by_first(direct):
        own[c] = places
    for c, places in by_first((ends - 1)[needed[ends - 1]]):  # before these only the end itself
        waiting[c].append(places)
    out = []

    def hand_on(places: np.ndarray) -> None:
        out.append(places)
        for c, found in by_first(places[gives[places]] - 1):
            waiting[c].append(found)

    for c in range(256):
        while waiting[c]:
            batch, waiting[c] = waiting[c], []
            hand_on(batch[0] if len(batch) == 1 else np.concatenate(batch))
        if own[c] is not None:
            hand_on(own[c])
    sa = np.concatenate(out) if out else np.empty(0, np.int64)
    return sa[starts[sa]]


def common_prefixes(t: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most``, of each place in ``order`` with the one before."""
    words = -(-most // 8)
    padded = np.zeros(len(t) + 8 * words + 8, np.uint8)
    padded[:len(t)] = t
    # the eight bytes from each place on, aligned
    word = np.ascontiguousarray(np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,)))
    out = np.zeros(len(order), np.int64)
    row, a, b = np.arange(1, len(order)), order[1:], order[:-1]
    for j in range(words):
        x = word[a] ^ word[b]
        differ = x != 0
        here = x[differ]
        out[row[differ]] = 8 * j + np.bitwise_count((here & (~here + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        row, a, b = (v[~differ] for v in (row, a, b))
        a, b = a + 8, b + 8
    out[row] = 8 * words
    return np.minimum(out, most)


def repeated_starts(t: np.ndarray, ends: np.ndarray, owner: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start in the text) of the strings that an earlier start has already.

    ``t`` holds segments one after the other; the text of segment s starts at place
    ``first[s]`` of a document of rank ``owner[s]``. All but the last ``length - 1``
    bytes of a segment are starts.
    """
    begins = np.r_[0, ends[:-1]]
    count = ends - begins - length + 1
    seg = np.repeat(np.arange(len(ends)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = np.zeros(len(t), bool)
    starts[begins[seg] + within] = True
    order = suffix_order(t, ends, starts, length)
    same = common_prefixes(t, order, length) >= length
    group = np.flatnonzero(~same)
    s = np.repeat(np.arange(len(ends)), ends - begins)[order]
    place = first[s] + order - begins[s]
    when = (owner[s].astype(np.int64) << 32) | place
    least = np.minimum.reduceat(when, group) if len(group) else when
    again = when > np.repeat(least, np.diff(np.r_[group, len(order)]))
    return s[again], place[again]


def joined(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of documents as runs (document, from, to)."""
    o = np.lexsort([place, doc])
    doc, place = doc[o], place[o]
    if not len(doc):
        return doc, place, place
    new = np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)]
    at = np.flatnonzero(new)
    return doc[at], place[at], place[np.r_[at[1:], len(doc)] - 1] + 1


# ------------------------------------------------------------------ what comes back to the texts

class BlockFiles:
    """Columns of a stored table that was written by block; one block is held at a time."""

    def __init__(self, base: str, columns: list[str], order: str):
        self.base, self.columns, self.order, self.block, self.held = base, columns, order, None, None

    def of(self, block: int) -> list[np.ndarray]:
        if block != self.block:
            import pyarrow.parquet as pq
            from pyarrow import fs as pafs
            fs, path = open_uri(f"{self.base}/block={block}")
            found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
            files = sorted(f.path for f in found if f.path.endswith(".parquet"))
            parts = [pq.ParquetFile(fs.open_input_file(f)).read(columns=self.columns) for f in files]
            cols = [np.concatenate([np.asarray(p[c]) for p in parts]) if parts else np.empty(0, np.int64) for c in self.columns]
            o = np.argsort(cols[self.columns.index(self.order)], kind="stable")
            self.held, self.block = [c[o] for c in cols], block
        return self.held


def by_block(rows: DataFrame, name: str) -> str:
    """Store ``rows`` by their column ``block``; the folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.repartition("block").write.partitionBy("block").parquet(path)
    return path


def _texts(batches):
    """(at, text) of the texts of a task."""
    for batch in batches:
        for piece in slices(batch):
            yield from zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())


def _keys_seen(corpus: DataFrame, keys_of, out_name: str, hot: int) -> tuple[str, bool]:
    """Keys that occur twice or more in all texts, stored by block: (folder, is any over ``hot``).

    ``keys_of()`` gives a function from (at, text) to an array of keys. A task merges its
    own keys before the shuffle, so the busiest key arrives once from each task.
    """
    out = pa.schema([("key", pa.int64()), ("seen", pa.int64())])
    ship_package(corpus.sparkSession)

    def run(batches):
        find = keys_of()
        held, size, block = [], 0, None

        def merged():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + (1 << 16)]), pa.array((block << 32) | n[a:a + (1 << 16)])], schema=out)

        for at, text in _texts(batches):
            if held and (at >> BLOCK_BITS != block or size > HELD):
                yield from merged()
                held, size = [], 0
            block = at >> BLOCK_BITS
            keys = find(at, text)
            if len(keys):
                held.append(keys)
                size += len(keys)
        if held:
            yield from merged()

    rows = corpus.select("at", "text").mapInArrow(run, "key long, seen long")
    total = F.sum(F.col("seen").bitwiseAND((1 << 32) - 1)).over(Window.partitionBy("key"))
    again = (rows.withColumn("n", total).filter("n > 1")
             .select(F.shiftright("seen", 32).alias("block"), "key", (F.col("n") > hot).cast("long").alias("hot")).distinct())
    folder = by_block(again, out_name)
    found = corpus.sparkSession.read.schema("block long, key long, hot long").parquet(folder)
    return folder, bool(found.filter("hot = 1").limit(1).count())


def _member(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is each key among the sorted ones, where)."""
    if not len(among):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at


def _run_keys(length: int):
    def make():
        def find(_, text):
            found = [runs_of(b, length)[0] for _, b in chunks(text, length)]
            return np.concatenate(found) if found else np.empty(0, np.int64)
        return find
    return make


def _hot_string_keys(folder: str, length: int):
    """Hashes of the whole strings at starts whose k-gram is a hot key."""
    def make():
        files = BlockFiles(folder, ["key", "hot"], "key")

        def find(at, text):
            keys, hot = files.of(at >> BLOCK_BITS)
            out = [np.empty(0, np.int64)]
            if hot.any():
                for _, b in chunks(text, length):
                    k, first, n = runs_of(b, length)
                    is_in, where = _member(k, keys)
                    chosen = is_in & (hot[where] == 1)
                    if chosen.any():
                        out.append(gram_hashes(b, length).view(np.int64)[np.repeat(chosen, n)])
            return np.concatenate(out)
        return find
    return make


SEGMENT = pa.schema([("key", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()),
                     ("start", pa.int64()), ("stop", pa.int64()), ("text", pa.binary())])


def _segments(corpus: DataFrame, keys: str, strings: str | None, length: int) -> DataFrame:
    """Runs of starts under keys that occur again, with their bytes. Under hot keys every
    start whose string occurs again is a run of its own; of equal ones a task sends the
    earliest, and rows without bytes say that the others repeat."""
    ship_package(corpus.sparkSession)

    def run(batches):
        run_files = BlockFiles(keys, ["key", "hot"], "key")
        string_files = BlockFiles(strings, ["key"], "key") if strings else None
        rows, size = [], 0
        alone: dict[bytes, tuple] = {}

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), SEGMENT.types)], schema=SEGMENT)

        told: list[tuple[int, int]] = []      # (at, start) that repeat, known without a sort

        def flush():
            doc, start, stop = joined(*(np.array(c, np.int64) for c in zip(*told))) if told else ([], [], [])
            rows.extend((int(d), int(d), None, 0, int(a), int(b), None) for d, a, b in zip(doc, start, stop))
            told.clear()

        for batch in batches:
            for piece in slices(batch):
                for at, text, doc_id, tie in zip(*(piece.column(i).to_pylist() for i in range(4))):
                    known, hot = run_files.of(at >> BLOCK_BITS)
                    for offset, b in chunks(text, length):
                        k, first, n = runs_of(b, length)
                        is_in, where = _member(k, known)
                        heavy = is_in & (hot[where] == 1) if len(hot) else is_in
                        plain = np.flatnonzero(is_in & ~heavy)
                        for key, p, m in zip(k[plain].tolist(), (first[plain] + offset).tolist(), n[plain].tolist()):
                            rows.append((key, at, doc_id, tie, p, p + m, text[p:p + m + length - 1]))
                            size += m + length
                        if heavy.any():
                            h = gram_hashes(b, length).view(np.int64)
                            again = np.repeat(heavy, n) & _member(h, string_files.of(at >> BLOCK_BITS)[0])[0]
                            for p in np.flatnonzero(again).tolist():
                                string = b[p:p + length].tobytes()
                                row = (int(h[p]), at, doc_id, tie, p + offset, p + offset + 1, string)
                                old = alone.get(string)
                                if old is None:
                                    alone[string] = row
                                elif _when(row) < _when(old):
                                    alone[string] = row
                                    told.append((old[1], old[4]))
                                else:
                                    told.append((row[1], row[4]))
                        if len(alone) * (length + 200) > 32 << 20:
                            rows.extend(alone.values())
                            alone.clear()
                        if len(told) > 100_000:
                            flush()
                        if size > 2 << 20 or len(rows) > 20000:
                            yield batch_of(rows)
                            rows, size = [], 0
        rows.extend(alone.values())
        flush()
        for a in range(0, len(rows), 20000):
            yield batch_of(rows[a:a + 20000])

    return corpus.select("at", "text", "doc_id", "tie").mapInArrow(
        run, "key long, at long, doc_id long, tie long, start long, stop long, text binary")


def _when(row) -> tuple:
    """Order of a row's start: documents by id (null last), then by text, row and place."""
    return (row[2] is None, row[2] or 0, row[3], row[1], row[4])


def _spans(segments: DataFrame, length: int) -> DataFrame:
    """(block, at, start, stop): runs of starts whose strings occur earlier."""
    ship_package(segments.sparkSession)
    out = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def result(at, start, stop):
        return pa.RecordBatch.from_arrays([pa.array(at >> BLOCK_BITS), pa.array(at), pa.array(start), pa.array(stop)], schema=out)

    def sort(table: pa.Table):
        text = table.column("text").combine_chunks()
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        t = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        at, tie, first = (np.asarray(table.column(c)) for c in ("at", "tie", "start"))
        ids = table.column("doc_id").combine_chunks()
        none, doc = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
        o = np.lexsort([at, tie, doc, none])
        new = np.r_[True, at[o][1:] != at[o][:-1]]
        owner = np.empty(len(at), np.int64)
        owner[o] = np.cumsum(new) - 1
        seg, place = repeated_starts(t, offsets[1:] - offsets[0], owner, first, length)
        return joined(at[seg], place)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch, SORT_BYTES):
                t = pa.Table.from_batches([piece])
                told = t.filter(t["text"].is_null())
                if told.num_rows:
                    yield result(*(np.asarray(told[c]) for c in ("at", "start", "stop")))
                t = t.filter(t["text"].is_valid())
                if not t.num_rows:
                    continue
                if size > SORT_BYTES:                   # go on until the key changes
                    key = held[-1]["key"][-1].as_py()
                    cut = int(np.searchsorted(np.asarray(t["key"]), key, "right"))
                    if cut:
                        held.append(t.slice(0, cut))
                    if cut < t.num_rows:
                        yield result(*sort(pa.concat_tables(held)))
                        held, size, t = [], 0, t.slice(cut)
                    else:
                        t = t.slice(0, 0)
                if t.num_rows:
                    held.append(t)
                    size += t.nbytes
        if held:
            yield result(*sort(pa.concat_tables(held)))

    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(run, "block long, at long, start long, stop long")


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes), removed_from
    and removed_to (places of the removed runs, in bytes of the text).

    A byte goes if a ``length``-byte string over it also starts earlier: in a document of
    smaller doc_id, or before in the same one; strings are judged on the texts as given.
    A null text counts as empty. Documents with a null doc_id come after all others;
    documents of equal id come in order of a hash of their text, equal rows in any order,
    so of repeated rows one keeps its text. Texts under ``length`` bytes are kept whole.
    Texts are taken whole, however long. An empty table gives no rows. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    path = scratch_path(spark, "repeats-corpus")
    (docs.select(F.monotonically_increasing_id().alias("at"), F.col("doc_id").cast("long").alias("doc_id"),
                 text.alias("text")).withColumn("tie", F.xxhash64("text"))
     .write.option("compression", "zstd").parquet(path))
    corpus = spark.read.schema("at long, doc_id long, text binary, tie long").parquet(path)
    long_enough = corpus.filter(F.octet_length("text") >= length)
    keys, any_hot = _keys_seen(long_enough, _run_keys(length), "repeats-keys", hot)
    strings = _keys_seen(long_enough, _hot_string_keys(keys, length), "repeats-strings", hot)[0] if any_hot else None
    spans = by_block(_spans(_segments(long_enough, keys, strings, length), length), "repeats-spans")
    ship_package(spark)
    places = pa.list_(pa.int64())
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept", pa.binary()), ("removed_from", places), ("removed_to", places)])

    def run(batches):
        files = BlockFiles(spans, ["at", "start", "stop"], "at")
        for batch in batches:
            for piece in slices(batch):
                rows = []
                for at, text, doc_id in zip(*(piece.column(i).to_pylist() for i in range(3))):
                    whose, start, stop = files.of(at >> BLOCK_BITS)
                    a, b = np.searchsorted(whose, [at, at + 1])
                    gone = covered(start[a:b], stop[a:b], length)
                    kept, last = [], 0
                    for x, y in gone:
                        kept.append(text[last:x])
                        last = y
                    kept.append(text[last:])
                    rows.append((doc_id, len(text), sum(y - x for x, y in gone), len(gone), b"".join(kept),
                                 [x for x, _ in gone], [y for _, y in gone]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return corpus.select("at", "text", "doc_id").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed_from array<long>, removed_to array<long>")


def covered(start: np.ndarray, stop: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the strings that start in the given runs of places."""
    if not len(start):
        return []
    o = np.argsort(start, kind="stable")
    start, end = start[o], np.maximum.accumulate(stop[o] + length - 1)
    new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return list(zip(start[new].tolist(), end[np.r_[new[1:], len(start)] - 1].tolist()))
