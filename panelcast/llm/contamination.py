"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a few consecutive words; masked-out positions are
ignored. The hashes of all seeds of the test items are joined with those of the
training texts, and around each hit the two texts are laid side by side: a leak is
a stretch of at least ``STRETCH`` aligned words of which ``MATCHES`` or more agree.
The two masks were chosen so that any stretch of 13 words with two substitutions
has a seed free of them. Items shorter than a stretch must occur as a whole, with the
same share of equal words: one substitution in 7 to 12 words, none in fewer. Items
under ``DROP_WORDS`` words are reported, but drop no document.

The test items are taken in blocks of bounded size, each broadcast and held
against all documents; nothing of the documents is shuffled, so a passage that a
third of the documents share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LONG, STRING, map_rows, resident, schema, slices, stored, whole_text
from panelcast.llm.licenses import FOLD
from panelcast.session import ship_package

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
STRETCH, MATCHES = 13, 11
#: Items with fewer words are found in too many clean texts.
DROP_WORDS = 3
#: Words of one broadcast block of test items, at most about twice this many.
BLOCK_WORDS = 1_000_000
#: Longer items are cut in pieces that overlap by a stretch.
PIECE_WORDS = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)       # odd multiplier of the seed hash (2^64 / golden ratio)


def _needed(size: int) -> int:
    """Equal words that a short item needs: the share of a stretch, rounded up."""
    return -(-size * MATCHES // STRETCH)


def _short_masks(size: int) -> list[tuple[int, ...]]:
    """Masks of an item shorter than a stretch: a substitution is in one of two at most."""
    return [tuple(range(size))] if _needed(size) == size else [tuple(range(0, size, 2)), tuple(range(1, size, 2))]


def _seed_hashes(ids: np.ndarray, mask) -> np.ndarray:
    """Hash of the mask's words at every position; ``ids`` are word numbers, 0: no test word.
    Positions where a needed word is 0 get hash 0."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = ids.astype(np.uint64)
    out, ok = np.full(n, len(mask), np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for o in mask:
            part = wide[o:o + n]
            out = (out ^ part) * _BASE
            out ^= out >> np.uint64(29)
            ok &= part != 0
    return np.where(ok, out | np.uint64(1), np.uint64(0))


class Block:
    """Test items of one block: their words by number, and their seeds sorted by hash."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.number: dict[bytes, int] = {}
        self.items, self.ids = [], [i for i, _ in rows]
        for _, line in rows:
            words = line.encode().split()
            self.items.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int32))
        short = sorted({len(x) for x in self.items if 0 < len(x) < STRETCH})
        sized = [(m, None) for m in MASKS] + [(m, n) for n in short for m in _short_masks(n)]
        self.masks = [m for m, _ in sized]
        self.seeds = [self._seeds(m, n) for m, n in sized]

    def _seeds(self, mask, size: int | None):
        """Sorted hashes, item and position of each seed, and a bit table that most
        positions of other texts fail at."""
        h, item, pos = [], [], []
        for i, ids in enumerate(self.items):
            if len(ids) >= STRETCH if size is None else len(ids) == size:
                x = _seed_hashes(ids, mask)[:None if size is None else 1]
                h.append(x)
                item.append(np.full(len(x), i))
                pos.append(np.arange(len(x)))
        if not h:
            return None
        h, item, pos = np.concatenate(h), np.concatenate(item), np.concatenate(pos)
        order = np.argsort(h, kind="stable")
        bits = max(16, min(26, int(len(h)).bit_length() + 4))
        table = np.zeros(1 << bits, bool)
        table[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
        return h[order], item[order], pos[order], table, np.uint64(64 - bits)

    def hits(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text position, item, item position) of the seeds that text and items share."""
        for mask, seeds in zip(self.masks, self.seeds):
            if seeds is None:
                continue
            h, item, pos, table, shift = seeds
            x = _seed_hashes(ids, mask)
            at = np.flatnonzero(table[(x >> shift).astype(np.int64)] & (x != 0))
            low, high = np.searchsorted(h, x[at], "left"), np.searchsorted(h, x[at], "right")
            count = high - low
            at, low, count = at[count > 0], low[count > 0], count[count > 0]
            if len(at):
                which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield np.repeat(at, count), item[which], pos[which]

    def leaks(self, ids: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """item -> (aligned words, equal words, first word in the text, in the item) of its best stretch."""
        best: dict[int, tuple[int, int, int, int]] = {}
        lines = set()
        for at, item, pos in self.hits(ids):
            lines.update(zip(item.tolist(), (at - pos).tolist()))
        for item, shift in sorted(lines):
            words = self.items[item]
            low, high = max(0, -shift), min(len(words), len(ids) - shift)
            same = words[low:high] == ids[low + shift:high + shift]
            found = self._stretch(same, len(words))
            if found is not None:
                a, b = found
                mine = (b - a, int(same[a:b].sum()), low + shift + a, low + a)
                if item not in best or (mine[1], mine[0], -mine[2]) > (best[item][1], best[item][0], -best[item][2]):
                    best[item] = mine
        return best

    @staticmethod
    def _stretch(same: np.ndarray, size: int) -> tuple[int, int] | None:
        """Longest run of windows that are close enough, or None."""
        if size < STRETCH:
            return (0, size) if len(same) == size and same.sum() >= _needed(size) else None
        if len(same) < STRETCH:
            return None
        total = np.concatenate([[0], np.cumsum(same)])
        good = total[STRETCH:] - total[:-STRETCH] >= MATCHES
        if not good.any():
            return None
        edge = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
        starts, ends = edge[::2], edge[1::2]
        longest = int(np.argmax(ends - starts))
        return int(starts[longest]), int(ends[longest]) + STRETCH - 1

    def drops(self, text: str) -> bool:
        """Whether the text has a leak of an item that isn't too short to say so."""
        return any(len(self.items[i]) >= DROP_WORDS for i in self.leaks(self.read(text)))

    def read(self, text: str) -> np.ndarray:
        words = text.encode().translate(FOLD).split()
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int32, len(words))


def _pieces(bench: DataFrame) -> DataFrame:
    """item_id, piece, n, line: folded words of each item, long items in overlapping pieces."""
    src = bench.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))

    def make():
        def step(batch):
            out = []
            for i, text in zip(batch["item_id"], batch["text"]):
                words = text.encode().translate(FOLD).split()
                for at in range(0, max(1, len(words) - STRETCH + 1), PIECE_WORDS):
                    part = words[at:at + PIECE_WORDS + STRETCH - 1]
                    if part:
                        out.append((i, at, len(part), b" ".join(part).decode()))
            return out
        return step

    return map_rows(src, schema(item_id=LONG, piece=LONG, n=LONG, line=STRING), make)


def benchmark_blocks(bench: DataFrame, words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, int, str]]]:
    """The test items in blocks of at most twice ``words`` words; the bound is checked."""
    pieces = stored(_pieces(bench), "bench-pieces")
    n = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // words))
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "piece", "line"), F.lit(n)))
        largest = dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        repeats = dealt.groupBy("line").count().agg(F.max("count")).first()[0] or 0
        if largest <= 2 * words or repeats * PIECE_WORDS > words:
            break
        n *= 2
    for block in range(n):
        rows = dealt.filter(F.col("block") == block).select("item_id", "piece", "line").orderBy("item_id", "piece").collect()
        if rows:
            yield [tuple(r) for r in rows]


def _block(shared) -> Block:
    key, rows = shared.value
    return resident(("benchmark", key), lambda: Block([(r[0], r[2]) for r in rows]))


def _shared_blocks(docs: DataFrame, bench: DataFrame):
    import uuid
    for rows in benchmark_blocks(bench):
        yield docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows))


def find_leaks(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """doc_id, item_id, overlap_words, equal_words, doc_word, item_word: one row for each
    document and item that share a leak, with the best stretch (most equal words).

    Words are runs of letters and digits, A-Z in lower case. Null, empty and wordless
    texts and items leak nothing; without items or documents there are no rows.
    Repeated rows of a doc_id or item_id give one row. Other columns are ignored.
    """
    out = schema(doc_id=LONG, item_id=LONG, overlap_words=LONG, equal_words=LONG, doc_word=LONG, item_word=LONG)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = None
    for shared in _shared_blocks(docs, bench):
        def make(shared=shared):
            block = _block(shared)
            pieces = [r[1] for r in shared.value[1]]

            def step(batch):
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    for item, (size, same, a, b) in block.leaks(block.read(text)).items():
                        rows.append((doc_id, block.ids[item], size, same, a, b + pieces[item]))
                return rows
            return step

        part = map_rows(src, out, make)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], out)
    best = F.max(F.struct("equal_words", "overlap_words", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("b.overlap_words").alias("overlap_words"), F.col("b.equal_words").alias("equal_words"),
        (-F.col("b.d")).alias("doc_word"), (-F.col("b.i")).alias("item_word"))


def keep_clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no leak with any test item of ``DROP_WORDS`` words or
    more, all columns as they are."""
    ship_package(docs.sparkSession)
    for shared in _shared_blocks(docs, bench):
        def run(batches, shared=shared):
            block = _block(shared)
            for batch in batches:
                for piece in slices(batch):
                    texts = piece.column(piece.schema.get_field_index("text"))
                    yield piece.filter(pa.array([not block.drops(t.as_py() or "") for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
