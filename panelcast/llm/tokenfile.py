"""Token-id shard files with a minimal perfect hash index.

A shard is a header and the raw ids of its documents, in ascending doc_id order:

    8 bytes  magic, 4 bytes  bytes of an id (2 or 4), 4 bytes  zero, ids ...

Shards follow each other in doc_id order. The index is dealt over parts by a
hash of the key; a part file holds a perfect hash and, by slot, the shard, the
byte offset, the number of ids and the ids before the document in all shards.
A lookup reads one slot and one byte range. Shard and part files are written by
tasks; the manifest tables that Spark commits name the files that count.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import LONG, STRING, arrow_schema, open_uri, resident, schema, slices, stored, task_file, whole_text
from panelcast.llm.mphf import PerfectHash, mix
from panelcast.session import scratch_path, ship_package

MAGIC, HEAD = b"PCIDS001", 16
#: Keys of one index part, at most about this many on average.
PART_KEYS = 1_000_000
#: Entries of a worker's caches of encoded words; a full cache is emptied.
MAX_WORDS = 400_000
MAX_TOKENIZER_BYTES = 64 << 20


class WordCache:
    """Whole texts to ids by the tokenizers library, keeping what it gave for each word.

    Splitting at blanks and line feeds is exact when the tokenizer drops white
    space and no pre-token crosses it: normaliser, splitter and merges then see the
    same pieces. ``safe`` says whether the loaded tokenizer is of that kind; other
    tokenizers get whole texts.
    """

    def __init__(self, spec: str, dtype: str):
        import json

        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.kind = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]
        parts = json.loads(spec)
        # the library cuts these out of a text before anything else: such texts go to it whole
        self.added = [t["content"] for t in parts.get("added_tokens") or [] if t["content"]]
        plain = not any(t.get("normalized") for t in parts.get("added_tokens") or [])
        pre = (parts.get("pre_tokenizer") or {})
        first = (pre.get("pretokenizers") or [pre])[0]
        self.safe = (plain and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
                     and not parts.get("truncation") and not parts.get("padding"))
        lowers = any(n.get("type") == "Lowercase" for n in (parts.get("normalizer") or {}).get("normalizers", []))
        # a Latin word is one pre-token of the splitter; lower-cased it goes straight to the merges
        self.direct = self.safe and lowers and r"[\p{L}]+" in (first.get("pattern") or {}).get("Regex", "") and parts["model"]["type"] == "BPE"
        self._bytes = self._byte_letters()
        self._words: dict[str, bytes] = {}
        self._stems: dict[str, bytes] = {}

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest
        for code points from 256 on, in order."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _ids(self, text: str) -> bytes:
        return array(self.kind, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, word: str) -> bytes:
        ids = self._stems.get(word)
        if ids is None:
            letters = word if word.isascii() else "".join(map(self._bytes.__getitem__, word.encode()))
            ids = array(self.kind, [t.id for t in self.tok.model.tokenize(letters)]).tobytes()
            if len(self._stems) >= MAX_WORDS:
                self._stems.clear()
            self._stems[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        ids = None
        if self.direct and word:
            stem, end = (word[:-1], word[-1]) if word[-1] in ".,;:!?" else (word, "")
            # letters below U+0250 are composed already and lower-case one by one
            if stem.isalpha() and max(stem) < "ɐ" and "İ" not in stem:
                ids = self._stem(stem.lower()) + (self._ids_of_mark(end) if end else b"")
        if ids is None:
            ids = self._ids(word) if word else b""
        if len(word) <= 64:
            if len(self._words) >= MAX_WORDS:
                self._words.clear()
            self._words[word] = ids
        return ids

    def _ids_of_mark(self, mark: str) -> bytes:
        ids = self._stems.get(mark)
        if ids is None:
            ids = self._stems[mark] = self._ids(mark)
        return ids

    def encode(self, text: str) -> bytes:
        if not self.safe or any(t in text for t in self.added):
            return self._ids(text)
        words = text.replace("\n", " ").split(" ")
        known = list(map(self._words.get, words))
        if None in known:
            known = [self._word(w) if k is None else k for w, k in zip(words, known)]
        return b"".join(known)


def _cache(spec: str, dtype: str) -> WordCache:
    return resident(("tokenizer", zlib.crc32(spec.encode()), len(spec), dtype), lambda: WordCache(spec, dtype))


def _key_hash(doc_id: np.ndarray, missing: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit keys of (doc_id or null, number of the copy)."""
    return mix(mix(doc_id.astype(np.int64).view(np.uint64), 7) ^ mix(copy.astype(np.int64).view(np.uint64), 11)
               ^ mix(missing.astype(np.uint64), 13), 17)


def write_shards(docs: DataFrame, tokenizer: str, base: str, end_id: int, shards: int) -> DataFrame:
    """Encode whole texts and write shard files under ``base``; the manifest (lazy):
    shard, file, doc_id, copy (0, 1, ... of rows with one doc_id), offset, n_tokens."""
    import os
    if os.path.getsize(tokenizer) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer}: more than {MAX_TOKENIZER_BYTES} bytes")
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    ship_package(docs.sparkSession)
    out = schema(shard=LONG, file=STRING, doc_id=LONG, copy=LONG, offset=LONG, n_tokens=LONG)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    src = src.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        from pyspark import TaskContext
        encode = _cache(shared.value, f"<u{width}").encode
        end = int(end_id).to_bytes(width, "little")
        arrow, shard = arrow_schema(out), TaskContext.get().partitionId()
        name = task_file(base, ".ids")
        fs, path = open_uri(name)
        f, at, last, copy = None, HEAD, (), 0
        for batch in batches:
            for piece in slices(batch):
                rows = []
                if f is None:
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    f = fs.open_output_stream(path, compression=None)
                    f.write(MAGIC + struct.pack("<II", width, 0))
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    data = encode(text) + end
                    copy = copy + 1 if last == (doc_id,) else 0
                    last = (doc_id,)
                    f.write(data)
                    rows.append((shard, name, doc_id, copy, at, len(data) // width))
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
        if f is not None:
            f.close()

    return src.mapInArrow(run, out)


def write_index(manifest: DataFrame, base: str, parts: int) -> DataFrame:
    """One perfect hash file for each part; (part, file), lazy. ``manifest`` also has ``start``."""
    out = schema(part=LONG, file=STRING)

    def run(key, table):
        c = {n: table.column(n) for n in table.column_names}
        ids = c["doc_id"].combine_chunks()
        keys = _key_hash(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(c["copy"]))
        found = PerfectHash.build(keys)
        slot = found.slot(keys)
        order = np.empty(len(keys), np.int64)
        order[slot] = np.arange(len(keys))
        name = task_file(base, ".mph")
        fs, path = open_uri(name)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        files = sorted(set(c["file"].to_pylist()))
        number = {x: i for i, x in enumerate(files)}
        which = np.array([number[x] for x in c["file"].to_pylist()], np.uint32)
        names = "\n".join(files).encode()
        with fs.open_output_stream(path, compression=None) as f:
            f.write(found.to_bytes())
            f.write(struct.pack("<Q", len(names)) + names)
            f.write(which[order].astype("<u4").tobytes())
            for n in ("offset", "n_tokens", "start"):
                f.write(np.asarray(c[n])[order].astype("<u8").tobytes())
        return pa.table([[key[0].as_py()], [name]], schema=arrow_schema(out))

    keyed = manifest.withColumn("part", _part(parts))
    return keyed.groupBy("part").applyInArrow(run, out)


def _part(parts: int):
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("long")), "copy"), F.lit(parts)).cast("long")


class IndexPart:
    def __init__(self, file: str):
        fs, path = open_uri(file)
        with fs.open_input_stream(path, compression=None) as f:
            data = f.read()
        self.hash, at = PerfectHash.from_bytes(data)
        n, (size,) = len(self.hash.prints), struct.unpack_from("<Q", data, at)
        self.files = data[at + 8:at + 8 + size].decode().split("\n")
        at += 8 + size
        self.which = np.frombuffer(data, "<u4", n, at)
        self.offset, self.n_tokens, self.start = (np.frombuffer(data, "<u8", n, at + 4 * n + 8 * n * i) for i in range(3))


def locate(keys: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """(doc_id, copy) -> the same with file, offset, n_tokens, start, by the index alone.
    Keys that aren't in the index give no row."""
    out = schema(doc_id=LONG, copy=LONG, file=STRING, offset=LONG, n_tokens=LONG, start=LONG)
    asked = keys.select(F.col("doc_id").cast("long"), F.col("copy").cast("long"), _part(parts).alias("part"))

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return arrow_schema(out).empty_table()
        part = IndexPart(right.column("file")[0].as_py())
        ids, copy = left.column("doc_id").combine_chunks(), np.asarray(left.column("copy"))
        slot = part.hash.find(_key_hash(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), copy))
        ok = slot >= 0
        at = slot[ok]
        cols = [ids.filter(pa.array(ok)), pa.array(copy[ok]), pa.array([part.files[i] for i in part.which[at]], pa.string())]
        cols += [pa.array(x[at].astype(np.int64)) for x in (part.offset, part.n_tokens, part.start)]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else c.combine_chunks() for c in cols],
                                    schema=arrow_schema(out))

    return asked.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(run, out)


def fetch(places: DataFrame) -> DataFrame:
    """Rows of ``locate`` -> doc_id, copy, start, n_tokens, ids_crc32 of the ids as
    unsigned 32-bit little-endian, read by byte range from the shards."""
    out = schema(doc_id=LONG, copy=LONG, start=LONG, n_tokens=LONG, ids_crc32=LONG)
    src = places.repartition("file").sortWithinPartitions("file", "offset")

    def run(batches):
        arrow, name, f, width = arrow_schema(out), None, None, 4
        for batch in batches:
            rows = []
            for doc_id, copy, file, offset, n, start in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if f is not None:
                        f.close()
                    fs, path = open_uri(file)
                    f, name = fs.open_input_file(path), file
                    magic, width = struct.unpack("<8sI4x", f.read_at(HEAD, 0))
                    if magic != MAGIC:
                        raise ValueError(f"{file}: not a shard")
                crc = 0
                for at in range(0, n * width, 4 << 20):
                    ids = np.frombuffer(f.read_at(min(4 << 20, n * width - at), offset + at), f"<u{width}")
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                rows.append((doc_id, copy, start, n, crc))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
        if f is not None:
            f.close()

    return src.mapInArrow(run, out)


def token_files(docs: DataFrame, tokenizer: str, base: str | None = None, end_id: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """Write shards and index; (manifest, index, parts).

    Every whole text is encoded by the library without special tokens, and ``end_id``
    is appended. Null and empty texts are ``end_id`` alone. Rows go in ascending
    doc_id order, null first, and rows with one doc_id by their text; they are keys
    (doc_id, 0), (doc_id, 1), ... An empty table writes no file. Other columns are
    ignored. One doc_id's rows stay in one shard, written as a stream.
    """
    spark = docs.sparkSession
    base = base or scratch_path(spark, "token-files")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    manifest = stored(write_shards(docs, tokenizer, base, end_id, shards), "token-manifest")
    totals = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs"))
    ahead = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(ahead, F.lit(0)).alias("base"))      # a row for each shard
    within = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("offset")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("within", F.coalesce(within, F.lit(0))).join(bases, "shard").select(
        "file", "doc_id", "copy", "offset", "n_tokens", (F.col("base") + F.col("within")).alias("start"))
    parts = max(shards, -(-manifest.count() // PART_KEYS))
    index = stored(write_index(placed, base, parts), "token-index")
    return manifest, index, parts


def read_all(docs: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Look up every document of ``docs`` (doc_id) by its key and read its ids."""
    copies = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    keys = copies.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    return fetch(locate(keys, index, parts))
