"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges are compiled into an automaton whose states are (last whole token,
bytes of the token in progress). A token may follow another only if merging the
bytes of both gives exactly those two tokens back; a text has one path of such
pairs, and it is its BPE encoding. Subsets of these states are determinised as
they are met: a transition reads one byte and emits the tokens on which all
surviving paths agree, so output lags by no more than the longest token.

Decoding is a machine over tokens whose state is the unfinished UTF-8 sequence
(three bytes at most); transitions are filled in as they are met.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import BINARY, LONG, STRING, map_rows, resident, schema, whole_text

#: White space as the pattern's engine has it (Unicode White_Space); fixed values.
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_NONSPACE = "[^" + _SPACE[1:]
#: Bounds of the caches of one worker; what a full cache lets go is made again, results don't change.
MAX_STATES, MAX_PAIRS, MAX_CHUNKS, MAX_PIECES = 300_000, 480_000, 240_000, 240_000
#: A transition is one number: the tokens emitted in its upper bits, the next state in its lower ones.
_EMIT, _STATE = 32, (1 << 32) - 1
#: Vocabulary files are read on the driver and broadcast; larger ones are refused.
MAX_VOCAB_BYTES = 64 << 20


def read_ranks(path: str) -> bytes:
    if os.path.getsize(path) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path}: more than {MAX_VOCAB_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def _own_space(pattern: str) -> str:
    r"""The split pattern with \s spelled out as the pattern's engine understands it."""
    out = pattern.replace(r"[^\s", "[^" + _SPACE[1:-1])
    return out.replace(r"\s", _SPACE).replace(r"\S", _NONSPACE)


class Transducer:
    """One piece of bytes in, token ids out.

    A path is (trie node of the token in progress, last whole token, tokens held
    back); a state is the paths that are alive, shortest progress first. States are
    numbered; their paths are kept packed as 32-bit numbers (node, token, how many
    are held back, those), and all transitions lie in one table.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self._trie: dict[int, int] = {}         # node << 8 | byte -> node
        self._ends, self._grows = [-1], [True]  # token that ends at a node; has it children
        for token, i in ranks.items():
            node = 0
            for byte in token:
                child = self._trie.get(node << 8 | byte)
                if child is None:
                    child = self._trie[node << 8 | byte] = len(self._ends)
                    self._ends.append(-1)
                    self._grows.append(False)
                    self._grows[node] = True
                node = child
            self._ends[node] = i
        self._merges: dict[int, tuple | None] = {}
        self._pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._next: dict[int, int] = {}             # state << 8 | byte -> transition
        self._paths: list[bytes] = []               # of each state
        self._numbers: dict[bytes, int] = {}        # paths -> state
        self._held: dict[int, tuple[int, ...]] = {}     # what a piece that ends in a state still gives
        self._emits: list[tuple[int, ...]] = [()]
        self._emit_numbers: dict[tuple[int, ...], int] = {(): 0}
        self._state(array("i", (0, -1, 0)).tobytes())

    release = _reset

    def _state(self, paths: bytes) -> int:
        number = self._numbers.get(paths)
        if number is None:
            number = self._numbers[paths] = len(self._paths)
            self._paths.append(paths)
        return number

    def merge(self, piece: bytes, history: list | None = None) -> list[int]:
        """Merge by rank, smallest first, leftmost of equals. ``history`` gets, for each
        merge, its rank and the first and last part after it."""
        get, none = self.ranks.get, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        joint = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while joint and (rank := min(joint)) < none:
            at = joint.index(rank)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(joint):
                joint[at] = get(parts[at] + parts[at + 1], none)
            if history is not None:
                history.append((rank, parts[0], parts[-1]))
        return [self.ranks[p] for p in parts]

    def _made_by(self, token: int) -> tuple | None:
        """The merges that make a token from its bytes; None if merging gives other tokens."""
        found = self._merges.get(token, 0)
        if found == 0:
            data, history = self.tokens[token], []
            whole = self.merge(data, history) == [token]
            found = self._merges[token] = (data[:1], data[-1:], *history) if whole else None
        return found

    def _may_follow(self, before: int, token: int) -> bool:
        """Does merging the bytes of both give both back? Their own merges run side by
        side; a merge across the boundary that comes first joins them."""
        right, none = self._made_by(token), 1 << 60
        if right is None or before < 0:
            return right is not None
        left = self._made_by(before)
        i = j = 2
        last, first, get = left[1], right[0], self.ranks.get
        while True:
            a = left[i][0] if i < len(left) else none
            b = right[j][0] if j < len(right) else none
            across = get(last + first, none)
            if across < a and across <= b and across < none:
                ok = False
                break
            if a == b == none:
                ok = True
                break
            if a <= b:
                last, i = left[i][2], i + 1
            else:
                first, j = right[j][1], j + 1
        if len(self._pairs) > MAX_PAIRS:
            self._pairs.clear()
        self._pairs[before << 32 | token] = ok
        return ok

    def _step(self, state: int, byte: int) -> int:
        """Determinise one transition."""
        paths, flat, at = [], memoryview(self._paths[state]).cast("i").tolist(), 0
        while at < len(flat):
            stop = at + 3 + flat[at + 2]
            paths.append((flat[at], flat[at + 1], tuple(flat[at + 3:stop])))
            at = stop
        alive, done = [], None
        trie, pairs = self._trie, self._pairs
        for node, before, held in reversed(paths):      # longest progress first
            child = trie.get(node << 8 | byte)
            if child is None:
                continue
            if self._grows[child]:
                alive.append((child, before, held))
            token = self._ends[child]
            if token >= 0 and done is None:     # one valid path ends here at most
                ok = pairs.get(before << 32 | token) if before >= 0 else None
                if ok or ok is None and self._may_follow(before, token):
                    done = (0, token, held + (token,))
        if done is not None:
            alive.append(done)
        agreed = alive[0][2]
        for _, _, held in alive:
            while held[:len(agreed)] != agreed:
                agreed = agreed[:-1]
            if not agreed:
                break
        packed, n = [], len(agreed)
        for node, before, held in reversed(alive):
            packed += (node, before, len(held) - n, *held[n:])
        emit = self._emit_numbers.get(agreed)
        if emit is None:
            emit = self._emit_numbers[agreed] = len(self._emits)
            self._emits.append(agreed)
        found = self._next[state << 8 | byte] = emit << _EMIT | self._state(array("i", packed).tobytes())
        return found

    def encode(self, piece: bytes) -> tuple[int, ...]:
        if len(self._paths) > MAX_STATES:
            self._reset()
        out, state, get, emits = [], 0, self._next.get, self._emits
        for byte in piece:
            found = get(state << 8 | byte)
            if found is None:
                found = self._step(state, byte)
                if len(self._paths) > 2 * MAX_STATES:       # inside one very long piece
                    out += emits[found >> _EMIT]
                    paths = self._paths[found & _STATE]
                    self._reset()
                    found, get, emits = self._state(paths), self._next.get, self._emits
            if found > _STATE:
                out += emits[found >> _EMIT]
                state = found & _STATE
            else:
                state = found
        held = self._held.get(state)
        if held is None:
            node, _, n, *rest = memoryview(self._paths[state]).cast("i").tolist()
            held = self._held[state] = tuple(rest[:n]) if node == 0 else ()
        return (*out, *held)


class Utf8Machine:
    """Token ids in, text out, in pieces: what can't be text yet waits in the state."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.start: dict = {}
        self._tables: dict[bytes, dict] = {b"": self.start}
        self._waits: dict[int, bytes] = {id(self.start): b""}
        self._whole: dict[int, str] = {}    # tokens that lead from the start back to it
        for token, data in tokens.items():
            try:
                self._whole[token] = data.decode()
            except UnicodeDecodeError:
                pass

    @staticmethod
    def open_tail(data: bytes) -> int:
        """Length of the sequence at the end that more bytes may still complete."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if 0x80 <= b < 0xC0:
                continue
            need = 1 if 0xC2 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if 0xF0 <= b < 0xF5 else 0
            if back > need:
                return 0
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(b, (0x80, 0xBF))
            return back if back == 1 or low <= data[1 - back] <= high else 0
        return 0

    def _step(self, state: dict, token: int) -> tuple[str, dict]:
        data = self._waits[id(state)] + self.tokens[token]
        keep = self.open_tail(data)
        rest = data[len(data) - keep:]
        to = self._tables.get(rest)
        if to is None:
            to = self._tables[rest] = {}
            self._waits[id(to)] = rest
        state[token] = found = (data[:len(data) - keep].decode("utf-8", "replace"), to)
        return found

    def feed(self, ids, state: dict | None = None) -> tuple[str, dict]:
        """Text that is now complete, and the state to go on from. Tokens that are whole
        UTF-8 leave the start state as it is, so runs of them are joined as they are."""
        state = self.start if state is None else state
        whole = list(map(self._whole.get, ids))
        out, at = [], 0
        while at < len(whole):
            if state is self.start:
                try:
                    stop = whole.index(None, at)
                except ValueError:
                    stop = len(whole)
                out += whole[at:stop]
                at = stop
                if at == len(whole):
                    break
            found = state.get(ids[at])
            if found is None:
                found = self._step(state, ids[at])
            text, state = found
            out.append(text)
            at += 1
        return "".join(out), state

    def finish(self, state: dict) -> str:
        return self._waits[id(state)].decode("utf-8", "replace")


class _Memo(dict):
    """Results of ``make`` by text, in two generations: when the young one holds half of
    ``most`` it becomes the old one, and what is asked for again moves back. Texts of more
    than 64 characters aren't kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        found = self.old.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= 64:
            if 2 * len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found

    def release(self) -> None:
        """Let go of the texts and of ``make``, which refers back to the owner."""
        self.clear()
        self.old, self.make = {}, None


class Codec:
    """Whole texts to ids and back; splits by the pattern, keeps what it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.ranks = ranks
        self.fst = Transducer(ranks)
        self.utf8 = Utf8Machine(self.fst.tokens)
        self.split = regex.compile(_own_space(pattern)).findall
        self.decimal = {i: str(i) for i in self.fst.tokens}
        self._piece = _Memo(self._encode_piece, MAX_PIECES).__getitem__
        self._chunk = _Memo(self._encode_chunk, MAX_CHUNKS // 4).__getitem__
        self._spaced = _Memo(self._encode_spaced, MAX_CHUNKS * 3 // 4).__getitem__
        # a space between two non-spaces always begins a new match of the pattern,
        # and a line feed between two is a match by itself
        self._cut = re.compile(r"(?<=\S) (?=\S)").split
        self._next_cut = re.compile(r"(?<=\S) (?=\S)").search

    def release(self) -> None:
        self.fst.release()
        for kept in (self._piece, self._chunk, self._spaced):
            kept.__self__.release()
        for table in self.utf8._tables.values():
            table.clear()

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.fst.encode(data)

    def _encode_chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._piece, self.split(chunk))))

    def _encode_spaced(self, word: str) -> tuple[int, ...]:
        if word.isascii() and word.isalpha():       # one match
            return self._piece(" " + word)
        return self._encode_chunk(" " + word)

    def blocks(self, text: str, size: int = 1 << 18) -> Iterator[str]:
        """The text in blocks that end where a new match must begin."""
        at = 0
        while len(text) - at > size:
            cut = self._next_cut(text, at + size)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def encode_block(self, text: str) -> list[int]:
        if " ".join(text.split()) != text.replace("\n", " "):      # other or doubled white space
            first, *words = self._cut(text)
            return [*self._chunk(first), *chain.from_iterable(map(self._spaced, words))]
        out = []
        for line in text.split("\n"):
            if out:
                out.append(self._chunk("\n"))
            first, *words = line.split(" ")
            out.append(self._chunk(first))
            out.extend(map(self._spaced, words))
        return list(chain.from_iterable(out))

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids in runs, one for each block of the text."""
        for block in self.blocks(text):
            if block:
                yield self.encode_block(block)


def codec(vocab: bytes, pattern: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    def build() -> Codec:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocab.splitlines() if line)}
        gc.set_threshold(500_000, 20, 100)      # large tables that stay: not worth walking often
        return Codec(ranks, pattern)

    return resident(("bpe", hashlib.sha256(vocab + pattern.encode()).hexdigest()), build)


def _rows(df: DataFrame, path: str, pattern: str, out, use):
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        c = codec(shared.value, pattern)
        return lambda batch: [use(c, *row) for row in zip(*batch.values())]

    return map_rows(df, out, make)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids (unsigned 32-bit little-endian).

    Every match of ``pattern`` is encoded by itself, as by the ranks in the file at
    ``path``; a match that is a token stays whole. Null and empty texts give no
    ids, repeated rows each give a row, other columns are ignored.
    """
    def use(c: Codec, doc_id, text):
        ids = array("I", chain.from_iterable(c.encode(text)))
        return doc_id, len(ids), ids.tobytes()

    return _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), path, pattern,
                 schema(doc_id=LONG, n_tokens=LONG, ids=BINARY), use)


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) -> doc_id, text. Bytes that aren't UTF-8 become U+FFFD; null ids give empty text."""
    def use(c: Codec, doc_id, ids):
        text, state = c.utf8.feed(array("I", ids or b""))
        return doc_id, text + c.utf8.finish(state)

    return _rows(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), path, pattern,
                 schema(doc_id=LONG, text=STRING), use)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256 (decimal ids joined
    by commas), decoded_sha256 (decoded text in UTF-8). Cases as in ``encode``."""
    def use(c: Codec, doc_id, text):
        n, said, back, state, comma = 0, hashlib.sha256(), hashlib.sha256(), None, ""
        state = c.utf8.start
        for ids in c.encode(text):
            n += len(ids)
            said.update((comma + ",".join(map(c.decimal.__getitem__, ids))).encode())
            comma = ","
            done, state = c.utf8.feed(ids, state)
            back.update(done.encode())
        back.update(c.utf8.finish(state).encode())
        return doc_id, n, said.hexdigest(), back.hexdigest()

    return _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), path, pattern,
                 schema(doc_id=LONG, n_tokens=LONG, ids_sha256=STRING, decoded_sha256=STRING), use)
