"""Byte-level BPE encoding and decoding as bounded-lookahead streams (operator 8).

Encoding reads a text in windows and emits tokens once no later character can
change them; decoding feeds tokens to a UTF-8 state machine. Both keep memory
constant in the length of the text, whatever its words look like.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

WINDOW = 1 << 16
MEMO_ENTRIES = 300_000
MEMO_CHARS = 40
NONE = 1 << 60
#: The pre-splitting pattern's white space (Unicode White_Space).
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"


@lru_cache(maxsize=1)
def splitter() -> regex.Pattern:
    """Contractions, then letters, numbers and others each with one leading space, then white space."""
    return regex.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
                         rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


#: White space next to a space: there, a space need not begin a piece.
_WIDE = re.compile(f" [{WHITE}]|[{WHITE}] ")


def byte_alphabet() -> dict[str, int]:
    """The vocabulary's printable stand-in of each byte: printable Latin-1 stands for
    itself, the other bytes follow in order from code point 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges, token bytes and the sufficient lookahead of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        alphabet = byte_alphabet()
        ids = model["vocab"]
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in ids.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.specials.items()}
        self.byte_ids = [0] * 256
        for c, b in alphabet.items():
            self.byte_ids[b] = ids[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        self.ranks = {(a, b): r for r, (a, b, _) in enumerate(pairs)}
        self.made = [c for _, _, c in pairs]
        self.lookahead = sufficient_lookahead([(self.bytes_of[a], self.bytes_of[b]) for a, b, _ in pairs])
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.special_split = re.compile("|".join(re.escape(t) for t in sorted(self.specials, key=len, reverse=True))) if self.specials else None


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes that must follow a token boundary before no later byte can move it.

    Later bytes change the merges next to them; a change travels left only when, at
    a later merge (u, v), its v starts at the change, which moves the change to the
    start of u. The next merge of such a chain has a v that starts with this u. So the
    reach is the heaviest chain of merges in rank order, each weighing len(u), found in
    one pass over the list; the bytes of the first v that were seen add one longest token.
    """
    best: dict[bytes, int] = {}
    reach = longest = 0
    for u, v in merges:
        longest = max(longest, len(u) + len(v))
        chain = len(u) + max((best.get(v[:n], 0) for n in range(1, len(v) + 1)), default=0)
        if chain > best.get(u, 0):
            best[u] = chain
            reach = max(reach, chain)
    return reach + longest


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Spaced(dict):
    """Ids of a space and the key, learnt when first asked for; emptied when full."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.learn(" " + word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Token ids of texts; a bounded memo keeps the ids of short words."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.spaced = _Spaced(self._split)
        self.block = 4 * vocab.lookahead

    def pieces(self, text: str) -> Iterator[list[int] | tuple[int, ...]]:
        """Ids of ``text`` in parts. Specials are cut out first; the rest is read in
        windows, and a window's pieces are final when they end three characters
        before its end (one character decides white space, two a contraction)."""
        at = 0
        if self.v.special_split is not None:
            for m in self.v.special_split.finditer(text):
                yield from self._plain(text, at, m.start())
                yield (self.v.specials[m[0]],)
                at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        split = splitter()
        while at < end:
            stop = min(end, at + WINDOW)
            if stop < end:
                # a space between two other characters always begins a piece
                cut = text.rfind(" ", at + 1, stop - 1)
                while cut > 0 and (text[cut - 1] in WHITE or text[cut + 1] in WHITE):
                    cut = text.rfind(" ", at + 1, cut)
                if cut > 0:
                    stop = cut
                else:
                    parts, tail = split.findall(text, at, stop), 0
                    while parts and tail < 3:
                        tail += len(parts.pop())
                    if not parts:  # one run fills the window: stream its bytes
                        run_end = split.match(text, at, end).end()
                        yield from self._run(text, at, run_end)
                        at = run_end
                        continue
                    yield [i for p in parts for i in self._piece(p)]
                    at = stop - tail
                    continue
            window = text[at:stop]
            at = stop
            if _WIDE.search(window):
                yield self._split(window)
            else:
                first, *rest = window.split(" ")
                if first:
                    yield self._split(first)
                if rest:
                    yield list(chain.from_iterable(map(self.spaced.__getitem__, rest)))

    def _split(self, text: str) -> tuple[int, ...]:
        return tuple([i for piece in splitter().findall(text) for i in self._piece(piece)])

    def _piece(self, piece: str) -> list[int]:
        data = piece.encode()
        if len(data) > self.block:
            return [i for part in self._run(piece, 0, len(piece)) for i in part]
        return self.merge(data)

    def _run(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        """The transducer over one unsplit run: merge what is buffered, emit the tokens that
        end ``lookahead`` bytes before its end, go on from the last boundary emitted."""
        held = b""
        while at < end:
            step = min(end, at + self.block)
            held += text[at:step].encode()
            at = step
            if at >= end:
                break
            ids, size, n = self.merge(held), 0, 0
            limit = len(held) - self.v.lookahead
            for i in ids:
                if size + len(self.v.bytes_of[i]) > limit:
                    break
                size += len(self.v.bytes_of[i])
                n += 1
            if n:
                yield ids[:n]
                held = held[size:]
        if held:
            yield self.merge(held)

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost first."""
        byte_ids, ranks, made = self.v.byte_ids, self.v.ranks.get, self.v.made
        ids = [byte_ids[b] for b in data]
        if len(ids) > 96:
            return self._merge_long(ids)
        open_ranks = [ranks(p, NONE) for p in zip(ids, ids[1:])]
        while open_ranks:
            r = min(open_ranks)
            if r == NONE:
                break
            i = open_ranks.index(r)
            ids[i] = new = made[r]
            del ids[i + 1], open_ranks[i]
            if i < len(open_ranks):
                open_ranks[i] = ranks((new, ids[i + 1]), NONE)
            if i:
                open_ranks[i - 1] = ranks((ids[i - 1], new), NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of (rank, place) over a linked list: n log n."""
        ranks, made, n = self.v.ranks, self.v.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ranks.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = made[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (m := ranks.get((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (m, k))
        return [i for i in ids if i >= 0]


class ByteToText:
    """Incremental byte-to-text machine: bytes of tokens in, text out.

    At most three bytes of an unfinished UTF-8 sequence are held. What can never become a
    character is replaced by U+FFFD, one for each maximal prefix of a character."""

    #: Lead byte ranges with the length of the character and its second byte's range.
    LEADS = ((0xC2, 0xDF, 2, 0x80, 0xBF), (0xE0, 0xE0, 3, 0xA0, 0xBF), (0xE1, 0xEC, 3, 0x80, 0xBF),
             (0xED, 0xED, 3, 0x80, 0x9F), (0xEE, 0xEF, 3, 0x80, 0xBF), (0xF0, 0xF0, 4, 0x90, 0xBF),
             (0xF1, 0xF3, 4, 0x80, 0xBF), (0xF4, 0xF4, 4, 0x80, 0x8F))

    def __init__(self):
        self.held = b""

    @classmethod
    def open_tail(cls, data: bytes) -> int:
        """Length of the unfinished but valid sequence that ``data`` ends with."""
        for n in range(1, min(3, len(data)) + 1):
            b = data[-n]
            if b < 0x80:
                return 0
            if b >= 0xC0:
                for low, high, size, second_low, second_high in cls.LEADS:
                    if low <= b <= high:
                        return n if n < size and (n == 1 or second_low <= data[-n + 1] <= second_high) else 0
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.open_tail(data)
        self.held = data[len(data) - n:]
        return data[:len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


def decode(vocab: Vocabulary, parts: Iterable[Iterable[int]]) -> Iterator[str]:
    """Text of token ids that arrive in parts."""
    machine, table = ByteToText(), vocab.bytes_of
    for ids in parts:
        yield machine.feed(b"".join([table[i] for i in ids]))
    yield machine.close()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker; its memo serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(vocabulary(path))
    return _ENCODERS[path]


def digest_text(enc: Encoder, text: str) -> tuple[int, str, str]:
    """(number of tokens, digest of the ids, digest of the text decoded from them)."""
    ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
    machine, names, table = ByteToText(), enc.v.text_of, enc.v.bytes_of
    for ids in enc.pieces(text):
        if not ids:
            continue
        if n:
            ids_hash.update(b",")
        ids_hash.update(",".join([names[i] for i in ids]).encode())
        n += len(ids)
        text_hash.update(machine.feed(b"".join([table[i] for i in ids])).encode())
    text_hash.update(machine.close().encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Null and empty texts have no tokens. Map-only: rows are encoded where they are read;
    repeated rows and null ids stay, other columns are left out. ``vocab_path`` must exist
    on every executor.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for batch in batches:
            rows = [digest_text(enc, t.as_py() or "") for t in batch.column(1)]
            n, ids, text = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                           ).withColumnRenamed("id", id_col)


def encode_ids(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array) of every row: the tokens themselves."""
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for batch in batches:
            ids = [[i for part in enc.pieces(t.as_py() or "") for i in part] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return slim.mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)
