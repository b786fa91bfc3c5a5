"""Byte-level BPE in two tiers: whole pre-tokens through a minimal perfect hash, the others by merges over linked bytes.

A pre-token that is an entry of the vocabulary is its id: distinct pre-tokens of a slice are looked up together in a
hash-and-displace table with exactly one place for each entry, and the entry's bytes are compared, so a wrong hit
cannot happen.  A pre-token that is not goes through its merges: its bytes are a doubly linked list, and a heap holds
the ranks of neighbouring pairs, so a long one costs n log n.  Both tiers run inside the scan's tasks: nothing is
shuffled, and tasks hold the vocabulary and a slice of text.
"""

from __future__ import annotations

import base64
from array import array
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from finlens.llm.kit import _BYTE_KEY, SLICE_BYTES, arrow_map, mix, ranges, span_hashes

PIECE_CHARS = 1 << 18  # characters of a text cut into pre-tokens at once, about
DECODED = 1 << 19  # ids decoded at once, or one row's
SEEN = 1 << 19  # merged pre-tokens, of 64 bytes at most, that a task keeps for its next slices


@dataclass(frozen=True)
class PerfectHash:
    """Place of a key of n keys: its bucket's displacement mixed into its hash, modulo n; a bucket of one key names its
    place."""

    shift: np.ndarray  # of each bucket; below 0, the place is -1 - shift
    size: int

    def place(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, np.int64)
        s = self.shift[(hashes >> np.uint64(32)) % np.uint64(len(self.shift))]
        return np.where(s < 0, -1 - s, _displaced(hashes, np.maximum(s, 0)) % np.uint64(self.size)).astype(np.int64)


def _displaced(hashes, shift):
    return mix(hashes + np.asarray(shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def perfect_hash(hashes: np.ndarray, each: int = 4, tries: int = 1 << 22) -> PerfectHash:
    """A minimal perfect hash over distinct 64-bit hashes: buckets of about ``each`` keys, the fullest first, take the first
    displacement that puts their keys on free places."""
    n = len(hashes)
    if len(np.unique(hashes)) != n:
        raise ValueError("keys have equal hashes")
    bucket = ((hashes >> np.uint64(32)) % np.uint64(max(1, n // each))).astype(np.int64)
    shift, free = np.zeros(max(1, n // each), np.int64), np.ones(n, bool)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=len(shift))
    first = np.cumsum(sizes) - sizes
    for b in np.argsort(-sizes, kind="stable").tolist():
        k = int(sizes[b])
        if k < 2:
            break
        keys, at = hashes[order[first[b] : first[b] + k]], 0
        while True:
            s = np.arange(at, at + 64)
            place = (_displaced(keys[:, None], s[None, :]) % np.uint64(n)).astype(np.int64)
            fits = free[place].all(0)
            for j in np.flatnonzero(fits).tolist():
                if len(set(place[:, j].tolist())) == k:
                    shift[b] = at + j
                    free[place[:, j]] = False
                    break
            else:
                at += 64
                if at > tries:
                    raise ValueError("no displacement found")
                continue
            break
    shift[np.flatnonzero(sizes == 1)] = -1 - np.flatnonzero(free)[: int((sizes == 1).sum())]
    return PerfectHash(shift, n)


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of byte strings, which are their ids, and the pattern whose matches are encoded separately."""

    pattern: str
    pieces: list[bytes]  # by place of the perfect hash
    ids: np.ndarray      # of the pieces
    table: PerfectHash
    others: str          # characters that the pattern's engine here takes for letters or digits, the tokenizer's does not


def read_vocabulary(file: str, pattern: str) -> Vocabulary:
    """A rank file: lines of a base64 byte string and its rank."""
    ranks = {}
    with open(file, "rb") as f:
        for line in f:
            if line.strip():
                piece, rank = line.split()
                ranks[base64.b64decode(piece)] = int(rank)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte has no rank")
    pieces = list(ranks)
    hashes = _hashes(pieces)
    table = perfect_hash(hashes)
    place = table.place(hashes)
    by_place, ids = [b""] * len(pieces), np.zeros(len(pieces), np.int32)
    for p, piece in zip(place.tolist(), pieces, strict=True):
        by_place[p], ids[p] = piece, ranks[piece]
    return Vocabulary(pattern, by_place, ids, table, _newer_characters())


def _newer_characters() -> str:
    """Letters and digits of Unicode versions that the pattern engine knows and the tokenizer does not.  Both classes are
    told by whether the tokenizer's own cutting leaves such a character in one pre-token with a letter or digit."""
    import unicodedata

    import public_tokenizers
    import tiktoken
    # only signs that this Python does not know at all can differ between the versions in use
    new = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"]
    new = regex.findall(r"[\p{L}\p{N}]", "".join(new))
    if not new:
        return ""
    ranks = {bytes([b]): b for b in range(256)}
    for lead in "a1":
        for c in new:
            ranks[(lead + c).encode()] = len(ranks)
    own = tiktoken.Encoding("classes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    one = [{c for c in new if len(own.encode_ordinary(lead + c)) == 1} for lead in "a1"]
    return "".join(c for c in new if c not in one[0] and c not in one[1])


def _hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    return span_hashes(_BYTE_KEY[np.frombuffer(b"".join(words), np.uint8)], lens)


def merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: of all neighbouring parts whose concatenation has a rank, the one of least rank, leftmost first, is
    joined until none is left.  ``end`` and ``before`` link the parts by their first bytes."""
    n, get = len(word), ranks.get
    bits = n.bit_length()
    mask, high = (1 << bits) - 1, 2 * bits
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # end 0: joined to the part before
    # a pair in the heap: its rank, its first byte, and the byte behind it
    heap = [get(word[i : i + 2]) << high | i << bits | i + 2 for i in range(n - 1) if word[i : i + 2] in ranks]
    heapify(heap)
    while heap:
        pair = heappop(heap)
        i, stop = pair >> bits & mask, pair & mask
        middle = end[i]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # one of the parts has grown since
        end[middle], end[i] = 0, stop
        if stop < n:
            before[stop] = i
            r = get(word[i : end[stop]])
            if r is not None:
                heappush(heap, r << high | i << bits | end[stop])
        left = before[i]
        if left >= 0:
            r = get(word[left:stop])
            if r is not None:
                heappush(heap, r << high | left << bits | stop)
    out, i = [], 0
    while i < n:
        stop = end[i]
        out.append(ranks[word[i:stop]])
        i = stop
    return out


class Encoder:
    """Pre-tokens and their ids in a task."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.cut = regex.compile(v.pattern)
        self.odd = frozenset(v.others)
        self.plain = {ord(c): "￾" for c in v.others}  # neither letter, digit nor white space
        self.lens = np.fromiter(map(len, v.pieces), np.int64, len(v.pieces))
        self.flat = np.frombuffer(b"".join(v.pieces), np.uint8)
        self.first = np.cumsum(self.lens) - self.lens
        self.ranks = dict(zip(v.pieces, v.ids.tolist(), strict=True))
        self.seen: dict[bytes, bytes] = {}

    def words(self, text: str):
        """Lists of the pattern's matches, a bounded piece of the text at a time.  Pieces end before a space that follows
        a character other than white space, where no match goes on."""
        at = 0
        while at < len(text):
            stop = min(len(text), at + PIECE_CHARS)
            while stop < len(text) and not (text[stop] == " " and not text[stop - 1].isspace()):
                stop = text.find(" ", stop + 1)
                stop = len(text) if stop < 0 else stop
            piece = text[at:stop] if at or stop < len(text) else text
            if not piece.isascii() and not self.odd.isdisjoint(piece):
                yield [piece[m.start() : m.end()] for m in self.cut.finditer(piece.translate(self.plain))]
            else:
                yield self.cut.findall(piece)
            at = stop

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens one after another, and the number of each."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(lens) - lens
        place = self.v.table.place(span_hashes(_BYTE_KEY[data], lens))
        known = self.lens[place] == lens
        k = np.flatnonzero(known)
        same = data[ranges(first[k], lens[k])] == self.flat[ranges(self.first[place[k]], lens[k])]
        known[k] = np.logical_and.reduceat(same, np.cumsum(lens[k]) - lens[k]) if len(k) else False
        missed = np.flatnonzero(~known).tolist()
        merged = [self._merged(words[i]) for i in missed]
        count = np.ones(len(words), np.int64)
        count[missed] = [len(m) // 4 for m in merged]
        out = np.zeros(int(count.sum()), np.int32)
        at = np.cumsum(count) - count
        out[at[known]] = self.v.ids[place[known]]
        if missed:
            out[ranges(at[missed], count[missed])] = np.frombuffer(b"".join(merged), np.int32)
        return out, count

    def _merged(self, word: bytes) -> bytes:
        found = self.seen.get(word)
        if found is None:
            found = array("i", merges(word, self.ranks)).tobytes()
            if len(word) <= 64:
                if len(self.seen) >= SEEN:
                    self.seen.clear()
                self.seen[word] = found
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; pre-tokens that repeat within these texts are looked up once."""
        number: dict[str, int] = {}
        which, cuts = [], [0]
        for t in texts:
            n = cuts[-1]
            for words in self.words(t or ""):
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                which.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                n += len(words)
            cuts.append(n)
        which = np.concatenate(which) if which else np.zeros(0, np.int32)
        ids, count = self.ids([w.encode() for w in number])
        first = np.cumsum(count) - count
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            w = which[a:b]
            out.append(ids[ranges(first[w], count[w])] if b > a else np.zeros(0, np.int32))
        return out


@lru_cache(2)
def _vocabulary(file: str, pattern: str) -> Vocabulary:
    return read_vocabulary(file, pattern)


def encode(docs: DataFrame, file: str, pattern: str) -> DataFrame:
    """(doc_id, ids: array of int) for every row, as the rank file's library encodes the text without special tokens.  A
    null or empty text has no ids.  Repeated rows and null ids pass through; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(_vocabulary(file, pattern))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        encoder = Encoder(shared.value)
        for b in batches:
            for lo, hi in _cuts(b.column(1)):
                ids = encoder.encode(b.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), _lists(ids, pa.int32())], names=["doc_id", "ids"])
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>")


def _cuts(texts):
    """Runs of rows of at most SLICE_BYTES of text, or one row."""
    size = np.cumsum([0, *pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + SLICE_BYTES, side="right")) - 1)
        yield lo, hi
        lo = hi


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))


def decode(encoded: DataFrame, file: str, pattern: str) -> DataFrame:
    """(doc_id, ids, bytes): the ids' pieces put together, as they are (not every part of them need be UTF-8).  A null id list
    has no bytes; an id that the file does not have is an error."""
    v = _vocabulary(file, pattern)
    by_id = [b""] * (int(v.ids.max()) + 1)
    for i, piece in zip(v.ids.tolist(), v.pieces, strict=True):
        by_id[i] = piece
    shared = encoded.sparkSession.sparkContext.broadcast(by_id)
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches):
        lens = np.fromiter(map(len, shared.value), np.int64, len(shared.value))
        flat, first = np.frombuffer(b"".join(shared.value), np.uint8), np.cumsum(lens) - lens
        for b in batches:
            lists = b.column(1)
            ends = np.cumsum([0, *pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)])
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + DECODED, side="right")) - 1)
                ids = lists.slice(lo, hi - lo).flatten().to_numpy()
                if len(ids) and (ids.min() < 0 or ids.max() >= len(lens) or not lens[ids].all()):
                    raise ValueError("no such id")
                at = np.concatenate(([0], np.cumsum(lens[ids])))[ends[lo : hi + 1] - ends[lo]]
                body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat[ranges(first[ids], lens[ids])])])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists.slice(lo, hi - lo), body.cast(pa.binary())], names=["doc_id", "ids", "bytes"])
                lo = hi
    return arrow_map(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids array<int>, bytes binary")
