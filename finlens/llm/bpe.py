"""Byte-level BPE encoding and decoding through a table of distinct words.

Texts are cut into the tokenizer's words by vectorised rules.  Blocks of documents (a bounded number of text bytes
each) list their distinct words in order of their hashes and send them cut by ranges of the hash; equal words meet in
one range, where each is encoded once; the ids go back to the blocks by the word's position in the block's list,
where documents are put together.  What moves is the compressed text and the blocks' distinct words, packed,
never a row per word of the corpus.
Decoding joins ids to the pieces of the vocabulary, whose size bounds what is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.kit import _BYTE_KEY, arrow_map, ranges, span_hashes, text_slices

BLOCK_BYTES = 12 << 20   # text of a block
RANGES_EACH = 4          # hash ranges for each shuffle partition
SPECIAL = "<|endoftext|>"  # fixed value: the vocabulary's one added token
OTHER, LETTER, NUMBER, SPACE, MARK, MARK_REST = range(6)
# Unicode white space, and the endings split off after an apostrophe.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes(definition: str) -> np.ndarray:
    """Class of every code point: Python's, put right where the tokenizer knows another Unicode version."""
    import unicodedata

    table = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    table[:] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
    table[list(WHITE)] = SPACE
    cut = _tokenizer(definition).pre_tokenizer.pre_tokenize_str
    for lo in range(0, 0x110000, 512):
        codes = [c for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1 " for c in codes)
        data = np.frombuffer(text.encode(), np.uint8)
        starts = word_starts(data, np.array([0, len(data)]), table)[0]
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        if np.searchsorted(lead, starts).tolist() != [a for _, (a, _) in cut(text)]:
            for c in codes:
                table[c] = LETTER if len(cut("a" + chr(c))) == 1 else NUMBER if len(cut("1" + chr(c))) == 1 else \
                    SPACE if c in WHITE else OTHER
    return table


def word_starts(data: np.ndarray, offs: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of a slice of texts, and the first word of each text (one more at the end).

    The rules of the byte-level pre-tokenizer: an ending after a lone apostrophe, or an optional space with a run
    of letters, of digits or of other signs, or white space that leaves its last character to the next word."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return lead, np.zeros(len(offs), np.int64)
    raw = data.tobytes()
    code = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    cls, n = kinds[code], len(code)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(lead, offs)] = True
    edge[n] = True
    mark, at = SPECIAL.encode(), raw.find(SPECIAL.encode())
    while at >= 0:
        p = int(np.searchsorted(lead, at))
        if not edge[p + 1 : p + len(mark)].any():
            cls[p], cls[p + 1 : p + len(mark)] = MARK, MARK_REST
            at = raw.find(mark, at + len(mark))
        else:
            at = raw.find(mark, at + 1)
    start = edge[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    start[cls == MARK] = True
    start[cls == MARK_REST] = False
    follows = np.zeros(n, bool)  # white space before a word of the same text
    follows[:-1] = (cls[:-1] == SPACE) & ~edge[1:n] & (cls[1:] <= NUMBER)
    start |= follows
    joined = np.flatnonzero(follows & (code == 0x20)) + 1
    start[joined] = False
    lone = np.flatnonzero(start & (code == 0x27) & (cls == OTHER))
    lone = lone[lone + 1 < n]
    lone = lone[~edge[lone + 1] & (cls[lone + 1] == LETTER)]
    for end in ENDINGS:
        fit = lone[lone + len(end) < n]
        for k, c in enumerate(end, 1):
            fit = fit[(code[fit + k] == ord(c)) & ~edge[fit + k]]
        start[fit + 1] = False
        after = fit + 1 + len(end)
        start[after[after < n]] = True
        lone = np.setdiff1d(lone, fit, assume_unique=True)
    first = np.flatnonzero(start)
    return lead[first], np.searchsorted(lead[first], offs)


def _blocks(batches, limit: int):
    """Tables of consecutive rows (doc_id, text) with about ``limit`` bytes of text; cut by row order alone."""
    held, size = [], 0
    for b in batches:
        lens = np.cumsum([0, *pa.compute.fill_null(pa.compute.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)])
        lo = 0
        while lo < b.num_rows:
            hi = min(b.num_rows, max(lo + 1, int(np.searchsorted(lens, lens[lo] + limit - size))))
            held.append(b.slice(lo, hi - lo))
            size += int(lens[hi] - lens[lo])
            lo = hi
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _words(table: pa.Table, kinds: np.ndarray):
    """Of a block: its key, its bytes, the hashes, first bytes and lengths of its distinct words in order of their
    hashes, the distinct word of each word, and the number of words of each text."""
    data, starts, hashes, counts, base = [], [], [], [], 0
    for _, _, d, o in text_slices(table.column(1).combine_chunks()):
        at, first = word_starts(d, o, kinds)
        hashes.append(span_hashes(_BYTE_KEY[d], np.diff(np.append(at, len(d)))))
        starts.append((at + base).astype(np.int32))
        counts.append(np.diff(first))
        data.append(d)
        base += len(d)
    data, starts, counts = np.concatenate(data), np.concatenate(starts), np.concatenate(counts)
    known, at, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    ends = np.append(starts[1:], np.int32(len(data)))
    return _key(table), data, known, starts[at], (ends - starts)[at], which.astype(np.int32), counts


def encode(docs: DataFrame, tokenizer_file: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) for every row: ids are little-endian unsigned 32-bit integers in a binary column, as the
    tokenizers library gives them without special tokens added, truncation or padding.  A null or empty text has no
    ids.  Repeated rows and null ids pass through; other columns are not read.  docs must give the same rows in the
    same order when read twice, as a stored table does; if not, the job fails rather than mix up words."""
    kind = dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", "text")
    definition = open(tokenizer_file, encoding="utf-8").read()
    vocabulary = docs.sparkSession.sparkContext.broadcast(definition)
    table = docs.sparkSession.sparkContext.broadcast(classes(definition))

    n_ranges = RANGES_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def words(batches):
        for t in _blocks(batches, block_bytes):
            key, data, known, starts, lens, _, _ = _words(t, table.value)
            # range of a hash: its upper 32 bits times the number of ranges, over 2^32
            part = ((known >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(part, np.arange(n_ranges + 1))
            some = np.flatnonzero(np.diff(cut))
            bodies = []
            for k in some.tolist():
                s, n = starts[cut[k] : cut[k + 1]].astype(np.int64), lens[cut[k] : cut[k + 1]].astype(np.int64)
                bodies.append(zlib.compress(np.int32(len(n)).tobytes() + n.astype("<i4").tobytes() + data[ranges(s, n)].tobytes(), 3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), key)), pa.array(cut[some].astype(np.int32)), pa.array(bodies, pa.binary())],
                names=["part", "block", "place", "body"])

    def ids(batches):
        tokenizer = _tokenizer(vocabulary.value)
        now, code_of = None, {}
        for b in batches:
            out = []
            for part, place, body in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if part != now:
                    now, code_of = part, {}
                raw = zlib.decompress(body)
                n = int(np.frombuffer(raw, "<i4", 1)[0])
                ends = np.cumsum(np.frombuffer(raw, "<i4", n, 4), dtype=np.int64) + 4 + 4 * n
                list_ = [raw[x:y] for x, y in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                new = [w for w in list_ if w not in code_of]
                for w, e in zip(new, tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False), strict=True):
                    code_of[w] = np.array(e.ids, "<u4").tobytes()
                codes = [code_of[w] for w in list_]
                sizes = np.array([len(c) // 4 for c in codes], "<i4")
                out.append(zlib.compress(np.array([place, n], "<i4").tobytes() + sizes.tobytes() + b"".join(codes), 3))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(np.zeros(b.num_rows, np.int32)), pa.array(out, pa.binary())], names=["block", "kind", "body"])
        del tokenizer, code_of
        _tokenizer.cache_clear()  # a worker that goes on to other tasks does not keep it

    def texts(batches):
        for t in _blocks(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t)
            yield pa.RecordBatch.from_arrays([pa.array([_key(t)], pa.int64()), pa.array([1], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["block", "kind", "body"])

    def joined(batches):
        now, packs = None, []
        for b in batches:
            for block, what, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now:
                    now, packs = block, []
                if what == 0:
                    packs.append(body)
                    continue
                t = pa.ipc.open_stream(body).read_all()
                yield from _encoded(t, packs, table.value)

    known = arrow_map(docs, words, "part int, block long, place int, body binary").repartition("part").sortWithinPartitions("part")
    shape = "block long, kind int, body binary"
    both = arrow_map(known, ids, shape).union(arrow_map(docs, texts, shape))
    return arrow_map(both.repartition("block").sortWithinPartitions("block", "kind"), joined, f"doc_id {kind}, ids binary")


def _key(t: pa.Table) -> int:
    texts = t.column(1).combine_chunks()
    key = hashlib.blake2b(b"", digest_size=8)
    for _, _, d, _ in text_slices(texts):
        key.update(d.tobytes())
    key.update(repr((t.num_rows, t.column(0)[0].as_py(), t.column(0)[-1].as_py())).encode())
    return int.from_bytes(key.digest(), "little", signed=True)


def _encoded(t: pa.Table, packs: list[bytes], kinds: np.ndarray):
    """Rows (doc_id, ids) of a block from the ids of its distinct words."""
    _, _, known, _, _, which, counts = _words(t, kinds)
    at, size, flat, base = np.full(len(known), -1, np.int64), np.zeros(len(known), np.int64), [], 0
    for body in packs:
        raw = zlib.decompress(body)
        place, n = np.frombuffer(raw, "<i4", 2).tolist()
        lens = np.frombuffer(raw, "<i4", n, 8).astype(np.int64)
        flat.append(np.frombuffer(raw, "<u4", -1, 8 + 4 * n))
        at[place : place + n], size[place : place + n] = base + np.cumsum(lens) - lens, lens
        base += len(flat[-1])
    if (at < 0).any():
        raise RuntimeError("words of a block are missing: the input changed between two reads; store it first")
    flat = np.concatenate(flat) if flat else np.zeros(0, "<u4")
    first = np.cumsum(np.concatenate(([0], counts)))
    lo = 0
    while lo < t.num_rows:
        hi = lo + 1
        while hi < t.num_rows and first[hi + 1] - first[lo] <= 1 << 19:
            hi += 1
        w = which[first[lo] : first[hi]]
        body = flat[ranges(at[w], size[w])]
        ends = np.concatenate(([0], np.cumsum(size[w])))[first[lo : hi + 1] - first[lo]] * 4
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)])
        yield pa.RecordBatch.from_arrays([t.column(0).slice(lo, hi - lo).combine_chunks(), ids.cast(pa.binary())], names=["doc_id", "ids"])
        lo = hi


@lru_cache(1)
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(definition)
    t.no_truncation()
    t.no_padding()
    return t


def pieces(tokenizer_file: str) -> list[bytes]:
    """The bytes of every id of the vocabulary."""
    spec = json.load(open(tokenizer_file, encoding="utf-8"))
    # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for signs from 256 on, in order
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    sign = {chr(b): b for b in plain}
    sign |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    out = {i: bytes(sign[c] for c in w) for w, i in spec["model"]["vocab"].items()}
    out |= {a["id"]: a["content"].encode() for a in spec["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


def decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """(doc_id, ids, text): the ids' pieces put together and read as UTF-8, ill-formed parts replaced."""
    table = encoded.sparkSession.sparkContext.broadcast(pieces(tokenizer_file))
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches):
        parts = table.value
        flat, lens = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)
        at = np.cumsum(lens) - lens
        for b in batches:
            out = []
            for body in b.column(1).to_pylist():
                i = np.frombuffer(body or b"", "<u4")
                out.append(flat[ranges(at[i], lens[i])].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=["doc_id", "ids", "text"])
    return arrow_map(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids binary, text string")


def digests(docs: DataFrame, tokenizer_file: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document.  Smaller blocks take less memory and shuffle more."""
    both = decode(encode(docs, tokenizer_file, block_bytes), tokenizer_file)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
