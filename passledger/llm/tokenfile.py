"""Token ids of documents in a compact binary format, and back.

Ids are coded by a canonical Huffman code of limited length, built from global counts
(package-merge).  A dataset is a folder with two Parquet tables that hold binary values:

codebook   one row: code length of every id, a byte each, zlib-compressed
segments   `part`, `segment` (their order is that of the documents), `n_tokens`, `data`

`data` of a segment, all numbers little-endian:
    magic b"HCS2", uint32 docs, uint32 tokens a block, uint64 tokens
    docs x int64 id, docs x uint8 (1: the id is null), docs x uint32 tokens
    blocks x uint64 bit offset of the block
    the codes, most significant bit first, 8 zero bytes at the end
Blocks decode independently from their bit offsets, all of a segment side by side.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passledger.llm.common import BLOCK_CHARS, frugal, pick, remove, scratch, stored, text_blocks

MAGIC = b"HCS2"
#: Tokens in a block, tokens in a segment (a longer document is one segment), longest code in bits.
BLOCK, SEGMENT, MAX_BITS = 512, 1_000_000, 18
#: Bytes of raw ids that a range partition takes, about.
PART_BYTES = 24_000_000
_HEAD = struct.Struct("<4sIIQ")


# ---- encoding of texts


def _byte_letters() -> list[str]:
    """The letter by which byte-level models write each byte: itself if printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def separable(spec: dict) -> bool:
    """Whether a tokenizer drops white space between words, so that words encode alone.

    True for NFC, white space to one space and lower case, followed by a split that keeps
    only runs without white space.
    """
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = next((x for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if x.get("type") == "Split"), {})
    pattern = split.get("pattern", {}).get("Regex", "")
    keeps = pattern.split("|")[-3:] == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]
    return steps == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and split.get("invert") is True and keeps


#: Letters whose NFC form and lower case need no context, then punctuation that is one piece.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
_CACHE = 300_000


class Encoder:
    """Ids of texts as little-endian bytes; equal to the library's own result for each whole text."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._by_word = separable(json.loads(tokenizer_json)) and self.tokenizer.truncation is None
        self._letters = str.maketrans(dict(zip(map(chr, range(256)), _byte_letters())))
        self._chunks, self._pieces = _Chunks(self._chunk), {}
        spec = json.loads(tokenizer_json)
        self._blocks = BlockEncoder(self, spec["model"]) if self._by_word and Merges.fit(spec) else None

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        out = self._pieces.get(piece)
        if out is None:
            if len(self._pieces) >= _CACHE:
                self._pieces.clear()
            mapped = piece.encode().decode("latin-1").translate(self._letters)
            self._pieces[piece] = out = self._ids([t.id for t in self.tokenizer.model.tokenize(mapped)])
        return out

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            return self._piece(plain[1].lower()) + (self._piece(plain[2]) if plain[2] else b"")
        return self._ids(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self._by_word:
            return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self._word, text.replace("\n", " ").split(" ")))

    def _word(self, chunk: str) -> bytes:
        """Ids of what stands between spaces, of a separable tokenizer."""
        if len(self._chunks) >= _CACHE:
            self._chunks.clear()
        return self._chunks[chunk]

    def encode_all(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Ids of every text of a column, `end_id` after each."""
        if self._blocks:
            return self._blocks.encode(texts, end_id)
        end = np.array([end_id], self.dtype).tobytes()
        return pa.array([self.encode(t) + end for t in texts.to_pylist()], pa.binary())


class _Chunks(dict):
    def __init__(self, make):
        self._make = make

    def __missing__(self, chunk: str) -> bytes:
        out = self._make(chunk)
        if len(chunk) < 200:
            self[chunk] = out
        return out


class Merges:
    """Byte-pair encoding of many words at once: those of equally many symbols are rows of one array."""

    #: Longest word in bytes; a longer one takes the library.
    LONGEST = 64
    _NEVER = np.iinfo(np.int32).max

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.uint32)
        self.last = np.array([vocab[x + end] for x in letters], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        self._rank = np.argsort(keys).astype(np.int32)
        self._keys = keys[self._rank]
        self._made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        # Ranks of two bytes, inside a word and at its end.
        self._two = self._ranks(self.inner[:, None], self.inner), self._ranks(self.inner[:, None], self.last)

    @staticmethod
    def fit(spec: dict) -> bool:
        """Whether a separable tokenizer is of the kind that this class computes.

        Ids fit 16 bits, every byte is a symbol, alternatives of the split but the last three start
        with an apostrophe, and added tokens hold a `<`: words with either take the library.
        """
        model = spec["model"]
        end, vocab = model.get("end_of_word_suffix"), model.get("vocab")
        if model.get("type") != "BPE" or not end or not vocab or max(vocab.values()) >= 1 << 16:
            return False
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "fuse_unk", "byte_fallback"))
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x.get("type") == "Split")["pattern"]["Regex"]
        return (
            plain
            and len(set(pairs)) == len(pairs)
            and all(x in vocab and x + end in vocab for x in _byte_letters())
            and all(x.startswith("'") for x in split.split("|")[:-3])
            and all("<" in t["content"] for t in spec.get("added_tokens", []))
        )

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << np.uint32(16) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._rank[at], self._NEVER)

    def encode(self, data: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of words `which`, of 1 to `LONGEST` bytes each: pairs of word numbers and their ids, a word in a row.

        As the library does, a word's leftmost pair of least rank is merged first, then the next.
        """
        sizes = np.diff(offsets)[which]
        done, words, symbols, ranks = [], which[:0], np.zeros((0, self.LONGEST + 1), np.uint32), np.zeros((0, self.LONGEST), np.int32)
        for n in range(int(sizes.max(initial=0)), 0, -1):
            fresh = which[sizes == n]
            if len(fresh):  # words of n bytes join those that merges have brought to n symbols
                raw = data[offsets[fresh][:, None] + np.arange(n)]
                own = self.inner[raw]
                own[:, -1] = self.last[raw[:, -1]]
                words = np.concatenate([words, fresh])
                symbols = np.concatenate([symbols[:, :n], own])
                two = self._two[0][raw[:, :-1], raw[:, 1:]]
                if n > 1:
                    two[:, -1] = self._two[1][raw[:, -2], raw[:, -1]]
                ranks = np.concatenate([ranks[:, : n - 1], two])
            elif not len(words):
                continue
            if n == 1:
                done.append((words, symbols))
                break
            place = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, place[:, None], 1)[:, 0]
            go = best < self._NEVER
            if not go.all():
                done.append((words[~go], symbols[~go]))
                words, symbols, ranks, place, best = words[go], symbols[go], ranks[go], place[go], best[go]
            row, columns = np.arange(len(words)), np.arange(n)
            symbols = symbols[columns != place[:, None] + 1].reshape(len(words), n - 1)
            ranks = ranks[columns[:-1] != place[:, None]].reshape(len(words), n - 2)
            symbols[row, place] = self._made[best]
            for at in (place - 1, place):  # the pairs on both sides of the new symbol
                some = np.flatnonzero((at >= 0) & (at < n - 2))
                x = at[some]
                ranks[some, x] = self._ranks(symbols[some, x], symbols[some, x + 1])
        return done


#: Kinds of bytes in texts: what separates words, letters, digits, punctuation, what takes the library, the end of a text.
_GAP, _LETTER, _DIGIT, _SIGN, _ODD, _END = range(6)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _ODD, np.uint8)
    for kind, found in ((_LETTER, r"[A-Za-z]"), (_DIGIT, r"[0-9]"), (_SIGN, r"[!-&(-/:;=-@\[-`{-~]"), (_GAP, r"[ \n]")):
        kinds[[b for b in range(128) if re.match(found, chr(b))]] = kind
    return kinds


_KINDS = _kinds()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _lowered(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, and kinds, of the bytes of texts.  Beyond ASCII, letters from À to ÿ are known; these are 0xC3 and one byte."""
    low, kinds = _LOWER[raw], _KINDS[raw]
    high = np.flatnonzero(raw >= 128)
    if len(high):
        byte, second = raw[high], raw[high - 1] == 0xC3
        letter = second & (byte < 0xC0) & (byte != 0x97) & (byte != 0xB7)  # not × and ÷
        lead = (byte == 0xC3) & (raw[np.minimum(high + 1, len(raw) - 1)] >= 128)
        kinds[high[letter | lead]] = _LETTER
        low[high[letter & (byte < 0x9F)]] += 32
    return low, kinds


def _windows(raw: np.ndarray, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Begins and ends of about `limit` bytes, each behind a gap; a long text is not taken at once."""
    a = 0
    while a < len(raw):
        b = a + limit
        while b + limit < len(raw) and not len(gaps := np.flatnonzero((raw[b - limit : b] == 32) | (raw[b - limit : b] == 10))):
            b += limit
        b = b - limit + int(gaps[-1]) + 1 if b + limit < len(raw) else len(raw)
        yield a, b
        a = b


class BlockEncoder:
    """Ids of a whole column of texts, each distinct piece of it encoded once; equal to `encoder`'s for every text."""

    def __init__(self, encoder: Encoder, model: dict):
        self._encoder, self._merges = encoder, Merges(model)

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        empty = pa.scalar("", pa.large_string())
        ended = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(empty), empty, pa.scalar("\0", pa.large_string()))
        ends = np.frombuffer(ended.buffers()[1], np.int64)[: len(ended) + 1]
        raw = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[: ends[-1]]
        data, until, size = [], [ends[:1]], 0
        for a, b in _windows(raw):
            ids, upto = self._window(raw[a:b], ends[(ends > a) & (ends <= b)] - 1 - a, end_id)
            data.append(ids)
            until.append(upto + size)
            size += len(ids)
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(np.concatenate(until)), pa.py_buffer(b"".join(data))]).cast(pa.binary())

    def _window(self, raw: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of bytes of texts, and how many bytes of ids there are up to each of the texts' `ends`."""
        low, kinds = _lowered(raw)
        kinds[ends] = _END
        odd_at, odd_ids = self._odd(raw, low, kinds)
        cut = np.empty(len(kinds), bool)
        cut[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
        cut |= (kinds == _DIGIT) | (kinds == _END)
        cut[odd_at] = True
        start = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(raw))), pa.py_buffer(low)]).dictionary_encode()
        values = self._values(pieces.dictionary, end_id)
        index = pieces.indices.to_numpy().copy()
        index[np.searchsorted(start, odd_at)] = len(values) + np.arange(len(odd_at))
        found = pa.concat_arrays([values, pa.array(odd_ids, pa.large_binary())]).take(pa.array(index))
        offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1]
        return (found.buffers()[2] or pa.py_buffer(b""))[: int(offsets[-1])], offsets[np.flatnonzero(kinds[start] == _END) + 1]

    def _odd(self, raw: np.ndarray, low: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Where words between gaps begin that hold an odd byte, and their ids; leaves gaps in their place."""
        odd = np.flatnonzero(kinds == _ODD)
        if not len(odd):
            return odd, []
        gaps = np.flatnonzero((kinds == _GAP) | (kinds == _END))
        after = np.unique(np.searchsorted(gaps, odd))
        begins, ends = np.where(after > 0, gaps[after - 1] + 1, 0), gaps[after]
        ids = []
        for a, b in zip(begins.tolist(), ends.tolist()):
            ids.append(self._encoder._word(raw[a:b].tobytes().decode()))
            low[a:b], kinds[a:b] = 32, _GAP
        return begins, ids

    def _values(self, pieces: pa.Array, end_id: int) -> pa.Array:
        """Ids of distinct pieces."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        first, sizes = data[offsets[:-1]], np.diff(offsets)
        words = (first != 0) & (first != 32) & (first != 10)
        done = self._merges.encode(data, offsets, np.flatnonzero(words & (sizes <= Merges.LONGEST)))
        done += [(np.array([i]), np.frombuffer(self._encoder._piece(data[offsets[i] : offsets[i + 1]].tobytes().decode()), "<u2")[None]) for i in np.flatnonzero(words & (sizes > Merges.LONGEST))]
        done.append((np.flatnonzero(first == 0), np.full((int((first == 0).sum()), 1), end_id)))
        counts = np.zeros(len(pieces) + 1, np.int64)
        for which, ids in done:
            counts[which + 1] = ids.shape[1]
        begin = np.cumsum(counts)
        flat = np.zeros(begin[-1], "<u2")
        for which, ids in done:
            flat[begin[which][:, None] + np.arange(ids.shape[1])] = ids
        return pa.Array.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(2 * begin), pa.py_buffer(flat)])


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder a Python worker, kept between its tasks."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _encoded(shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in text_blocks(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": encoder.encode_all(batch.column("text"), end_id)})

    return run


# ---- the code


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most `max_bits` bits, by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need codes of more than {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_bits):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(leaves))
        both = both[order]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, total = 2 * (len(leaves) - 1), np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        total[:n] += 1
        take = 2 * (take - n)
    lengths[used] = total
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for x in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[x])
        if n:
            code <<= n - last
            codes[x], last = code, n
            code += 1
    return codes


def pack_bits(codes: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Codes one after another, most significant bit first, and the bit where each begins."""
    end = np.cumsum(sizes, dtype=np.int64)
    begin = end - sizes
    if not len(codes):
        return bytes(8), begin
    word, over = begin >> 6, (begin & 63) + sizes - 64
    high = np.where(over > 0, codes >> np.maximum(over, 0).astype(np.uint64), codes << np.maximum(-over, 0).astype(np.uint64))
    first = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
    out = np.zeros(int(end[-1] >> 6) + 2, np.uint64)
    out[word[first]] = np.bitwise_or.reduceat(high, first)
    spill = np.flatnonzero(over > 0)
    out[word[spill] + 1] |= codes[spill] << (64 - over[spill]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(end[-1] + 7 >> 3)] + bytes(8), begin


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """By the next bits of the stream: id, and code length above bit 24; and how many bits that are."""
    bits = max(1, int(lengths.max(initial=1)))
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(codes[used] << (bits - lengths[used]).astype(np.uint64), kind="stable")]
    spans = np.int64(1) << (bits - lengths[order].astype(np.int64))
    table = np.zeros(1 << bits, np.uint32)
    filled = np.repeat(order.astype(np.uint32) | lengths[order].astype(np.uint32) << np.uint32(24), spans)
    table[: len(filled)] = filled
    return table, bits


# ---- segments


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    tokens = np.concatenate(ids)
    payload, begin = pack_bits(codes[tokens], lengths[tokens].astype(np.int64))
    parts = [
        _HEAD.pack(MAGIC, len(doc_ids), BLOCK, len(tokens)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in ids], "<u4").tobytes(),
        begin[::BLOCK].astype("<u8").tobytes(),
        payload,
    ]
    return b"".join(parts)


def unpack_segment(data: bytes, table: np.ndarray, bits: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of tokens, and all tokens."""
    magic, docs, block, tokens = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(np.int64)
    at += 13 * docs
    n_blocks = -(-tokens // block)
    place = np.frombuffer(data, "<u8", n_blocks, at).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, offset=at + 8 * n_blocks).astype(np.uint32)
    window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    out = np.zeros((block, n_blocks), np.uint32)
    left = tokens - (n_blocks - 1) * block
    for t in range(block):  # every block's t-th token at once; the last block may be shorter
        p = place if t < left else place[:-1]
        found = table[(window[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - bits)]
        out[t, : len(p)] = found & np.uint32(0xFFFFFF)
        p += (found >> np.uint32(24)).astype(np.int64)
    return [None if z else int(x) for x, z in zip(doc_ids, nulls)], counts, out.T.ravel()[:tokens]


def _packed(shared, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        codes = canonical_codes(lengths)
        part, segment = TaskContext.get().partitionId(), 0
        docs, ids, size = [], [], 0

        def row():
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "segment": pa.array([segment], pa.int64()), "n_tokens": pa.array([size], pa.int64()), "data": pa.array([pack_segment(docs, ids, codes, lengths)], pa.binary())})

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                own = np.frombuffer(raw, dtype)
                if docs and size + len(own) > SEGMENT:
                    yield row()
                    docs, ids, size, segment = [], [], 0, segment + 1
                docs.append(doc)
                ids.append(own)
                size += len(own)
        if docs:
            yield row()

    return run


def _counted(dtype: str, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype), minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64())})

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Writes the ids of every whole text, `end_id` after each, in ascending order of ids (null first).

    Null and empty texts have only the end id.  Rows that share an id stand next to each
    other, in the order of their ids' bytes.  An empty table gives a dataset without segments.
    """
    spark = documents.sparkSession
    encoder = _encoder(tokenizer_json)
    dtype, vocabulary = encoder.dtype.str, max(encoder.tokenizer.get_vocab_size(), end_id + 1)
    spec = spark.sparkContext.broadcast(tokenizer_json)
    rows = pick(documents, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = stored(rows.mapInArrow(frugal(_encoded(spec, end_id)), "doc_id long, ids binary"), "ids")
    counts = np.zeros(vocabulary, np.int64)
    # At most one row for each id of the vocabulary.
    for r in encoded.mapInArrow(frugal(_counted(dtype, vocabulary)), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    book = zlib.compress(code_lengths(counts).tobytes())
    spark.createDataFrame([(bytearray(book),)], "lengths binary").write.parquet(f"{path}/codebook")
    parts = max(2, int(counts.sum()) * encoder.dtype.itemsize // PART_BYTES + 1)
    ordered = encoded.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    packed = ordered.mapInArrow(frugal(_packed(spark.sparkContext.broadcast(book), dtype)), "part long, segment long, n_tokens long, data binary")
    packed.write.option("compression", "none").parquet(f"{path}/segments")
    remove(spark, encoded.scratch_path)


def _read(book: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = decode_table(np.frombuffer(zlib.decompress(book), np.uint8))
        for batch in batches:
            for part, segment, data in zip(*(batch.column(n).to_pylist() for n in ("part", "segment", "data"))):
                doc_ids, counts, tokens = unpack_segment(data, table, bits)
                end = np.cumsum(counts)
                flat = tokens.astype("<u4")
                view = memoryview(flat.tobytes())
                n = len(doc_ids)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * n, pa.int64()),
                    "segment": pa.array([segment] * n, pa.int64()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array(end - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.array([view[4 * (b - c) : 4 * b] for b, c in zip(end.tolist(), counts.tolist())], pa.binary()),
                })

    return run


def _digested(book: bytes):
    read = _read(book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read(batches):
            crc = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], [*batch.schema.names[:-1], "ids_crc32"])

    return run


def _open(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    book = spark.read.parquet(f"{path}/codebook").first()["lengths"]
    return spark.read.schema("part long, segment long, n_tokens long, data binary").parquet(f"{path}/segments"), bytes(book)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id long, n_tokens long, ids binary (little-endian unsigned 32-bit) of a dataset."""
    segments, book = _open(spark, path)
    out = segments.select("part", "segment", "data").mapInArrow(frugal(_read(book)), "part long, segment long, doc_id long, start long, n_tokens long, ids binary")
    return out.select("doc_id", "n_tokens", "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens, ids_crc32 of a dataset, from its files.

    Starts come from two running sums, over partitions and over the segments of one.
    """
    segments, book = _open(spark, path)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = segments.select("part", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("before")).join(parts, "part")
    docs = segments.select("part", "segment", "data").mapInArrow(frugal(_digested(book)), "part long, segment long, doc_id long, start long, n_tokens long, ids_crc32 long")
    joined = docs.join(bases, ["part", "segment"])
    return joined.select("doc_id", (F.col("base") + F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of a dataset written to the shared folder for `documents`."""
    spark = documents.sparkSession
    path = scratch(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    write_tokens(documents, path, spec, id_col, text_col)
    return read_digests(spark, path)
