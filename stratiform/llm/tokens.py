"""Token ids of whole texts: each distinct piece of a chunk is encoded once.

The public byte-level BPE vocabulary is applied to pieces between safe borders:
a single space with no other white space beside it always begins a new
pre-token, so a text may be cut before each such space and its ids are those of
the pieces in a row. Within a few megabytes most pieces repeat. Pieces are
found and matched with numpy (by hash, then compared byte for byte); only the
distinct ones are encoded, side by side in one call, and told apart by the
known byte lengths of the ids. A worker keeps a bounded store of pieces between
chunks. A text that holds a special token's string, or a piece of more than
``LONG_PIECE`` bytes (a run of blanks, a text without spaces), is encoded as a
whole by the tokenizer of the vocabulary's JSON file.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from .textkit import Chunk, byte_hashes, chunks, lookup

VOCABULARY = "byte_bpe_50k"
CHUNK_BYTES = 4 << 20
#: Longer pieces would exhaust the fast encoder's pattern matcher.
LONG_PIECE = 20_000
#: Ids in a worker's store of pieces; it starts anew when it is full.
STORE_IDS = 3_000_000

_ASCII_SPACE = lookup(bytes([*range(0x09, 0x0E), *range(0x1C, 0x21)]))
#: First bytes of multi-byte characters among which some are white space.
_SPACE_LEAD = lookup(b"\xc2\xe1\xe2\xe3")
#: A text that ends in one of these ends in no white space.
_PLAIN_END = ~_ASCII_SPACE & (np.arange(256) < 0x80)


def tokenizer_path(name: str = VOCABULARY) -> str:
    """Place of the vocabulary: the same ids as ``<name>.json`` beside it, stored as ranks."""
    import public_tokenizers
    return public_tokenizers.path(f"{name}.tiktoken")


def piece_starts(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each piece, and whether a text begins there."""
    data = chunk.data
    n = len(data)
    cut = data == 0x20
    full = chunk.end > chunk.begin
    head = chunk.begin[full]
    cut[head] = False
    cut[chunk.end[full] - 1] = False
    at = np.flatnonzero(cut)
    before, after = data[at - 1], data[at + 1]
    bad = _ASCII_SPACE[before] | _ASCII_SPACE[after] | _SPACE_LEAD[after]
    wide = np.flatnonzero(before >= 0x80)
    two, three = data[at[wide] - 2], data[at[wide] - 3]
    bad[wide] |= (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))
    mark = np.zeros(n, dtype=bool)
    mark[at[~bad]] = True
    mark[head] = True
    start = np.flatnonzero(mark)
    is_head = np.zeros(n, dtype=bool)
    is_head[head] = True
    return start, is_head[start]


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the runs ``first[i] .. first[i] + size[i] - 1``, one after another."""
    upto = np.cumsum(size)
    if not len(upto):
        return np.zeros(0, np.int64)
    return np.repeat(first - upto + size, size) + np.arange(upto[-1])


class Encoder:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self._tokenizer = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)      # of each id
        for token, i in ranks.items():
            self._bytes[i] = len(token)
        self._json, self._whole = path.removesuffix(".tiktoken") + ".json", None
        with open(self._json, encoding="utf-8") as given:
            self._special = [t["content"].encode() for t in json.load(given)["added_tokens"]]
        self._clear()

    def _clear(self):
        self._hash, self._code = np.zeros(0, np.uint64), np.zeros(0, np.int64)      # sorted by hash
        self._raw, self._ids = array("B"), array("I")
        self._at = {x: array("q") for x in ("raw", "raw_n", "ids", "ids_n")}

    def _store(self, name: str) -> np.ndarray:
        return np.frombuffer(self._at[name], dtype=np.int64)

    def ids(self, raw: bytes) -> np.ndarray:
        return self._tokenizer.encode_to_numpy(raw.decode(), disallowed_special=())

    def whole(self, raw: bytes) -> np.ndarray:
        """Ids of any text, by the tokenizer object itself."""
        if self._whole is None:
            from tokenizers import Tokenizer
            self._whole = Tokenizer.from_file(self._json)
        return np.array(self._whole.encode(raw.decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def _odd(self, chunk: Chunk, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Texts that only the tokenizer object can encode."""
        odd = np.zeros(len(chunk), dtype=bool)
        odd[np.searchsorted(chunk.end, start[stop - start > LONG_PIECE], side="right")] = True
        data = chunk.data.tobytes()
        for token in self._special:
            at = data.find(token)
            while at >= 0:
                i = int(np.searchsorted(chunk.end, at, side="right"))
                odd[i] |= at + len(token) <= chunk.end[i]
                at = data.find(token, at + 1)
        return odd

    def _keep(self, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, n_ids: np.ndarray):
        for name, base, n in (("raw", len(self._raw), size), ("ids", len(self._ids), n_ids)):
            self._at[name].frombytes((np.cumsum(n) - n + base).astype(np.int64).tobytes())
            self._at[name + "_n"].frombytes(n.astype(np.int64).tobytes())
        self._raw.frombytes(raw.tobytes())
        self._ids.frombytes(ids.astype(np.uint32).tobytes())

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of pieces, -1 for unknown ones."""
        if not len(self._hash):
            return np.full(len(hashes), -1)
        where = np.minimum(np.searchsorted(self._hash, hashes), len(self._hash) - 1)
        return np.where(self._hash[where] == hashes, self._code[where], -1)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray, joint: np.ndarray):
        """Encode new pieces (hashes ascending) and return their codes: the joint
        ones side by side, the others one by one."""
        size, code, known = b - a, np.zeros(len(a), dtype=np.int64), len(self._at["raw"])
        at, alone = np.flatnonzero(joint), np.flatnonzero(~joint)
        code[at], code[alone] = known + np.arange(len(at)), known + len(at) + np.arange(len(alone))
        if len(at):
            raw = data[ragged(a[at], size[at])]
            ids = self.ids(raw.tobytes())
            end = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(size[at])) + 1
            self._keep(raw, size[at], ids, np.diff(end, prepend=0))
        for i in alone:
            raw = data[a[i]:b[i]]
            ids = self.ids(raw.tobytes())
            self._keep(raw, size[i:i + 1], ids, np.array([len(ids)]))
        where = np.searchsorted(self._hash, hashes)
        self._hash, self._code = np.insert(self._hash, where, hashes), np.insert(self._code, where, code)
        return code

    def encode_chunk(self, chunk: Chunk) -> list[np.ndarray]:
        """uint32 ids of each text of a chunk."""
        start, _ = piece_starts(chunk)
        odd = self._odd(chunk, start, np.append(start[1:], len(chunk.data)))
        if not odd.any():
            return self._encode(chunk)
        size = np.where(odd, 0, chunk.end - chunk.begin)
        end = np.cumsum(size)
        rest = self._encode(Chunk(chunk.data[ragged(chunk.begin, size)], end - size, end, chunk.lo))
        return [self.whole(chunk.raw(i)) if o else rest[i] for i, o in enumerate(odd)]

    def _encode(self, chunk: Chunk) -> list[np.ndarray]:
        if len(self._ids) > STORE_IDS:
            self._clear()
        data = chunk.data
        start, is_head = piece_starts(chunk)
        if not len(start):
            return [np.zeros(0, np.uint32)] * len(chunk)
        stop = np.append(start[1:], len(data))
        which, distinct = pd.factorize(byte_hashes(data, start, stop))
        first = np.zeros(len(distinct), dtype=np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        code = self._find(distinct)
        new = np.flatnonzero(code < 0)
        if len(new):
            new = new[np.argsort(distinct[new])]
            a, b = start[first[new]], stop[first[new]]
            ends = np.zeros(len(data) + 1, dtype=bool)
            ends[chunk.end] = True
            joint = ~is_head[first[new]] & (~ends[b] | _PLAIN_END[data[b - 1]])
            code[new] = self._learn(distinct[new], data, a, b, joint)
        code = code[which]
        size = self._store("raw_n")[code]
        if not (np.array_equal(size, stop - start) and np.array_equal(
                np.frombuffer(self._raw, dtype=np.uint8)[ragged(self._store("raw")[code], size)], data)):
            return [self.ids(chunk.raw(i)) for i in range(len(chunk))]       # a hash collision
        n = self._store("ids_n")[code]
        flat = np.frombuffer(self._ids, dtype=np.uint32)[ragged(self._store("ids")[code], n)]
        doc_end = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(start, chunk.end, side="left")]
        return np.split(flat, doc_end[:-1])

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """uint32 ids of each text of a string column, null as empty."""
        for chunk in chunks(column, CHUNK_BYTES):
            yield from self.encode_chunk(chunk)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file (loaded once a process)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
