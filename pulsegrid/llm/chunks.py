"""Token ids of whole Arrow text columns by public tokenizers.

A text is cut where no token of the vocabulary can lie across: before white
space that follows something else, and between a letter or digit and ASCII
punctuation. The pieces between cuts (chunks) are dictionary-encoded, so the
tokenizer sees each distinct chunk once while it stays in a bounded memory,
and ids of the column are gathered from the dictionary by offsets. The ids
equal those of the tokenizer on the whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from pulsegrid.llm.common import text_slices

MEMORY_CHUNKS = 500_000  # a generation of remembered chunks; two are kept
STEP = 8 << 20  # bytes of text coded at once

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[0x21:0x7F] = True
_PUNCT &= ~_ALNUM


def _wide_blank(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Do the UTF-8 bytes a, b, c end with white space beyond ASCII, or with
    the sign that stands for a space in piece vocabularies?"""
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    three = (a == 0xE2) & (((b == 0x80) & ((c < 0x8B) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)) | ((b == 0x96) & (c == 0x81)))
    rare = ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return two | three | rare


def chunk_edges(data: np.ndarray, offsets: np.ndarray, joined_by_cr: bool = False) -> np.ndarray:
    """Sorted byte positions where chunks start, and the end of the data."""
    n = len(data)
    blank, alnum = _BLANK[data], _ALNUM[data]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = (blank[1:] & ~blank[:-1]) | (alnum[:-1] & _PUNCT[data[1:]])
    if joined_by_cr:
        cut[:n] &= data != 0x0D
    at = np.flatnonzero(cut)
    last = data[at - 1] if len(at) else data[:0]
    wide = at[(last >= 0x80) & (at >= 3)]
    if len(wide):
        cut[wide[_wide_blank(data[wide - 3], data[wide - 2], data[wide - 1])]] = False
    marks = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if n else at
    if len(marks):  # special tokens look like <|...|>: keep the run around them in one chunk
        solid = np.flatnonzero(np.concatenate(([True], blank[1:] != blank[:-1], [True])))
        runs = np.unique(np.searchsorted(solid, marks, "right") - 1)
        for a, b in zip(solid[runs], solid[runs + 1], strict=True):
            cut[a + 1:b] = False
    cut[offsets] = True
    cut[0] = cut[n] = True
    return np.flatnonzero(cut)


class ChunkCoder:
    """Ids of texts from ``encode``, which maps a list of distinct chunks
    (bytes) to a list of little-endian unsigned 32-bit id strings."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], joined_by_cr: bool = False, memory: int | None = None):
        self.encode, self.joined_by_cr, self.memory = encode, joined_by_cr, memory
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _known(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.young) > (self.memory or MEMORY_CHUNKS):
            self.old, self.young = self.young, {}
        known = list(map(self.young.get, chunks))
        new = [c for c, k in zip(chunks, known, strict=True) if k is None]
        if new:
            fresh = [c for c in new if c not in self.old] if self.old else new
            if len(fresh) < len(new):
                self.young.update((c, self.old[c]) for c in new if c in self.old)
            self.young.update(zip(fresh, self.encode(fresh), strict=True))
            known = list(map(self.young.__getitem__, chunks))
        return known

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, one after the other; where each row starts in them)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        edges = chunk_edges(data, offsets, self.joined_by_cr).astype(np.int64)
        raw = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = raw.dictionary_encode()
        known = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        out = known.take(coded.indices)
        ends = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1) >> 2
        return np.frombuffer(out.buffers()[2] or b"", "<u4"), ends[np.searchsorted(edges, offsets)]

    def rows(self, column: pa.Array, step: int = STEP) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, row starts) over runs of rows of about ``step``
        bytes; null texts are empty."""
        for first, data, offsets in text_slices(column, step):
            yield first, *self.ids(data, offsets)


def _library(path: str, plain_specials: bool):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = plain_specials
    return tok


def _each(tok, chunks: list[bytes]) -> list[bytes]:
    found = tok.encode_batch_fast(list(map(bytes.decode, chunks)), add_special_tokens=False) if chunks else []
    return [array("I", e.ids).tobytes() for e in found]


def _long(tok, text: str, stops_at: Callable[[np.ndarray], np.ndarray], number: int) -> list[bytes]:
    """Ids of one long string, cut behind the tokens that ``stops_at`` names."""
    raw = array("I", tok.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()
    stops = [0, *(4 * stops_at(np.frombuffer(raw, "<u4")) + 4).tolist()]
    if len(stops) != number + 1 or stops[-1] != len(raw):
        raise ValueError("a token lies across chunks")
    return list(map(raw.__getitem__, map(slice, stops, stops[1:])))


def byte_level_table(tok) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, special tokens as
    their text. Printable Latin-1 stands for itself, the other bytes for the
    code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = tok.get_added_tokens_decoder()
    return [special[i].content.encode() if i in special else bytes(byte_of[c] for c in tok.id_to_token(i)) for i in range(tok.get_vocab_size())]


class ByteLevelCoder(ChunkCoder):
    """A byte-level BPE of the tokenizers library, by whole texts. Chunks that
    start with white space part from what stands before them, so thousands of
    them are encoded as one string."""

    def __init__(self, path: str, plain_specials: bool = False):
        self.tok = _library(path, plain_specials)
        super().__init__(self._encode)
        self.table = byte_level_table(self.tok)
        self.lengths = np.array(list(map(len, self.table)), np.int64)

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        together = [c for c in chunks if _BLANK[c[0]] and c[-1] < 0x80 and not _BLANK[c[-1]] and b"<|" not in c]
        out: dict[bytes, bytes] = {}
        for at in range(0, len(together), 8192):
            some = together[at:at + 8192]
            borders = np.cumsum(list(map(len, some)))
            out.update(zip(some, _long(self.tok, b"".join(some).decode(), lambda ids, to=borders: np.flatnonzero(
                np.isin(np.cumsum(self.lengths[ids]), to, assume_unique=True)), len(some)), strict=True))
        apart = [c for c in chunks if c not in out]
        out.update(zip(apart, _each(self.tok, apart), strict=True))
        return list(map(out.__getitem__, chunks))


class WordEndCoder(ChunkCoder):
    """A BPE with word ends that drops white space and case. Chunks that are
    one word of Latin letters need no normalizing beyond lower case, so
    hundreds of them are encoded as one string by the model alone."""

    def __init__(self, path: str, memory: int | None = None):
        from tokenizers import Tokenizer

        self.tok = _library(path, False)
        super().__init__(self._encode, memory=memory)
        bare = json.loads(self.tok.to_str()) | {"normalizer": None, "added_tokens": []}
        bare["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        end = bare["model"]["end_of_word_suffix"]
        self.last = np.array([(self.tok.id_to_token(i) or "").endswith(end) for i in range(self.tok.get_vocab_size())])
        self.word = re.compile(rb"[\t-\r ]*(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        words = [c for c in chunks if self.word(c)]
        out: dict[bytes, bytes] = {}
        for at in range(0, len(words), 256):
            some = words[at:at + 256]
            text = b" ".join(some).decode().lower()
            out.update(zip(some, _long(self.bare, text, lambda ids: np.flatnonzero(self.last[ids]), len(some)), strict=True))
        apart = [c for c in chunks if c not in out]
        out.update(zip(apart, _each(self.tok, apart), strict=True))
        return list(map(out.__getitem__, chunks))


class PieceCoder(ChunkCoder):
    """A sentencepiece BPE with byte fallback over texts that already carry
    the leading space which the library would add."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__(self._encode, joined_by_cr=True)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        self.table = [bytes([int(m[1], 16)]) if (m := byte(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.lengths = np.array(list(map(len, self.table)), np.int64)
        self.space = self.model.piece_to_id("▁")

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        # a line break joins no other piece; the library puts its space before it
        texts = [c[1:].decode() if c[0] == 0x20 else "\n" + c.decode() for c in chunks]
        out = []
        for c, ids in zip(chunks, self.model.encode(texts, num_threads=1), strict=True):
            if c[0] != 0x20:
                ids = ids[2:]
            elif len(c) == 1:
                ids = [self.space]
            out.append(array("I", ids).tobytes())
        return out


_CODERS: dict[tuple, ChunkCoder] = {}


def coder(kind: type[ChunkCoder], *args) -> ChunkCoder:
    """One coder a worker process."""
    key = (kind.__name__, *args)
    if key not in _CODERS:
        _CODERS[key] = kind(*args)
    return _CODERS[key]
