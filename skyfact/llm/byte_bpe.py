"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The rank file lists tokens as bytes.  Every byte stands for one printable character, so that the
library's BPE model, which works on characters, sees any bytes; decoding reads that table in reverse.
Merging by rank joins whatever neighbours make a token, the least rank first.  What a token is joined from
last is the same wherever it stands, since no merge inside of it can depend on its surroundings; so
the merge list that the library wants has one pair for each token, found by merging its own bytes.

Texts are cut where the pattern ends a match in any case.  So a piece has the same tokens wherever it
stands: the library gets each piece of a batch once, and a bounded number of short pieces is remembered
between batches.  Offsets come from the lengths of the tokens in bytes and
from where characters begin; a token that holds part of a character spans it whole.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from skyfact.llm.shared import in_batches
from skyfact.llm.words import by_bytes, give_back

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Pieces that a task remembers, the characters that such a piece has at most, and words that the library gets as one text.
PIECES, PIECE_CHARS, JOINED = 1 << 18, 32, 1024
#: Characters of a part of a long text, about.
PART_CHARS = 1 << 18
#: One space between something and a letter: the match before ends there, the next begins with the space.
_BORDER = re.compile(r"(?<=\S) (?=[A-Za-z])")
#: Where a match ends in any case: before white space, and between a letter and a sign that is no apostrophe.
_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-&(-/:-@\[-`{-~])")
_SPACED_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The pair that merging by rank joins last to make the token; None if merging doesn't make it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 62:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts) if len(parts) == 2 else None


class Codec:
    """Encoder and decoder of one rank file.  All 256 bytes have to be tokens, so that any text has ids."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ranks = read_ranks(path)
        absent = [b for b in range(256) if bytes([b]) not in ranks]
        if absent:
            raise ValueError(f"{path} lacks the bytes {absent}")
        characters = byte_characters()
        shown = {token: "".join([characters[b] for b in token]) for token in ranks}
        pairs = [merge_of(token, ranks) for token in sorted(ranks, key=ranks.get) if len(token) > 1]
        # a match that is a token is taken as it is, also if merging doesn't make it
        model = BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=[(shown[a], shown[b]) for a, b in filter(None, pairs)], ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
        # the certain border is one of the public pattern; another pattern gets whole texts
        self.has_border = pattern == PATTERN
        self.pieces: dict[str, bytes] = {}
        of_character = {c: b for b, c in enumerate(characters)}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = bytes([of_character[c] for c in shown[token]])
        self.known = set(ranks.values())
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.table, self.ids = pa.array(self.bytes, pa.binary()), pa.array(sorted(self.known), pa.int32())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [_CUT.split(t) if self.has_border else [t] for t in texts]
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        known = self.pieces
        new = self._encode_pieces(list({p for c in cut for p in c if p not in known}))
        rows = [np.frombuffer(b"".join([known[p] if p in known else new[p] for p in c]), np.int32) for c in cut]
        known.update((p, ids) for p, ids in new.items() if len(p) <= PIECE_CHARS)
        return rows

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Piece -> its ids.  Words with a space before them are matches also behind each other, and go to the library so."""
        ids = lambda texts: [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        words = [p for p in pieces if self.has_border and _SPACED_WORD.fullmatch(p)]
        joined = ["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        flat = np.concatenate([np.zeros(0, np.int32), *ids(joined)])
        ends = np.cumsum([0, *[len(w.encode()) for w in words]])
        at = 4 * np.searchsorted(np.cumsum(self.lengths[flat]), ends, "right")
        raw = flat.tobytes()
        out = {w: raw[lo:hi] for w, lo, hi in zip(words, at[:-1].tolist(), at[1:].tolist())}
        rest = [p for p in pieces if p not in out]
        return out | {p: found.tobytes() for p, found in zip(rest, ids(rest))}

    def decode(self, ids) -> bytes:
        """The bytes of the ids.  An id that the file lacks raises."""
        table, known = self.bytes, self.known
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        unknown = [i for i in ids if i not in known]
        if unknown:
            raise ValueError(f"no such token: {unknown[:5]}")
        return b"".join([table[i] for i in ids])

    def decode_rows(self, rows: list[np.ndarray]) -> pa.Array:
        """The bytes of the ids of each row.  An id that the file lacks raises."""
        lists = _lists(rows, pa.int32())
        ids = lists.values
        wrong = pc.filter(ids, pc.invert(pc.is_in(ids, self.ids)))
        if len(wrong):
            raise ValueError(f"no such token: {wrong[:5].to_pylist()}")
        return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, self.table.take(ids)), b"")

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """First and past-the-last character of each token in its text."""
        data = np.frombuffer(text.encode(), np.uint8)
        # how many characters begin before each byte
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.cumsum(self.lengths[ids])
        first = begun[ends - self.lengths[ids] + 1] - 1
        return np.stack([first, begun[ends]], 1).astype(np.int32)

    def token_texts(self, ids) -> list[str]:
        """What each token adds to the text: a character that tokens share comes with the last of them.

        Bytes that begin no character become U+FFFD, and so do those that are left over at the end, with the last token.
        """
        reader = codecs.getincrementaldecoder("utf-8")(errors="replace")
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        out = [reader.decode(self.bytes[i]) for i in ids]
        if out:
            out[-1] += reader.decode(b"", True)
        return out


def text_parts(text: str, size: int = PART_CHARS) -> list[str]:
    """The text in parts of about ``size`` characters; their tokens are those of the text."""
    parts, start = [], 0
    while len(text) - start > size:
        border = _BORDER.search(text, start + size)
        if border is None:
            break
        parts.append(text[start : border.start()])
        start = border.start()
    parts.append(text[start:])
    return parts


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _lists(rows: list[np.ndarray], values: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *[r.reshape(-1) for r in rows]]).astype(np.int32)
    if values == pa.int32():
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
    pairs = pa.StructArray.from_arrays([pa.array(flat[0::2]), pa.array(flat[1::2])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN, offsets: bool = False) -> DataFrame:
    """(id, text) -> id, ids, and with ``offsets`` also start and end of each token, in characters, end exclusive.

    Null and empty texts have no ids.  Repeated rows and null ids give a row each; other columns are left out.
    """

    def run(batches):
        c = codec(ranks, pattern)
        for batch in batches:
            for part in by_bytes(batch):
                texts = [t or "" for t in part["text"].to_pylist()]
                rows = c.encode(texts)
                more = {"offsets": _lists([c.offsets(t, r) for t, r in zip(texts, rows)], pa.null())} if offsets else {}
                yield pa.RecordBatch.from_pydict({"id": part["id"], "ids": _lists(rows, pa.int32())} | more)
        give_back()

    shape = "id long, ids array<int>" + (", offsets array<struct<start: int, end: int>>" if offsets else "")
    return in_batches(_texts(docs)).mapInArrow(run, shape)


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """(id, ids) -> id, decoded (bytes), tokens (what each token adds to the text, shared characters with the last of them).

    Null ids give null; ids that the file lacks raise.  Joined, the tokens of a whole text are the text.
    """

    def run(batches):
        c = codec(ranks, pattern)
        for batch in batches:
            rows = batch["ids"].to_pylist()
            raw = pa.array([None if r is None else c.decode(r) for r in rows], pa.binary())
            tokens = pa.array([None if r is None else c.token_texts(r) for r in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch["id"], raw, tokens], ["id", "decoded", "tokens"])

    return in_batches(encoded.select(F.col("id").cast("long").alias("id"), "ids")).mapInArrow(run, "id long, decoded binary, tokens array<string>")


def round_trip(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """(id, text) -> id, ids, decoded: both directions in one pass over the texts."""

    def run(batches):
        c = codec(ranks, pattern)
        for batch in batches:
            for part in by_bytes(batch):
                rows = c.encode([t or "" for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([part["id"], _lists(rows, pa.int32()), c.decode_rows(rows)], ["id", "ids", "decoded"])
        give_back()

    return in_batches(_texts(docs)).mapInArrow(run, "id long, ids array<int>, decoded binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
