"""SentencePiece encoding and decoding with a forward pass over a trie of marked words.

A text is cut into marked words: a run of spaces, written U+2581, and what follows up to the next
space.  No piece reaches over their borders, so each word is encoded on its own, and each distinct
word once per batch.  Sorted words are the depth-first order of their trie: a word takes over the
forward states of the prefix that it shares with the word before.

The forward state of a prefix is the last piece of its best segmentation.  For a model of merge
ranks, as the public vocabularies here are, the segmentation of a prefix is that of a shorter prefix and
one more piece, and exactly one piece fits: the one that merging leaves apart from the piece before.
So the pass needs only the prefix, as in Viterbi's algorithm, and gives the pieces that merging gives;
sums of the ranks, which are no probabilities, would not.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import in_batches
from skyfact.llm.words import by_bytes, give_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Distinct words that a task keeps encoded, and pairs of pieces that a worker remembers.
CACHE_WORDS, CACHE_PAIRS = 150_000, 200_000


class Codec:
    """Encoder and decoder of one model file, with identity normalisation and byte fallback."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special(i) and not sp.is_byte(i)}
        self.rank = {p: (-sp.get_score(i), i) for p, i in self.ids.items()}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.bytes = [b"" if special(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        # pieces by their characters from the last to the first; "" marks the id of a piece
        self.endings: dict = {}
        for piece, i in self.ids.items():
            node = self.endings
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = i
        self.size = n
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.apart: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging the best ranked neighbours first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = min(((self.rank[x + y][0], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in self.rank), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def stays_apart(self, before: int, piece: int) -> bool:
        """Whether merging leaves the two as they are.  Numbers from ``size`` on are characters without a piece; -1 is none."""
        strings = [self.pieces[i] if i < self.size else chr(i - self.size) for i in (before, piece) if i >= 0]
        fits = self.apart[before << 32 | piece] = self.merged("".join(strings)) == strings
        return fits

    def encode_words(self, words) -> dict[str, bytes]:
        """Ids of distinct marked words, four bytes each, by one depth-first pass over their trie."""
        out: dict[str, bytes] = {}
        endings, apart, size = self.endings, self.apart, self.size
        # for each prefix of the word: its last piece, and where that begins
        last, begin = [-1], [0]
        before = ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, start = endings, end
                while True:
                    start -= 1
                    node = node.get(word[start]) if start >= 0 else None
                    if node is None:  # no piece ends here that fits
                        start, piece = end - 1, size + ord(word[end - 1])
                        break
                    piece = node.get("")
                    if piece is not None:
                        fits = apart.get(last[start] << 32 | piece)
                        if fits is None:
                            fits = self.stays_apart(last[start], piece)
                        if fits:
                            break
                last.append(piece)
                begin.append(start)
            ids, at = [], len(word)
            while at:
                piece = last[at]
                if piece < size:
                    ids.append(piece)
                else:
                    ids += self.character_ids(chr(piece - size))[::-1]
                at = begin[at]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            before = word
        return out

    def character_ids(self, char: str) -> list[int]:
        """Byte pieces of a character that has no piece, or the unknown id."""
        return [self.byte[b] for b in char.encode()] if self.byte else [self.unknown]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [marked_words(t) for t in texts]
        new = {w for words in cut for w in words if w not in self.cache}
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = {}
            new = {w for words in cut for w in words}
        if len(self.apart) > CACHE_PAIRS:
            self.apart = {}
        self.cache.update(self.encode_words(new))
        cache = self.cache
        return [np.frombuffer(b"".join([cache[w] for w in words]), np.int32) for words in cut]

    def decode(self, ids) -> bytes:
        """UTF-8 of the pieces, without the mark that encoding puts in front; unknown ids raise."""
        table = self.bytes
        return b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])[1:]

    def forget(self) -> None:
        """Drop the words of a task that has ended; its worker goes on to other work."""
        self.cache = {}
        give_back()


def marked_words(text: str) -> list[str]:
    """Cut in front of each run of marks; a mark is put in front of the text."""
    if not text:
        return []
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return [SPACE + p for p in parts]
    words, marks = [], ""
    for p in parts:
        marks += SPACE
        if p:
            words.append(marks + p)
            marks = ""
    return words + [marks] if marks else words


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _ids_array(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(id, text) -> id, ids.  Null and empty texts have no ids; a U+2581 in a text counts as a space."""

    def run(batches):
        c = codec(model)
        for batch in batches:
            for part in by_bytes(batch):
                yield pa.RecordBatch.from_arrays([part["id"], _ids_array(c.encode([t or "" for t in part["text"].to_pylist()]))], ["id", "ids"])
        c.forget()

    return in_batches(_text(docs)).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(id, ids) -> id, text.  Null ids give null; bytes that are no UTF-8 become U+FFFD."""

    def run(batches):
        c = codec(model)
        for batch in batches:
            texts = [None if x is None else c.decode(x).decode(errors="replace") for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select(F.col("id").cast("long").alias("id"), "ids").mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(id, text) -> id, ids, decoded: both directions in one pass over the texts."""

    def run(batches):
        c = codec(model)
        for batch in batches:
            for part in by_bytes(batch):
                rows = c.encode([t or "" for t in part["text"].to_pylist()])
                texts = [c.decode(r).decode(errors="replace") for r in rows]
                yield pa.RecordBatch.from_arrays([part["id"], _ids_array(rows), pa.array(texts, pa.string())], ["id", "ids", "decoded"])
        c.forget()

    return in_batches(_text(docs)).mapInArrow(run, "id long, ids array<int>, decoded string")
