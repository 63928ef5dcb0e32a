"""Substring dedup by prefix-partitioned suffix trees.

A suffix is a document's word sequence from one position on.  Two windows of ``window`` words are
equal exactly if their suffixes meet in a suffix tree below a node of that depth, so only nodes at
that depth or deeper matter.  The work is dealt out as follows, over slices of documents of
bounded size:

1. *Pruning.*  Each window's least hashed k-gram is its anchor.  Equal windows have equal anchors,
   so a suffix whose anchor occurs in one slice only can meet no suffix of another slice.  The
   slices send their distinct anchors to groups, and get back those that others have too.  What
   repeats within a slice is found there, by sorting all its suffixes.
2. *Groups.*  The suffixes left are split by prefixes of variable length: short ones first, and
   those that would outgrow a group are lengthened, up to the window (``heavy_prefixes``).
3. *Subtrees.*  Each group sorts its suffixes, which is the subtree's leaf order; runs with the
   first ``window`` words in common are its deep internal nodes.  A node's leftmost occurrence is
   kept; slices with other leaves below the node learn that theirs are repeats.  A slice sends one
   leaf for a node whatever the number of its copies, so that no node outgrows a group.
4. Each slice marks the words under repeated windows; windows in a row make the maximal repeats.

Words are compared by a 64-bit hash, and windows by two hashes over those of their words.  The depth of all nodes that
matter is that of the window, so leaves are ordered by the windows' hashes in place of the words: the runs are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import in_batches, slices, text_size
from skyfact.llm.words import by_bytes, hash_words, member, plain_words, sequence_hashes, sliding_min, spans, text_bytes

WINDOW = 20
SLICE_BYTES = 8 << 20
LADDER = (1, 2, 4, 8, 16)
# A prefix is lengthened if at least this share of a batch's suffixes start with it.  At most its inverse
# such prefixes exist per length, which bounds the list that all tasks get.
HEAVY_SHARE = 1 / 256

_NO_ID = np.iinfo(np.int64).max


class _Slice:
    """Words and windows of a slice's documents, in order of (id, tie, text); null ids come last."""

    def __init__(self, docs: pa.Table, window: int):
        ids = docs["id"].combine_chunks()
        if "tie" not in docs.column_names:
            docs = docs.append_column("tie", pa.array(np.zeros(docs.num_rows, np.int64)))
        at = docs.append_column("_no", pa.array(np.asarray(ids.is_null()), pa.int8())).sort_by([("_no", "ascending"), ("id", "ascending"), ("tie", "ascending"), ("text", "ascending")])
        self.docs = at.drop_columns(["_no"])
        self.ties = np.asarray(at["tie"].combine_chunks(), np.int64)
        self.ids = np.asarray(at["id"].combine_chunks().fill_null(_NO_ID), np.int64)
        self.buf, self.offsets = text_bytes(at["text"])
        start, end, self.doc = spans(plain_words(self.buf), self.offsets)
        self.words = hash_words(self.buf, start, end)[0]
        self.span = (start, end)
        n = len(self.words) - window + 1
        self.at = np.flatnonzero(self.doc[: max(n, 0)] == self.doc[window - 1 :]) if n > 0 else np.zeros(0, np.int64)
        self.window = window

    def anchors(self) -> np.ndarray:
        k = max(1, self.window * 2 // 5)
        gram = sequence_hashes(self.words, (k,), 7)[0]
        return sliding_min(gram, self.window - k + 1)[self.at]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes for every window."""
        a = sequence_hashes(self.words, (self.window,))[0][self.at]
        b = sequence_hashes(self.words ^ np.uint64(0x5851F42D4C957F2D), (self.window,), 3)[0][self.at]
        return a, b

    def first_of_equals(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which windows are the first of their kind in the slice."""
        order = np.argsort(a, kind="stable")
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        first = np.ones(len(a), bool)
        first[order[1:]] = ~same
        return first


def _packed(groups: np.ndarray, slice_no: int, *columns: np.ndarray) -> pa.Table:
    """A row for each group, with the columns of its members as bytes."""
    order = np.argsort(groups, kind="stable")
    ordered = groups[order]
    cuts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(ordered)]
    data = {"grp": pa.array(ordered[cuts], pa.int64()), "slice": pa.array(np.full(len(cuts), slice_no), pa.int64())}
    for i, c in enumerate(columns):
        c = np.ascontiguousarray(c[order])
        data[f"c{i}"] = pa.array([c[x:y].tobytes() for x, y in zip(cuts, ends)], pa.binary())
    return pa.table(data)


def _unpacked(t: pa.Table, *kinds: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The slice of every member, and the columns."""
    cols = [t[f"c{i}"].to_pylist() for i in range(len(kinds))]
    size = np.array([len(x) // 8 for x in cols[0]], np.int64)
    return np.repeat(np.asarray(t["slice"], np.int64), size), [np.frombuffer(b"".join(c), k) for c, k in zip(cols, kinds)]


def _packed_schema(n: int) -> str:
    return "grp long, slice long, " + ", ".join(f"c{i} binary" for i in range(n))


def heavy_prefixes(docs: DataFrame, window: int = WINDOW, share: float = HEAVY_SHARE) -> dict[int, np.ndarray]:
    """For each length of the ladder, the hashes of prefixes that many suffixes start with.

    The batches name what is frequent among their suffixes, and counts are summed on Spark; at
    most 4 / share hashes of a length come back, whatever the size of the corpus.
    """

    def count(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            s = _Slice(pa.Table.from_batches([batch]), window)
            for length, h in zip(LADDER, sequence_hashes(s.words, LADDER)):
                values, n = np.unique(h[s.at], return_counts=True)
                often = n >= share / 2 * max(len(s.at), 1)
                yield pa.RecordBatch.from_pydict(
                    {"length": pa.array([length] * (often.sum() + 1), pa.int32()), "h": pa.array([None, *values[often].view(np.int64)], pa.int64()), "n": pa.array([len(s.at), *n[often]], pa.int64())}
                )

    counts = docs.mapInArrow(count, "length int, h long, n long").groupBy("length", "h").agg(F.sum("n").alias("n"))
    total = counts.filter("h IS NULL").select("length", F.col("n").alias("total"))
    often = counts.join(total, "length").filter((F.col("h").isNotNull()) & (F.col("n") >= F.col("total") * (share / 2)))
    found: dict[int, list[int]] = {}
    for r in often.select("length", "h").collect():
        found.setdefault(r.length, []).append(r.h)
    return {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in found.items()}


def _group_of(s: _Slice, at: np.ndarray, full: np.ndarray, heavy: dict[int, np.ndarray], n_groups: int) -> np.ndarray:
    """The group of each suffix: by its shortest prefix that isn't heavy."""
    out = full.copy()
    left = np.arange(len(at))
    # more groups than the list can tell apart need longer prefixes to begin with
    first = 0 if n_groups <= 1 << 12 else 1 if n_groups <= 1 << 20 else 2
    for length in [x for x in LADDER[first:] if x < s.window]:
        h = sequence_hashes(s.words, (length,))[0][at[left]]
        stays = ~member(h, heavy.get(length, np.zeros(0, np.uint64)))
        out[left[stays]] = h[stays]
        left = left[~stays]
    return (out % np.uint64(n_groups)).astype(np.int64)


def repeated_spans(docs: DataFrame, window: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document (id, text): n_words, n_removed, removed (word spans, end exclusive) and kept_text.

    A word is removed if a window of ``window`` words over it occurs earlier too: in a smaller id,
    or at an earlier place in the document; windows are those of the input.  kept_text has the other
    words, joined by one space.  Null and empty texts have no words; null ids come after all others;
    among equal ids the smaller text is the earlier, among equal rows any (the result is the same).
    Other columns are ignored.
    """
    docs = docs.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    docs = in_batches(docs)
    n = slices(text_size(docs), slice_bytes)
    heavy = heavy_prefixes(docs, window)
    # rows without an id are told apart by their text
    key = F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text"))), F.lit(n))
    tie = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    dealt = docs.select(key.alias("slice"), "id", tie.alias("tie"), "text")
    by_slice = lambda df: df.groupBy("slice")

    def anchors(key, t):
        s = _Slice(t, window)
        found = np.unique(s.anchors())
        return _packed((found % np.uint64(n)).astype(np.int64), key[0].as_py(), found)

    def shared(t):
        where, (keys,) = _unpacked(t, "<u8")
        order = np.argsort(keys, kind="stable")
        k, where = keys[order], where[order]
        same = k[1:] == k[:-1]
        many = np.r_[same, False] | np.r_[False, same]
        return _answer(where[many], k[many])

    def _answer(where, *cols):
        return _packed(where, 0, *cols).drop_columns(["slice"]).rename_columns(["slice", *[f"c{i}" for i in range(len(cols))]])

    def suffixes(key, t, answers):
        s = _Slice(t, window)
        a, b = s.keys()
        _, (known,) = _unpacked(answers, "<u8")
        sent = s.first_of_equals(a, b) & member(s.anchors(), np.sort(known))
        at = s.at[sent]
        return _packed(_group_of(s, at, a[sent], heavy, n), key[0].as_py(), a[sent], b[sent], s.ids[s.doc[at]].astype("<i8"), s.ties[s.doc[at]].astype("<i8"))

    def subtree(t):
        where, (a, b, first, tie) = _unpacked(t, "<u8", "<u8", "<i8", "<i8")
        leaves = np.lexsort((where, tie, first, b, a))
        a, b, where = a[leaves], b[leaves], where[leaves]
        deep = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        later = np.r_[False, deep]
        return _answer(where[later], a[later], b[later])

    def mark(t, answers):
        if not t.num_rows:
            return result.slice(0, 0)
        s = _Slice(t, window)
        a, b = s.keys()
        _, (ka, kb) = _unpacked(answers, "<u8", "<u8")
        again = ~s.first_of_equals(a, b) | _member2(a, b, ka, kb)
        return _marked(s, s.at[again])

    def _member2(a, b, ka, kb):
        order = np.argsort(ka)
        ka, kb = ka[order], kb[order]
        hit = np.flatnonzero(member(a, ka))
        out = np.zeros(len(a), bool)
        for _ in range(int(np.unique(ka, return_counts=True)[1].max()) if len(ka) else 0):
            at = np.searchsorted(ka, a[hit])
            out[hit] |= kb[np.minimum(at + _, len(kb) - 1)] == b[hit]
        return out

    def _marked(s, windows):
        depth = np.zeros(len(s.words) + 1, np.int64)
        np.add.at(depth, windows, 1)
        np.subtract.at(depth, windows + window, 1)
        gone = np.cumsum(depth[:-1]) > 0
        first = np.searchsorted(s.doc, np.arange(len(s.ids) + 1))
        rows = {"id": s.docs["id"], "n_words": [], "n_removed": [], "removed": [], "kept_text": []}
        raw = s.buf.tobytes()
        for i in range(len(s.ids)):
            lo, hi = first[i], first[i + 1]
            mask = gone[lo:hi]
            words = raw[s.offsets[i] : s.offsets[i + 1]].split()
            n_gone = int(mask.sum())
            edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0])).reshape(-1, 2) if n_gone else ()
            if n_gone:
                words = [w for w, x in zip(words, mask) if not x]
            rows["n_words"].append(int(hi - lo))
            rows["n_removed"].append(n_gone)
            rows["removed"].append([{"start": int(x), "end": int(y)} for x, y in edges])
            rows["kept_text"].append(b" ".join(words).decode())
        return pa.table(rows, schema=result.schema)

    result = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())]
    ).empty_table()

    asked = by_slice(dealt).applyInArrow(anchors, _packed_schema(1))
    common = asked.groupBy("grp").applyInArrow(shared, "slice long, c0 binary")
    leaves = by_slice(dealt).cogroup(by_slice(common)).applyInArrow(lambda key, t, x: suffixes(key, t, x) if t.num_rows else suffixes(key, t, x).slice(0, 0), _packed_schema(4))
    repeats = leaves.groupBy("grp").applyInArrow(subtree, "slice long, c0 binary, c1 binary")
    return by_slice(dealt).cogroup(by_slice(repeats)).applyInArrow(mark, "id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_text string")
