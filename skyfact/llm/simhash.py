"""SimHash near-dedup with pigeonring filtering.

Fingerprints are cut into a ring of SEGMENTS segments.  If two differ in at most t bits, some segment
starts a chain around the ring whose first l segments together differ in at most l * t / SEGMENTS
bits, for every l (the strong form of the pigeonhole principle).  With t = 2 and three segments the
chain begins with equal segments, its second sum is at most 1 and its third at most 2.

Equal documents are one fingerprint.  Fingerprints that share a segment meet in a bucket; pairs in it
are held against the chain's budgets first and compared in all bits only then.  Buckets with more
than BUCKET members are refined along the chain instead: where the rest differs in at most t = 2 bits,
both have a common neighbour at one bit or less, so they meet under the same segment and that
neighbour, all members of such a meeting are links of each other or through it, and a star to the least
replaces its pairs.  Nothing is capped: both ways give all links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.components import components
from skyfact.llm.shared import in_batches, stored
from skyfact.llm.words import by_bytes, give_back

SHINGLE = 3
SEED = 42
MAX_DIFF = 2
#: Width of each segment of the ring, from the lowest bits.
SEGMENTS = (21, 21, 22)
BUCKET = 64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PART = 1 << 16


def majority(parts, n: int) -> int:
    """The bits that are set in over half of n 64-bit hashes, which come in arrays; of none, zero."""
    ones = np.zeros(64, np.int64)
    for hashes in parts:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def set_fingerprint(hashes: np.ndarray) -> int:
    """Fingerprint of a set of shingles, from their hashes."""
    return majority((hashes[lo : lo + _PART] for lo in range(0, len(hashes), _PART)), len(hashes))


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 of all shingles; fewer words make one shingle, none give zero."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    n = len(words) - k + 1
    view, h = memoryview(text), xxhash.xxh64_intdigest
    parts = ((lo, min(n, lo + _PART)) for lo in range(0, n, _PART))
    return majority((np.array([h(view[a:b], SEED) for a, b in zip(starts[lo:hi].tolist(), ends[lo + k - 1 : hi + k - 1].tolist())], "<u8") for lo, hi in parts), n)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, text) -> id, fingerprint (long, its bits).  Whole texts; null counts as empty."""

    def run(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            out = [fingerprint((t or b"").translate(_LOWER).split(), shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(out, np.uint64).view(np.int64))], ["id", "fingerprint"])
        give_back()

    return in_batches(docs).select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "id long, fingerprint long")


def _segment(bits, k: int):
    return F.shiftrightunsigned(bits, sum(SEGMENTS[:k])).bitwiseAND((1 << SEGMENTS[k]) - 1)


def _chain_holds(diff, first: int):
    """Whether the chain that starts at segment ``first`` stays within its budgets."""
    ring = [(first + i) % len(SEGMENTS) for i in range(len(SEGMENTS))]
    total, ok = F.lit(0), F.lit(True)
    for n, k in enumerate(ring, 1):
        total = total + F.bit_count(_segment(diff, k))
        ok = ok & (total <= n * MAX_DIFF // len(SEGMENTS))
    return ok


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) that link all that differ in at most MAX_DIFF bits.

    The edges have the components of all such links; in a refined bucket a star stands for its pairs.
    """
    n = len(SEGMENTS)
    segs = prints.select("fp", F.posexplode(F.array(*[_segment(F.col("fp"), k) for k in range(n)])).alias("seg", "value"))
    size = segs.groupBy("seg", "value").agg(F.count("*").alias("n"))
    small = segs.join(size.filter(F.col("n").between(2, bucket)).drop("n"), ["seg", "value"])
    large = segs.join(size.filter(F.col("n") > bucket).drop("n"), ["seg", "value"])
    a, b = small.alias("a"), small.alias("b")
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    chain = F.lit(False)
    for k in range(n):
        chain = chain | ((F.col("a.seg") == k) & _chain_holds(diff, k))
    met = (F.col("a.seg") == F.col("b.seg")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.fp") < F.col("b.fp"))
    pairs = a.join(b, met & chain).filter(F.bit_count(diff) <= MAX_DIFF).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    # the segment is fixed, one bit at most of the others turned
    low = [sum(SEGMENTS[:k]) for k in range(n + 1)]
    turned = [F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64) if not low[k] <= i < low[k + 1]]) for k in range(n)]
    flips = F.when(F.col("seg") == 0, turned[0]).when(F.col("seg") == 1, turned[1]).otherwise(turned[2])
    meets = large.select("seg", "fp", F.explode(flips).alias("flip")).select("seg", F.col("fp").bitwiseXOR(F.col("flip")).alias("meet"), "fp")
    groups = meets.groupBy("seg", "meet").agg(F.min("fp").alias("u"), F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    stars = groups.select("u", F.explode("all").alias("v")).filter("u <> v")
    return pairs.unionAll(stars).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, text) -> id, fingerprint (16 hex digits), component_id (least id that can be reached by links).

    Links join fingerprints that differ in at most MAX_DIFF bits; null, empty and wordless texts have
    fingerprint zero and are linked as any other.  Null ids get a row, but never name a component
    unless it has no other id.  Repeated rows stay.  An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least")), "simhash-distinct")
    found = components(links(distinct.select("fp")), "simhash-components")
    named = stored(distinct.join(found, distinct.fp == found.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "simhash-roots")
    # both sides of the join are tables, so that Spark can split the rows of a large component
    names = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    by_print = named.join(names, "root").select("fp", "component_id")
    return prints.join(by_print, prints.fingerprint == by_print.fp).select("id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
