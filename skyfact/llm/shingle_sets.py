"""Near-duplicates by SimHash with pigeonring filtering, with exact similarity of shingle sets behind it.

A text is the set of its five-word shingles, and two texts are linked where the sets' intersection is
at least 0.8 of their union.  Each set has a SimHash fingerprint.  Sets whose fingerprints differ in at
most two bits are found by the pigeonring (``simhash.links``) and are linked where their similarity holds.

Similar sets often differ in more bits than segments can be searched for, so a prefix-filtered join finds
what these links have not joined.  Sets of n shingles that are so similar share at least ceil(0.8 n) of
them, so in any common order of all shingles one of the first n - ceil(0.8 n) + 1 is shared.  Rarest
first is the order here: shingles of one set only come before all others, can't be shared, and are
never listed, so only sets of which nearly all is found elsewhere have a prefix to be compared.

All sets with a shingle in their prefix meet in its bucket.  In large buckets each member is first compared
with one of about its size.  What fingerprints and these link is a component, and then all pairs of different
components that meet in a bucket are compared.  Nothing is capped or estimated: the components are
those of all pairs.  Equality of shingles and of whole sets is that of 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm import simhash
from skyfact.llm.components import components
from skyfact.llm.shared import in_batches, slices, stored, text_size
from skyfact.llm.words import by_bytes, give_back, hash_words, plain_words, sequence_hashes, spans, text_bytes

SHINGLE = 5
#: Of the texts whose shingles are dealt to one part, and of those that are dealt out at a time.
PART_BYTES, DEAL_BYTES = 32 << 20, 4 << 20
BUCKET = 64

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE):
    """Sorted hashes of the distinct shingles of each text; fewer words make one shingle, none an empty set."""
    buf, offsets = text_bytes(column)
    buf = _LOWER[buf]
    start, end, doc = spans(plain_words(buf), offsets)
    hashes = hash_words(buf, start, end)[0]
    ends = np.searchsorted(doc, np.arange(len(column) + 1))
    for lo, hi in zip(ends[:-1], ends[1:]):
        k = min(shingle, hi - lo)
        yield np.unique(sequence_hashes(hashes[lo:hi], (k,))[0][: hi - lo - k + 1]) if k else np.zeros(0, np.uint64)


def _named(one: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(one.tobytes())


def set_names(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, digest, text) -> id, digest, set (hash of the set of shingles), n (its size), fp (its SimHash fingerprint)."""

    def run(batches):
        for batch in (part for b in batches for part in by_bytes(b)):
            names, sizes, prints = zip(*[(_named(s), len(s), simhash.set_fingerprint(s)) for s in shingle_sets(batch["text"], shingle)])
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["digest"], signed(names), pa.array(sizes, pa.int64()), signed(prints)], ["id", "digest", "set", "n", "fp"])
        give_back()

    rows = docs.select(F.col("id").cast("long").alias("id"), "digest", F.col("text").cast("string").alias("text"))
    return in_batches(rows).mapInArrow(run, "id long, digest long, set long, n long, fp long")


def _dealt(docs: DataFrame, parts: int, shingle: int) -> DataFrame:
    """Shingles in parts by their hash: part, sets (names), counts (shingles of each), tokens (their hashes)."""

    def flush(held: dict[int, np.ndarray]):
        names = np.array(list(held), np.uint64)
        tokens = np.concatenate(list(held.values()))
        owner = np.repeat(np.arange(len(held)), [len(s) for s in held.values()])
        part = tokens % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        tokens, owner = tokens[order], owner[order]
        present, first = np.unique(part[order], return_index=True)
        out = []
        for lo, hi in zip(first, np.r_[first[1:], len(order)]):
            who, counts = np.unique(owner[lo:hi], return_counts=True)
            out.append((names[who].tobytes(), counts.astype("<u4").tobytes(), tokens[lo:hi].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), *[pa.array(c, pa.binary()) for c in zip(*out)]], ["part", "sets", "counts", "tokens"])

    def run(batches):
        held, size = {}, 0
        for batch in (part for b in batches for part in by_bytes(b)):
            for one in shingle_sets(batch["text"], shingle):
                if len(one):
                    held[_named(one)] = one
            size += batch["text"].nbytes
            if size >= DEAL_BYTES and held:
                yield flush(held)
                held, size = {}, 0
        if held:
            yield flush(held)
        give_back()

    return in_batches(docs.select(F.col("text").cast("string").alias("text"))).mapInArrow(run, "part int, sets binary, counts binary, tokens binary")


def _found_twice(table: pa.Table) -> pa.Table:
    """The shingles of a part that several sets have: set, token, df (how many have it)."""
    read = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
    names, tokens = np.repeat(read("sets", "<i8"), read("counts", "<u4")), read("tokens", "<i8")
    # what is found once is left out before names are looked at
    order = np.argsort(tokens)
    again = np.diff(tokens[order]) == 0
    order = order[np.r_[again, False] | np.r_[False, again]] if len(order) else order
    names, tokens = names[order], tokens[order]
    order = np.lexsort((names, tokens))
    names, tokens = names[order], tokens[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (names[1:] != names[:-1])
    names, tokens = names[new], tokens[new]
    _, which, df = np.unique(tokens, return_inverse=True, return_counts=True)
    df = df[which]
    out = df > 1
    give_back()
    return pa.table({"set": names[out], "token": tokens[out], "df": df[out].astype(np.int64)})


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) whose sets have an intersection of 0.8 of the union; shingles of one set only are in no intersection."""
    side = lambda c: sets.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"tokens_{c}"))
    both = pairs.join(side("u"), "u").join(side("v"), "v")
    return both.filter(9 * F.size(F.array_intersect("tokens_u", "tokens_v")) >= 4 * (F.col("n_u") + F.col("n_v"))).select("u", "v")


def near_prints(names: DataFrame) -> DataFrame:
    """Pairs (u, v) of sets that join all sets whose fingerprints differ in at most ``simhash.MAX_DIFF`` bits."""
    known = names.groupBy("set").agg(F.first("fp").alias("fp"))
    prints = stored(known.groupBy("fp").agg(F.min("set").alias("leader")), "shingle-prints")
    equal = known.join(prints, "fp").filter("set <> leader").select(F.col("leader").alias("u"), F.col("set").alias("v"))
    leader = lambda c: prints.select(F.col("fp").alias(c), F.col("leader").alias(f"set_{c}"))
    near = simhash.links(prints.select("fp")).join(leader("u"), "u").join(leader("v"), "v").select("set_u", "set_v")
    return equal.unionAll(near).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def links(docs: DataFrame, names: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """(text), and its set names -> edges (u, v) between sets; their components are those of all similar pairs."""
    spark = docs.sparkSession
    parts = max(slices(text_size(docs), PART_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), 256))
    shared = _dealt(docs, parts, shingle).groupBy("part").applyInArrow(_found_twice, "set long, token long, df long")
    # bit i is the parity of the tokens that fall to it: as many bits differ between two sets as tokens do, or fewer
    bit = F.expr("shiftleft(1L, CAST(token & 63 AS INT))")
    parity = [F.coalesce(F.bit_xor(F.when(F.shiftright("token", 6).bitwiseAND(1) == w, bit)), F.lit(0)).alias(f"b{w}") for w in (0, 1)]
    listed = shared.groupBy("set").agg(F.collect_list(F.struct("df", "token")).alias("tokens"), *parity)
    need = F.expr("(4 * n + 4) div 5")
    listed = listed.join(names.groupBy("set").agg(F.first("n").alias("n")), "set").filter(F.size("tokens") >= need)
    sets = stored(listed.select("set", "n", "b0", "b1", F.array_sort("tokens")["token"].alias("tokens")), "shingle-sets")
    m = F.size("tokens")
    prefix = sets.select("set", "n", "b0", "b1", m.alias("m"), F.posexplode(F.slice("tokens", F.lit(1), (m - need + 1).cast("int"))).alias("at", "token"))
    prefix = stored(prefix, "shingle-prefixes")
    size = stored(prefix.groupBy("token").agg(F.count("*").alias("size")).filter(F.col("size") > bucket), "shingle-buckets")
    about = F.floor(F.log("n") / math.log(1.25))
    sized = prefix.join(size, "token").withColumn("about", about)
    leaders = sized.groupBy("token", "about").agg(F.min_by("set", F.xxhash64("set", "token")).alias("leader"))
    stars = sized.join(leaders, ["token", "about"]).filter("set <> leader").select(F.least("set", "leader").alias("u"), F.greatest("set", "leader").alias("v"))
    first = stored(_similar(near_prints(names).unionAll(stars).distinct(), sets), "shingle-links")
    # the rest of the buckets: only what the first links have not joined
    found = components(first, "shingle-first")
    grouped = prefix.join(found, F.col("set") == F.col("node"), "left").select(*prefix.columns, F.coalesce("root", "set").alias("root"))
    mixed = grouped.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    members = stored(grouped.join(mixed, "token"), "shingle-mixed")
    a, b = members.alias("a"), members.alias("b")
    # what both may share up to here, and behind
    most = F.least("a.at", "b.at") + 1 + F.least(F.expr("a.m - a.at - 1"), F.expr("b.m - b.at - 1"))
    fits = (5 * F.least("a.n", "b.n") >= 4 * F.greatest("a.n", "b.n")) & (9 * most >= 4 * (F.col("a.n") + F.col("b.n")))
    # tokens that only one of the two has are m + m - 2 * intersection, so at most this many bits may differ
    differ = F.bit_count(F.col("a.b0").bitwiseXOR(F.col("b.b0"))) + F.bit_count(F.col("a.b1").bitwiseXOR(F.col("b.b1")))
    near = 9 * differ <= 9 * (F.col("a.m") + F.col("b.m")) - 8 * (F.col("a.n") + F.col("b.n"))
    apart = (F.col("a.set") < F.col("b.set")) & (F.col("a.root") != F.col("b.root"))
    rest = a.join(b, (F.col("a.token") == F.col("b.token")) & apart & fits & near).select(F.col("a.set").alias("u"), F.col("b.set").alias("v")).distinct()
    return first.unionAll(stored(_similar(rest, sets), "shingle-rest"))


def groups(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """(id, digest, text) -> id, digest, root: the rows of a root are linked by similar pairs, and no others are.

    Every row stays; null, empty and wordless texts are one group.
    """
    names = stored(set_names(docs, shingle), "shingle-names")
    found = components(links(docs, names, shingle, bucket), "shingle-components")
    return names.join(found, F.col("set") == F.col("node"), "left").select("id", "digest", F.coalesce("root", "set").alias("root"))
