"""Merkle manifest of a dataset by bitmap-rank indexing.

Rows are leaves of a tree per group, in the order of their ids, and the groups' roots are leaves of a
tree above.  Where a leaf stands follows from bitmaps: each group has the set of its ids in words of 64 bits, of
which only those with a bit are kept, with the number of ids before each word as directory.  The place
of an id is that number and the bits below its own.  The words are merged by OR on the way to their shuffle,
and are at most as many as the ids; rows are never sorted.  Places give the run and the slot of every
leaf; a run's digests, keyed by slot, are put in an array and become one node of the next level.

Ids may repeat.  A word with more rows than bits has its rows numbered by id and leaf instead.  Hot
groups need no care: words, runs and nodes are many for them, and no step holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import stored
from skyfact.operators.joins import lookup_join
from skyfact.operators.numbering import assign_ids, sorted_table

FAN_OUT = 16
WORD_BITS = 6
_PART_BITS = 33
ABSENT = "-"


def field(c: Column) -> Column:
    """``-`` for null, else length in bytes, colon, value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(ABSENT))


def leaf(columns: list[Column]) -> Column:
    """Digest of a row: the fields one behind another."""
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, "").cast("binary"), 256)


def placed(leaves: DataFrame) -> DataFrame:
    """(group_no, id, leaf, ...) -> the same with place (0.. within the group, ids ascending, null first) and group_size.

    Rows with equal ids stand in the order of their leaves; equal leaves may change places.
    """
    rows = leaves.withColumn("word", F.shiftright(F.col("id").cast("long"), WORD_BITS))
    bit = f"CAST(coalesce(id, 0) & {(1 << WORD_BITS) - 1} AS INT)"
    words = rows.groupBy("group_no", "word").agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"), F.count("*").alias("n"))
    # the directory: how many rows are before each word, by ranges of words
    table = sorted_table(words, ["group_no", "word"], "merkle-words").withColumn("part", F.shiftright("_pos", _PART_BITS))
    parts = table.groupBy("part").agg(F.sum("n").alias("n"))
    # one row for each partition of the table
    starts = parts.select("part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("start"))
    within = F.expr("coalesce(sum(n) OVER (PARTITION BY part ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    directory = table.withColumn("within", within).join(F.broadcast(starts), "part").select("group_no", "word", "bits", "n", (F.col("start") + F.col("within")).alias("before"))
    directory = stored(directory, "merkle-directory")
    groups = stored(directory.groupBy("group_no").agg(F.min("before").alias("group_start"), F.sum("n").alias("group_size")), "merkle-groups")
    directory = lookup_join(directory, groups, ["group_no"]).select("group_no", "word", "bits", "n", (F.col("before") - F.col("group_start")).alias("before"), "group_size")
    repeated = F.col("n") > F.bit_count("bits")
    found = lookup_join(rows, stored(directory, "merkle-ranks"), ["group_no", "word"], null_safe=True)
    place = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(F.expr(f"~shiftleft(-1L, {bit})")))
    columns = [*leaves.columns, "place", "group_size"]
    single = found.filter(~repeated).withColumn("place", place.cast("long")).select(*columns)
    if directory.filter(repeated).isEmpty():
        return single
    several = assign_ids(found.filter(repeated).drop("bits", "n"), ["group_no", "id", "leaf"], "row_no", "merkle-repeated")
    firsts = stored(several.groupBy("group_no", "word").agg(F.min("row_no").alias("first_no")), "merkle-firsts")
    several = lookup_join(several, firsts, ["group_no", "word"], null_safe=True)
    return single.unionByName(several.withColumn("place", F.col("before") + F.col("row_no") - F.col("first_no")).select(*columns))


def _runs(nodes: DataFrame, members: list[str]) -> DataFrame:
    """Nodes (group_no, place, group_size, members) -> a row per run, with its members in an array by slot."""
    slot = F.col("place") % FAN_OUT
    keyed = nodes.groupBy("group_no", "group_size", F.floor(F.col("place") / FAN_OUT).alias("run")).agg(
        F.map_from_entries(F.collect_list(F.struct(slot.cast("int").alias("slot"), F.struct(*members).alias("member")))).alias("slots")
    )
    in_order = F.transform(F.sequence(F.lit(0), F.size("slots") - 1), lambda i: F.element_at("slots", i))
    return keyed.select("group_no", "group_size", "run", in_order.alias("members"))


def _above(runs: DataFrame) -> DataFrame:
    """The nodes that runs of digests become."""
    digest = _node(F.transform("members", lambda m: m["digest"]))
    return runs.select("group_no", F.ceil(F.col("group_size") / FAN_OUT).cast("long").alias("group_size"), F.col("run").alias("place"), digest.alias("digest"))


def grown(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Nodes (group_no, group_size, place, digest) -> (runs of each level, roots: group_no, level, digest).

    A group with one node has that as root, at level 0.  As many levels as the largest group asks for.
    """
    levels, roots, level = [], [], 0
    nodes = stored(nodes, f"{label}-nodes-0")
    while True:
        roots.append(nodes.filter("group_size = 1").select("group_no", F.lit(level).alias("level"), "digest"))
        more = nodes.filter("group_size > 1")
        if more.isEmpty():
            break
        levels.append(stored(_runs(more, ["digest"]), f"{label}-runs-{level}"))
        level += 1
        nodes = stored(_above(levels[-1]), f"{label}-nodes-{level}")
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return levels, stored(out, f"{label}-roots")


def _siblings(digests: Column, slot: Column) -> Column:
    """What stands left and right of a slot in its run."""
    left = F.array_join(F.slice(digests, F.lit(1), slot), "")
    right = F.array_join(F.slice(digests, slot + 2, F.size(digests)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def descended(levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """Runs of each level and roots (group_no, level, path, ...) -> the nodes of level 0 with their paths.

    (group_no, place, path, ...): a path has the siblings of each level from the node up, then that of the root.
    """
    more = [c for c in roots.columns if c not in ("group_no", "level", "path")]
    at = lambda level: roots.filter(F.col("level") == level).select("group_no", F.lit(0).cast("long").alias("run"), "path", *more)
    above = at(len(levels))
    for level in range(len(levels) - 1, -1, -1):
        digests = F.transform("members", lambda m: m["digest"])
        runs = levels[level].select("group_no", "run", digests.alias("digests")).join(above, ["group_no", "run"])
        nodes = runs.select("*", F.explode(F.sequence(F.lit(0), F.size("digests") - 1)).alias("slot"))
        path = F.concat(F.array(_siblings(F.col("digests"), F.col("slot"))), F.col("path"))
        above = nodes.select("group_no", (F.col("run") * FAN_OUT + F.col("slot")).alias("run"), path.alias("path"), *more).unionByName(at(level))
    return above.withColumnRenamed("run", "place")


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, digest, lambda d, p: F.sha2(F.concat(p["left"], d, p["right"]).cast("binary"), 256))


def manifest(leaves: DataFrame) -> DataFrame:
    """(id, source, leaf, ...) -> the same rows with subroot, root and path (siblings by level: left, right).

    Groups are the sources: null is one, and comes first; the others follow by their UTF-8 bytes.  Null ids come
    first in their group; repeated ids stand by their leaves.  Equal rows are leaves of their own.  An
    empty table gives an empty one.  Further columns stay, but not under the names used here: group_no,
    group_size, place, run, path, subroot, root.
    """
    rows = stored(leaves, "merkle-leaves")
    sources = stored(assign_ids(rows.select("source").distinct(), ["source"], "group_no", "merkle-sources"), "merkle-groups-no")
    numbered = lookup_join(rows, sources, ["source"], null_safe=True)
    kept = [c for c in leaves.columns]
    # level 0 holds the rows themselves, so that they go by their run and not once more by their id
    bottom = stored(_runs(placed(numbered), kept), "merkle-bottom")
    digests = F.transform("members", lambda m: m["leaf"])
    alone = F.col("group_size") == 1
    nodes = bottom.select(
        "group_no", F.ceil(F.col("group_size") / FAN_OUT).cast("long").alias("group_size"), F.col("run").alias("place"),
        F.when(alone, F.col("members")[0]["leaf"]).otherwise(_node(digests)).alias("digest"),
    )
    levels, subroots = grown(nodes, "merkle")
    n = subroots.count()
    tops = subroots.select(F.lit(0).cast("long").alias("group_no"), F.lit(n).cast("long").alias("group_size"), (F.col("group_no") - 1).alias("place"), "digest")
    top_levels, root = grown(tops, "merkle-top")
    empty = F.array().cast("array<struct<left: string, right: string>>")
    top_paths = descended(top_levels, root.select("group_no", "level", empty.alias("path"), F.col("digest").alias("root")))
    roots = subroots.join(top_paths.select((F.col("place") + 1).alias("group_no"), "path", "root"), "group_no")
    paths = descended(levels, stored(roots.withColumnRenamed("digest", "subroot"), "merkle-subroots"))
    joined = bottom.join(stored(paths, "merkle-paths").withColumnsRenamed({"place": "run", "path": "upper"}), ["group_no", "run"])
    out = joined.select("*", digests.alias("digests"), F.posexplode("members").alias("slot", "member"))
    own = F.array(_siblings(F.col("digests"), F.col("slot")))
    return out.select("member.*", "subroot", "root", F.when(alone, F.col("upper")).otherwise(F.concat(own, F.col("upper"))).alias("path"))
