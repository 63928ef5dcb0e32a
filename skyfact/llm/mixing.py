"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix goes to the source in whose share of [0, 1) the i-th point of the golden-ratio
sequence falls, so that every stretch of the mix has the sources in their proportions.  A source's
slots are numbered, and its documents, shuffled by a digest, are laid out twice behind each other
on a line of tokens (two passes, each in an order of its own) and cut into blocks of equally many
tokens; the r-th slot takes the r-th block.

Ranks and places on the line are running sums.  Both are taken in two levels, over chunks of about
``CHUNK_ROWS`` rows and over the sums of the chunks, so that a source with most of the rows is dealt
out as any other.  Points and digests are integers, hence the mix is the same on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfact.llm.shared import picked, stored
from skyfact.operators.joins import lookup_join

BLOCK = 32
SHARE = 1.5
PASSES = 2
WEIGHTS = (5, 2, 1)
CHUNK_ROWS = 4096
#: 2**32 divided by the golden ratio, made odd: the sequence i * STEP mod 2**32.
STEP, POINTS = 2654435769, 1 << 32
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, size) -> no (0.. by code point, null last), source, size, weight, target.

    Targets are w * level, and passes * size where that is less; the level fills them to ``share`` of
    all sizes.  In order of passes * size / w the full sources come first, so one running sum finds it.
    One row per source comes in: the sources of a mix are few.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    no = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights)).cast("int") + 1).cast("long")
    rows = sizes.withColumn("no", no).withColumn("weight", weight).withColumn("cap", F.col("size") * passes)
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), "no")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (
        rows.withColumn("total", F.sum("size").over(everything) * F.lit(float(share)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # the first source in this order that isn't full sets the level
    open_ = F.col("cap") * F.col("rest") > F.col("left") * F.col("weight")
    level = F.min_by(F.struct("left", "rest"), F.when(open_, F.struct(F.col("cap") / F.col("weight"), F.col("no")))).over(everything)
    rows = rows.withColumn("level", level)
    full = F.col("level").isNull() | (F.col("cap") * F.col("level.rest") <= F.col("level.left") * F.col("weight"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("level.left") * F.col("weight") / F.col("level.rest"))
    return rows.select("no", "source", "size", "weight", target.alias("target"))


def shares(targets: DataFrame) -> DataFrame:
    """Adds since, upto (the part of the points that falls to each source, end exclusive) and all, the sum of the targets."""
    by_no = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = targets.withColumn("upto", F.sum("target").over(by_no)).withColumn("all", F.sum("target").over(everything))
    upto = F.floor(F.try_divide(F.col("upto"), F.col("all")) * POINTS)
    return sums.withColumn("upto", F.coalesce(upto, F.lit(0))).withColumn("since", F.coalesce(F.lag("upto").over(Window.orderBy("no")), F.lit(0)))


def _running(df: DataFrame, keys: list[str], order: list[str], chunk: str, size: str, name: str) -> DataFrame:
    """Sum of ``size`` over the earlier rows of the same keys; chunks follow each other in ``order``."""
    sums = df.groupBy(*keys, chunk).agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, chunk, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return local.join(starts, [*keys, chunk]).withColumn(name, F.col("_start") + F.col("_local")).drop("_start", "_local", chunk)


def schedule(sources: DataFrame, n: int) -> DataFrame:
    """Sources (no, since, upto: their part of the points) -> slot, no, rank: which block of which source each of n slots takes.

    The points are cut into cells, several for each source on average, and meet the sources in their cell; so
    slots and sources meet about once each, however many sources there are and however small they get.
    """
    bits = min(31, max(4, (4 * max(1, sources.count())).bit_length()))
    cell = lambda point: F.shiftright(point, 32 - bits)
    parts = sources.filter("upto > since").withColumn("cell", F.explode(F.sequence(cell(F.col("since")), cell(F.col("upto") - 1))))
    point = F.pmod(F.pmod(F.col("slot") + 1, F.lit(POINTS)) * F.lit(STEP), F.lit(POINTS))
    slots = sources.sparkSession.range(n).withColumnRenamed("id", "slot").withColumn("point", point).withColumn("cell", cell(F.col("point")))
    met = lookup_join(slots, stored(parts.select("no", "since", "upto", "cell"), "mix-cells"), ["cell"], "inner")
    dealt = met.filter((F.col("point") >= F.col("since")) & (F.col("point") < F.col("upto"))).select("slot", "no")
    dealt = dealt.withColumn("chunk", F.floor(F.col("slot") / CHUNK_ROWS)).withColumn("one", F.lit(1).cast("long"))
    return _running(stored(dealt, "mix-slots"), ["no"], ["slot"], "chunk", "one", "rank").drop("one")


def laid_out(docs: DataFrame, seed: str = "mix", passes: int = PASSES) -> DataFrame:
    """(no, id, size, digest, n_chunks) -> the same with at_0, at_1: where each pass has the document on its source's line."""
    for k in range(passes):
        key = F.md5(F.concat_ws(":", F.lit(f"{seed}{k}"), F.coalesce(F.col("id").cast("string"), F.lit("null")).cast("binary")))
        docs = docs.withColumn("_key", key)
        # chunks are ranges of the key, so they keep its order
        chunk = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.col("n_chunks") / (1 << 32))
        docs = _running(docs.withColumn("_chunk", chunk), ["no"], ["_key", "size", "digest"], "_chunk", "size", f"at_{k}").drop("_key")
    return docs


def mix(docs: DataFrame, block: int = BLOCK, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Documents (id, source, size, digest) -> (placed documents, mix).

    Placed documents have all rows, with no, source_size, target, at_0 and at_1.  The mix has a row
    for each piece of a document in a slot: slot, no, rank, pass, at_0, id, start, end (words of the
    document, end exclusive); no document is in more than its two passes.  A row is known by no and
    at_0 if its size isn't 0; documents without words are in no slot.

    Null sources are a source, ordered last; null ids are ids; equal ids are told apart by size and
    digest, and equal rows may change places.  An empty table gives empty frames.
    """
    # sizes come from a scan of whole texts; they are counted once
    docs = stored(docs.select(F.col("id").cast("long").alias("id"), "source", F.col("size").cast("long").alias("size"), "digest"), "mix-sizes")
    sizes = stored(docs.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n_docs")), "mix-sums")
    chunks = sizes.select(F.col("source").alias("_source"), F.ceil(F.col("n_docs") / CHUNK_ROWS).alias("n_chunks"))
    shared = shares(source_targets(sizes.drop("n_docs"), share, weights))
    # a row for each source, stored, so that its windows are no part of the plans to come
    sources = stored(shared.join(chunks, F.col("_source").eqNullSafe(F.col("source"))).drop("_source"), "mix-sources")
    n = sources.agg(F.max("all")).first()[0]
    placed = lookup_join(docs, sources.select("source", "no", F.col("size").alias("source_size"), "target", "n_chunks"), ["source"], "inner", null_safe=True)
    placed = stored(laid_out(placed, seed), "mix-placed")
    lines = placed.filter(F.col("size") > 0).select(
        "no", "id", "size", "at_0", F.explode(F.array(*[F.struct(F.lit(k).alias("pass"), (F.col(f"at_{k}") + F.col("source_size") * k).alias("at")) for k in range(PASSES)])).alias("p")
    ).select("no", "id", "size", "at_0", "p.*")
    blocks = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))
    pieces = lines.withColumn("rank", F.explode(blocks))
    start = F.greatest(F.col("rank") * block - F.col("at"), F.lit(0))
    end = F.least((F.col("rank") + 1) * block - F.col("at"), F.col("size"))
    slots = schedule(sources.select("no", "since", "upto"), int((n or 0) / block + 0.5))
    mixed = pieces.join(slots, ["no", "rank"]).select("slot", "no", "rank", "pass", "at_0", "id", start.alias("start"), end.alias("end"))
    return placed, mixed


def taken(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every document with the number of words that the mix takes of it, repeats counted."""
    sums = mixed.groupBy("no", "at_0").agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
    n = F.when(F.col("size") > 0, F.coalesce(F.col("taken"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    return placed.join(sums, ["no", "at_0"], "left").withColumn("taken", n)


def excerpts(docs: DataFrame, placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Documents (doc_id, text, source, n_chars, ...) -> a row for each pass that takes words of one.

    A document of which a pass takes all words keeps its text; else it has those words, joined by one space.
    """
    spans = stored(mixed.groupBy("no", "at_0", "pass").agg(F.min("start").alias("start"), F.max("end").alias("end")), "mix-spans")
    rows = placed.filter("size > 0").select("no", "at_0", F.col("id").alias("doc_id"), "source", "digest", "size")
    counts = rows.groupBy("doc_id", "source", "digest").agg(F.count("*").alias("_n")).withColumnsRenamed({c: f"k_{c}" for c in ("doc_id", "source", "digest")})
    same = F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & F.col("source").eqNullSafe(F.col("k_source")) & (F.col("digest") == F.col("k_digest"))
    takes = rows.join(spans, ["no", "at_0"]).join(counts, same).select("doc_id", "source", "digest", "_n", "at_0", "pass", "start", "end", "size")
    out = picked(docs.withColumn("digest", F.xxhash64("text")), takes, ["doc_id", "source", "digest"])
    whole = (F.col("start") == 0) & (F.col("end") == F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")), " ")
    out = out.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    return out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)
