"""Secret scans by multipart credential linking.  DataFrame expressions only.

Parts of credentials come in three roles: access identifiers, secrets, and endpoints.  Strong parts
are secrets or identifiers by their own form.  Weak ones (a user or client name, 40 characters of base64, a
URL with a port or path) mean little alone, and are reported only when parts of the complementary roles
begin within REACH characters in the same text: a name near a secret, a bare secret near an
identifier, an endpoint near both.

Texts are read once.  What a pattern finds is kept as lengths of matches and gaps, of which running sums give
the places.  The link is an interval join: parts fall into cells of REACH characters; of each cell
only the first and the last part of a role is kept, which decides for any place in the cell and
the next to it, so a text with very many parts is joined without pairing them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfact.llm.shared import stored

REACH = 200

# The patterns of the strong kinds, in their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
STRONG = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
LEAST_VALUE = 6
# The weak kinds, in their order behind the strong ones.
WEAK = {
    "name": r"""(?i:user|username|login|client_id|account_id|key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,64}""",
    "bare": r"[A-Za-z0-9+/]{40,88}={0,2}",
    "endpoint": r"(?i:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._-]+(?::[0-9]{2,5})?(?:/[A-Za-z0-9._/-]*)?",
}
KINDS = [*STRONG, *WEAK]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "name": "identifier", "bare": "secret", "endpoint": "endpoint"}
NEEDS = {"name": ["secret"], "bare": ["identifier"], "endpoint": ["identifier", "secret"]}


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Per match: how many characters lie between it and the one before, its length, and whether it counts."""
    p = F.lit(pattern)
    gaps = F.slice(F.split(text, pattern, -1), 1, F.regexp_count(text, p))
    matches = F.regexp_extract_all(text, p, F.lit(0))
    values = F.regexp_extract_all(text, p, F.lit(2)) if kind == "assign" else matches
    least = LEAST_VALUE if kind == "assign" else 0
    rows = F.transform(
        F.arrays_zip(gaps.alias("g"), matches.alias("m"), values.alias("v")),
        lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), (F.length(x["v"]) >= least).alias("counts")),
    )
    return F.when(F.regexp_like(text, p), rows).otherwise(F.array().cast("array<struct<kind:int,gap:int,len:int,counts:boolean>>"))


def parts(docs: DataFrame, keep: list[str] = []) -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """(id, text) -> rows (row, id, found, kept columns), and the spans of all parts: row, kind, start, end."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = F.concat(*[_found(F.col("_text"), k, p) for k, p in (STRONG | WEAK).items()])
    rows = docs.select(F.col("id").cast("long").alias("id"), *keep, text.alias("_text"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", *keep, found.alias("found")), "secret-parts")
    each = rows.filter(F.size("found") > 0).select("row", F.posexplode("found").alias("no", "f")).select("row", "no", "f.*")
    before = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.col("len")).over(before), F.lit(0)) + F.col("gap")
    spans = each.withColumn("start", start).filter("counts").select("row", "kind", "start", (F.col("start") + F.col("len")).alias("end"))
    return rows, spans


def _is(kinds: list[str]) -> Column:
    return F.col("kind").isin([KINDS.index(k) for k in kinds])


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Spans (row, kind, start, end) -> the strong ones, and weak ones with their complementary parts in reach."""
    spans = spans.withColumn("cell", F.floor(F.col("start") / reach))
    roles = sorted({r for need in NEEDS.values() for r in need})
    of = lambda role: _is([k for k in KINDS if ROLE[k] == role])
    ends = [f(F.when(of(r), F.col("start"))).alias(f"{n}_{r}") for r in roles for n, f in (("first", F.min), ("last", F.max))]
    cells = spans.filter(~of("endpoint")).groupBy("row", "cell").agg(*ends)
    step = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    seen = cells.withColumn("step", step).withColumn("to", F.col("cell") + F.col("step"))
    # step 1: seen from the next cell, so the last part is the nearest; step -1: from the one before
    near = [f(F.when(F.col("step").isin(s), F.col(f"{n}_{r}"))).alias(f"{n}_{r}") for r in roles for n, f, s in (("last", F.max, [0, 1]), ("first", F.min, [0, -1]))]
    own = [F.max(F.when(F.col("step") == 0, F.col(f"first_{r}"))).isNotNull().alias(f"here_{r}") for r in roles]
    near = seen.groupBy("row", F.col("to").alias("cell")).agg(*near, *own)
    weak = spans.filter(~_is(list(STRONG))).join(near, ["row", "cell"], "left")
    in_reach = lambda r: F.coalesce(F.col(f"here_{r}"), F.lit(False)) | F.coalesce(F.col("start") - F.col(f"last_{r}") <= reach, F.lit(False)) | F.coalesce(F.col(f"first_{r}") - F.col("start") <= reach, F.lit(False))
    keep = F.lit(False)
    for kind, need in NEEDS.items():
        both = F.lit(True)
        for r in need:
            both = both & in_reach(r)
        keep = keep | (_is([kind]) & both)
    return spans.filter(_is(list(STRONG))).select("row", "kind", "start", "end").unionByName(weak.filter(keep).select("row", "kind", "start", "end"))


def scan(docs: DataFrame, reach: int = REACH, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(id, text) -> id, spans: array of (start, rank of the kind, end, kind) in order; one row for each row.

    Places count code points, ends are exclusive.  Null and empty texts have no spans; null ids and
    repeated rows stay as they are; of other columns those in ``keep`` are handed on.
    """
    rows, spans = parts(docs, keep)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    all_ = linked(spans, reach).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", F.col("kind").alias("rank"), "end", F.element_at(kinds, F.col("kind") + 1).alias("kind")))).alias("spans"))
    none = F.array().cast(all_.schema["spans"].dataType)
    without = rows.filter(F.size("found") == 0).select("id", *keep, none.alias("spans"))
    return without.unionByName(rows.filter(F.size("found") > 0).join(all_, "row", "left").select("id", *keep, F.coalesce("spans", none).alias("spans")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with a mark in place of each run of overlapping spans (in order of their starts)."""
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        before = F.expr("1")  # substring counts from 1
        fresh = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, (acc["at"] + before).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.when(fresh, piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).cast("long").alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, empty, step, rest)).otherwise(text)
