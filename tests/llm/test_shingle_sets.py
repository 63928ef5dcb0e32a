"""Near-duplicates by similarity of shingle sets against comparing all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyfact.llm import shingle_sets, simhash
from skyfact.llm.shared import stored, table
from test_texts import SF, WORD, frame


def brute_set(text, k=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute_components(sets):
    """Group number of each set, by all pairs."""
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and similar(a, sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(words)), n):
        out[at] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    out = [" ".join(new(rng.randrange(1, 90))) for _ in range(40)]
    for size in (60, 150, 400):
        base = new(size)
        # from sure copies to pairs on both sides of the threshold
        out += [edited(rng, base, rng.randrange(0, max(2, size // 20))) for _ in range(50)]
    line = new(30)
    out += [" ".join(new(8) + line) for _ in range(30)] + [" ".join(line + new(3)) for _ in range(30)]
    chain = new(200)
    out += [" ".join(chain[i : i + 100]) for i in range(0, 100, 9)]
    out += ["same again and again and again", "Same  again\nand again AND again", None, "", " \n", "one", "one two", "two one"]
    return list(enumerate(out))


@pytest.mark.parametrize("bucket", [0, 4, 64])
def test_groups(spark, rows, bucket):
    docs = frame(spark, rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"), "text")
    got = {r.id: r.root for r in shingle_sets.groups(docs, bucket=bucket).collect()}
    want = brute_components([brute_set(t) for _, t in rows])
    assert len(got) == len(rows)
    assert len({(got[i], g) for i, g in enumerate(want)}) == len(set(want)) == len(set(got.values()))


def test_groups_table(spark):
    docs = table(spark, SF, "documents").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"), "text")
    texts = {r.id: r.text for r in docs.collect()}
    got = {r.id: r.root for r in shingle_sets.groups(docs).collect()}
    want = dict(zip(texts, brute_components([brute_set(t) for t in texts.values()])))
    assert len({(got[i], want[i]) for i in texts}) == len(set(want.values())) == len(set(got.values()))


def brute_print(text):
    """Majority of the bits of the hashes of a text's distinct shingles."""
    hashes = next(iter(shingle_sets.shingle_sets(pa.array([text], pa.string()))))
    assert len(hashes) == len(brute_set(text))
    return sum(1 << i for i in range(64) if 2 * sum(int(h) >> i & 1 for h in hashes) > len(hashes))


def test_prints_are_linked_by_the_pigeonring(spark, rows, monkeypatch):
    """The operator's links are the first pairs: they join all fingerprints at two bits or fewer, and what is similar of them."""
    docs = frame(spark, rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"), "text")
    names = stored(shingle_sets.set_names(docs), "names")
    found = {r.id: r for r in names.collect()}
    prints = {found[i].set: brute_print(t) for i, t in rows}
    assert all(found[i].fp % (1 << 64) == prints[found[i].set] for i, _ in rows)
    root = {s: s for s in prints}
    for u, v in shingle_sets.near_prints(names).collect():
        assert u < v and (prints[u] ^ prints[v]).bit_count() <= 2 * simhash.MAX_DIFF
        root = {s: min(root[u], root[v]) if r in (root[u], root[v]) else r for s, r in root.items()}
    want = {s: s for s in prints}
    for u in prints:
        for v in prints:
            if (prints[u] ^ prints[v]).bit_count() <= simhash.MAX_DIFF and want[u] != want[v]:
                want = {s: min(want[u], want[v]) if r in (want[u], want[v]) else r for s, r in want.items()}
    assert root == want

    asked = []
    monkeypatch.setattr(simhash, "links", lambda df, plain=simhash.links: asked.append({r.fp % (1 << 64) for r in df.collect()}) or plain(df))
    corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), SF).count()
    assert asked == [set(prints.values())]


def test_stage_drops_edited_copies(spark):
    """Copies at a similarity of 0.8 or more go, those below stay."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words)), (2, edited(rng, words, 6)), (3, edited(rng, words, 25))]
    a, b, c = (brute_set(t) for _, t in rows)
    assert similar(a, b) and not similar(a, c) and not similar(b, c)
    out = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), SF)
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_stage_keeps_one_row_of_each_group(spark):
    """Null ids with texts of their own, one id in two groups, and repeated rows."""
    rng = random.Random(9)
    new = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, d, e = (new(60) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (None, c), (3, c), (5, c), (5, d), (5, e), (5, e), (7, e), (None, None), (8, "")]
    out = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), SF)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(None, a), (None, b), (3, c), (5, d), (5, e), (8, "")])
