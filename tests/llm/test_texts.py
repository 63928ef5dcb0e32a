"""Operators on texts against brute force, on awkward rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from skyfact.llm import licenses, mixing, queries, secrets, sentencepiece_codec, simhash, substring_dedup
from skyfact.llm.shared import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, kind string, size string, slice int, digest string, no int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """(doc_id, text[, source]) with further columns whose names the operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 7, "k", "big", 3, "d", 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def texts(spark, rows):
    return frame(spark, rows).drop("id").withColumnRenamed("doc_id", "id")


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "日本", "a\x1cb", "\x85", "x y"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t\r"]) for _ in range(n))
    rows = [(i, prose(rng.randrange(1, 120))) for i in range(30)]
    rows += [(i, prose(15) + passage + " " + prose(15)) for i in range(30, 38)]
    rows += [(40, rows[3][1]), (41, rows[3][1]), (41, rows[3][1]), (42, None), (43, ""), (44, " \n"), (45, "word"), (46, "one two"), (None, rows[4][1]), (None, rows[4][1]), (None, None)]
    rows += [(50, "tick " * 200), (51, "a b " * 90), (52, prose(8000)), (-3, passage)]
    return rows


def brute_dedup(rows, window):
    tie = lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42))) if t is not None else 42
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, tie(rows[i][1]) if rows[i][0] is None else 0, rows[i][1] is not None, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        words = WORD.findall(rows[i][1] or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out.append((rows[i][0], len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("slice_bytes", [500, 1 << 20])
def test_substring_dedup(spark, awkward, slice_bytes):
    out = substring_dedup.repeated_spans(texts(spark, awkward), 20, slice_bytes).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in out) == brute_dedup(awkward, 20)
    for r in out:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_substring_dedup_heavy_prefixes(spark):
    """A word that starts most suffixes is lengthened, and the result is the same."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "the", "the", f"v{rng.randrange(9)}"]) for _ in range(300))) for i in range(20)]
    rows += [(i + 100, rows[i][1]) for i in range(5)]
    heavy = substring_dedup.heavy_prefixes(texts(spark, rows).select("id", "text"), 20)
    assert len(heavy[1]) >= 1 and all(len(v) <= 4 / substring_dedup.HEAVY_SHARE for v in heavy.values())
    out = substring_dedup.repeated_spans(texts(spark, rows), 20, 2000).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in out) == brute_dedup(rows, 20)


def test_substring_dedup_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = Counter((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for (i, n, g, t) in brute_dedup(docs, 20).elements())
    assert Counter(tuple(r) for r in queries.substring_dedup_docs(spark, SF).collect()) == want
    assert substring_dedup.repeated_spans(texts(spark, [])).count() == 0


def test_word_hashes_tell_words_apart(spark):
    """Words that collide under powers of any base modulo 2**64: Thue-Morse strings of 1,024 letters."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = ("".join(x[k] for k in bits) for x in ("ab", "ba"))
    opening = " ".join(f"w{i}" for i in range(19))
    out = substring_dedup.repeated_spans(texts(spark, [(1, f"{opening} {a}"), (2, f"{opening} {b}"), (3, f"{opening} {a}")]))
    assert {r.id: r.n_removed for r in out.collect()} == {1: 0, 2: 0, 3: 20}


def test_null_ids_over_slices(spark):
    """Which of the documents without an id keeps a passage doesn't depend on how they are dealt out."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = texts(spark, [(None, f"text {i} {passage} end{i}") for i in range(8)])
    outs = [Counter((r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.repeated_spans(rows, slice_bytes=n).collect()) for n in (8 << 20, 600, 300)]
    assert outs[0] == outs[1] == outs[2] and sum(n for (_, gone, _), n in outs[0].items() if gone == 0) == 1


def brute_fill(sizes, share=1.5, weights=(5, 2, 1)):
    """Share out by weight, stop the full ones, share out the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not full:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def mixture(spark, docs):
    placed, mixed = mixing.mix(queries.sized(docs))
    return mixing.taken(placed, mixed).collect(), mixed


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 300), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(400)]
    rows += [(500, "w " * 50, "a")] * 3 + [(None, "x y z", "b"), (None, None, "b"), (7, None, None), (501, "u " * 4000, "lone")]
    rows += [(600, "q " * 30, "b"), (600, "r " * 30, "b")]
    out, mixed = mixture(spark, frame(spark, rows))
    assert Counter((r.id, r.size) for r in out) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    sizes = Counter()
    for r in out:
        sizes[r.source] += r.size
    target, got = brute_fill(sizes), Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r.size
        got[r.source] += r.taken
    for s, t in target.items():
        assert abs(got[s] - t) <= 4 * mixing.BLOCK
    again, _ = mixture(spark, frame(spark, rows[::-1]).repartition(7))
    key = lambda r: (r.id is None, r.id or 0, r.size, r.no, r.at_0, r.at_1)
    assert sorted(out, key=key) == sorted(again, key=key)
    # every stretch of the schedule has the sources in their proportions
    slots = mixed.select("slot", "no").distinct().orderBy("slot").collect()
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    half = Counter(names[r.no] for r in slots[: len(slots) // 2])
    for s, t in target.items():
        assert abs(half[s] - t / sum(target.values()) * len(slots) / 2) <= 4


def test_mixing_small(spark):
    assert mixture(spark, frame(spark, []))[0] == []
    (only,), _ = mixture(spark, frame(spark, [(1, None, None)]))
    assert (only.size, only.source_size, only.target, only.taken) == (0, 0, 0.0, 0)
    out = queries.mixture(spark, SF).collect()
    assert len(out) == 200 and abs(sum(r.taken for r in out) / (1.5 * sum(r.size for r in out)) - 1) < 0.02


def test_mixing_many_sources(spark):
    """Sources are rows of a table: 5,000 of them, most of few words, one with a third of all."""
    docs = spark.range(15000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5000) END AS source", "repeat('w ', CAST(id % 7 * 30 AS INT)) AS text"
    )
    placed, mixed = mixing.mix(queries.sized(docs))
    out = mixing.taken(placed, mixed)
    sums = out.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.first("source_size").alias("size")).collect()
    fill = brute_fill({r.source: r["size"] for r in sums})
    assert len(sums) > 3000 and all(r.target == pytest.approx(fill[r.source]) for r in sums)
    assert all(abs(r.taken - r.target) <= 4 * mixing.BLOCK for r in sums)
    assert abs(sum(r.taken for r in sums) / sum(r.target for r in sums) - 1) < 0.05
    assert out.filter("taken > 2 * size").isEmpty() and out.count() == 15000


def brute_spans(text):
    text, out = text or "", []
    for kind, pattern, least in (("assign", secrets.ASSIGN, 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        pattern = pattern.replace("((?i:password|passwd|secret|token|api_?key))", "((?i:password|passwd|secret|token|api_?key))")
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), secrets.KINDS.index(kind), m.end(), kind))
    weak = [(m.start(), secrets.KINDS.index(k), m.end(), k) for k, p in secrets.WEAK.items() for m in re.finditer(p, text, re.ASCII)]
    near = lambda s, role: any(abs(x[0] - s) <= secrets.REACH for x in out + weak if secrets.ROLE[x[3]] == role)
    return sorted(out + [x for x in weak if all(near(x[0], r) for r in secrets.NEEDS[x[3]])])


def test_secrets(spark):
    rng = random.Random(3)
    bits = [
        "password = hunter2secret", "PASSWORD:'abc'", "secret: token: abcdefgh", "api_key=\"A1b2C3d4\"", "apikey : xy", "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 8, "AKIA",
        "f" * 24, "0" * 23, "deadbeef" * 5, "user = alice", "client_id: svc-7", "https://db.example.com:5432/x", "A" * 40, "b/" * 30 + "==", "日本é", "\U0001F600\U0001F600", "x " * 90, "token=" + "ab" * 20,
    ]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, bits[0]), (3, rows[3][1]), (3, rows[3][1]), (202, "user = bob " * 3000 + "secret=abcdef12345")]
    out = secrets.scan(texts(spark, rows)).collect()
    got = Counter((r.id, tuple(tuple(s) for s in r.spans)) for r in out)
    assert got == Counter((i, tuple(brute_spans(t))) for i, t in rows)
    assert any(s[3] == "endpoint" for _, spans in got for s in spans)
    masked = secrets.scan(frame(spark, rows).drop("id").withColumn("id", F.col("doc_id")), keep=["text"]).select("text", "spans", secrets.redacted(F.col("text"), F.col("spans")).alias("masked"))
    for r in masked.collect():
        want, at = "", 0
        for s in r.spans:
            if s.start >= at:
                want += r.text[at : s.start] + "[SECRET]"
            at = max(at, s.end)
        assert r.masked == (want + r.text[at:] if r.spans else r.text)
    assert secrets.scan(texts(spark, [])).count() == 0


def test_secret_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in queries.secret_spans(spark, SF).collect():
        spans = brute_spans(docs[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans if k in secrets.STRONG)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[3] == k for x in spans) for k in secrets.STRONG)


def test_pieces(spark, awkward):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    rows = awkward + [(900 + i, t) for i, t in enumerate([" a", "a  b", "   ", " \t x", "ﬁ Ⅳ", "\U0001F600 日 本", "a\x00b ", "<s> </s> <0x41>", "aaaaaaaaaaaaaaaaaaaa", "x" * 5000])]
    out = sentencepiece_codec.round_trip(texts(spark, rows)).collect()
    assert Counter((r.id, tuple(r.ids), r.decoded) for r in out) == Counter((i, tuple(sp.encode(t or "")), t or "") for i, t in rows)
    split = sentencepiece_codec.decode(sentencepiece_codec.encode(texts(spark, rows))).collect()
    assert Counter(map(tuple, split)) == Counter((i, t or "") for i, t in rows)
    assert sentencepiece_codec.encode(texts(spark, [])).count() == 0
    assert sentencepiece_codec.marked_words("a▁b") == ["▁a", "▁b"]


def test_pieces_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in queries.pieces(spark, SF).collect():
        assert list(r.ids) == sp.encode(docs[r.doc_id]) and r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def brute_fingerprint(text, k=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, least):
    """Component of each fingerprint by comparing all pairs; named by the least id."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ps = sorted(prints)
    for i, a in enumerate(ps):
        for b in ps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    name = {}
    for p in ps:
        ids = [i for i in [least[p], name.get(find(p))] if i is not None]
        name[find(p)] = min(ids, default=None)
    return {p: name[find(p)] for p in ps}


def check_simhash(rows, out):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    least = {}
    for i, p in prints:
        least[p] = min((x for x in (i, least.get(p)) if x is not None), default=None)
    groups = brute_groups(least, least)
    assert Counter((r.id, r.fingerprint, r.component_id) for r in out) == Counter((i, f"{p:016x}", groups[p]) for i, p in prints)


def test_simhash(spark, awkward):
    rng = random.Random(4)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(200)]
    near = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(200)] = "Edit"
        near.append((1000 + i, " ".join(w).upper() if i % 3 else "  ".join(w)))
    rows = awkward + near
    check_simhash(rows, simhash.near_duplicates(texts(spark, rows)).collect())
    assert simhash.near_duplicates(texts(spark, [])).count() == 0
    assert [tuple(r) for r in simhash.near_duplicates(texts(spark, [(None, "x"), (None, "x")])).collect()] == [(None, f"{brute_fingerprint('x'):016x}", None)] * 2


@pytest.mark.parametrize("bucket", [0, 3, 64])
def test_simhash_links(spark, bucket):
    """All of the buckets compared, some refined, all refined: the same components."""
    rng = random.Random(6)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(12)}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.links(df, bucket).collect()]
    assert all((u ^ v).bit_count() <= 2 for u, v in edges)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        root[find(u)] = find(v)
    want = brute_groups(prints, {p: p for p in prints})
    assert Counter(Counter(want.values()).values()) == Counter(Counter(find(p) for p in prints).values())
    by = {}
    assert all(by.setdefault(want[p], find(p)) == find(p) for p in prints)


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    check_simhash(rows, queries.near_documents(spark, SF).withColumnRenamed("doc_id", "id").collect())


def test_license_words(spark):
    rng = random.Random(8)
    bits = ["GNU General Public License", "gnu general\n\npublic, LICENSE", "apache license", "Apache-License", "cc by", "CC BY-NC 4.0", "mit license", "permit license", "mit licensed", "the", "of", "İstanbul", "naïve", "日本", "x_y", "MIT\x7fLicense", "éMIT license"]
    rows = [(i, rng.choice([" ", ". "]).join(rng.choice(bits) for _ in range(rng.randrange(1, 20)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "mit license"), (202, "mit license"), (202, "mit license"), (203, "a " * 30000 + "cc by")]
    got = licenses.scan(texts(spark, rows)).collect()
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(p, label) for phrase, label in licenses.PHRASES.items() for p in range(len(words)) if words[p : p + len(phrase.split())] == phrase.split()]
        places = [p for p, _ in at]
        want.append((i, len(words), len(at), min(places, default=None), max(places, default=None), tuple(sorted({x for _, x in at}))))
    assert Counter((r.id, r.n_words, r.n_base, r.first_word, r.last_word, tuple(r.base_labels)) for r in got) == Counter(want)
    for r in got:
        assert set(r.base_labels) <= set(r.labels) and list(r.labels) == sorted(set(r.labels)) and 0 <= r.score <= 1
    assert licenses.scan(texts(spark, [])).count() == 0


def test_license_templates(spark):
    notice = licenses.TEMPLATES["mit-text"][0]
    rows = [(1, f"Some words first. {notice.upper()}, and more"), (2, "permission is hereby granted free of charge"), (3, " ".join(notice.split()[::-1])), (4, "Licensed under the Apache License, Version 2.0."), (5, "Licensed under CC BY-NC 4.0."), (6, "plain prose")]
    rows += [(10 + i, "the of and to any in") for i in range(40)]
    got = {r.id: (list(r.labels), round(r.score, 6)) for r in licenses.scan(texts(spark, rows)).collect()}
    # 2 has the phrase but not the notice, 3 the words but at other positions
    assert got[1] == (["mit-text"], 1.0) and got[2] == ([], 0.0) and got[3] == ([], 0.0)
    assert got[4] == (["apache", "apache-2.0"], 1.0) and got[5] == (["cc-by", "cc-by-nc-4.0"], 1.0) and got[6] == ([], 0.0)


def test_license_near_misses(spark):
    """Each notice is found as it stands, in a long text too; without its phrases, or out of its order, it is not."""
    rows, want = [], {}
    for n, (name, (notice, need)) in enumerate(sorted(licenses.TEMPLATES.items())):
        words = notice.split()
        broken = notice.replace(need[0], need[0].replace(" ", " really ", 1))
        rows += [(10 * n, f"{'filler words ' * 300}{notice}; {'more of it ' * 300}"), (10 * n + 1, broken), (10 * n + 2, " ".join(reversed(words)))]
        want |= {10 * n: True, 10 * n + 1: False, 10 * n + 2: False}
        want[10 * n] = name
    got = {r.id: (set(r.labels) & set(licenses.TEMPLATES), r.score) for r in licenses.scan(texts(spark, rows)).collect()}
    for i, name in want.items():
        if name:
            assert name in got[i][0] and got[i][1] >= licenses.LEAST_SCORE
        else:
            assert sorted(licenses.TEMPLATES)[i // 10] not in got[i][0]


def test_license_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    out = queries.license_labels(spark, SF).collect()
    assert len(out) == len(docs) and any(r.labels for r in out)
    for r in out:
        assert r.n_base == len(re.findall(r"(?i)gnu general public license|apache license|\bcc by\b|mit license", docs[r.doc_id]))


def test_native_plans(spark):
    """The scans that must stay native run no Python."""
    for q in (queries.secret_spans, queries.license_labels):
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
