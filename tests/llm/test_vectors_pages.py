"""Operators on vectors, pages and labels, and the pipeline, against brute force."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from skyfact.llm import embedding_dedup, exact_topk, mixing, queries, secrets, toxicity, warc
from skyfact.llm.components import components
from skyfact.llm.shared import stored, table
from test_texts import WORD, brute_fingerprint, brute_groups, brute_spans, frame

SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "n", 9) for i, v in rows], "id long, vector array<float>, dim int, block int, node string, weight int")


def brute_topk(rows, queries_, k):
    out = []
    for qi, q in queries_:
        scores = sorted((-int(np.dot(np.array(v, np.int64), np.array(q, np.int64))), i) for i, v in rows if i != qi and len(v) == len(q))
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return Counter(out)


def integers(rows):
    return [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]


def test_topk(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 0.3]) for i in range(500)]
    rows += [(600 + i, rows[20][1]) for i in range(50)]  # ties
    rows += [(700, None), (701, [float("nan")] * 8), (702, [None] + [1.0] * 7), (703, [float("inf")] * 8), (704, []), (720, [1.0, 2.0]), (740, [1.0, 2.0]), (None, rows[0][1]), (760, [1e6] * 8), (780, [-1e6] * 8)]
    scaled = vectors(spark, rows).withColumn("vector", exact_topk.scaled(F.col("vector")))
    out = exact_topk.top_k(scaled, scaled.filter("id % 20 = 0"), 20, 4, 64, 16).collect()
    assert Counter(map(tuple, out)) == brute_topk(integers(rows), [r for r in integers(rows) if r[0] % 20 == 0], 20)
    assert exact_topk.top_k(scaled.limit(0), scaled).count() == 0


def test_topk_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    out = queries.topk(spark, SF)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, out.collect())) == brute_topk(integers(rows), [r for r in integers(rows) if r[0] % 20 == 0], 20)


def test_topk_large_numbers(spark):
    """Where doubles could round, integers are used."""
    rng = np.random.default_rng(0)
    v = rng.integers(-(2**28), 2**28, (300, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    frame_ = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in rows], "id long, vector array<double>")
    out = exact_topk.top_k(frame_, frame_.filter("id < 5"), 7).collect()
    assert Counter(map(tuple, out)) == brute_topk(rows, rows[:5], 7)


def test_topk_reads_and_repeats(spark):
    """Few vectors are read exactly; rows with one id are queries of their own; large groups of copies are no candidates."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=64) * 0.125]) for i in range(3000)]
    rows += [(20, rows[7][1]), (20, rows[7][1]), (40, rows[40][1])] + [(5000 + i, rows[60][1]) for i in range(1500)]
    scaled = vectors(spark, rows).withColumn("vector", exact_topk.scaled(F.col("vector"))).cache()
    asked = scaled.filter("id % 20 = 0 AND id < 400")
    pairs, _, _ = exact_topk.candidates(scaled, asked, 5, block_rows=1000, query_rows=8)
    assert asked.count() == 23 and pairs.count() < 0.1 * 23 * len(rows)
    got = Counter(map(tuple, exact_topk.top_k(scaled, asked, 5, block_rows=1000, query_rows=8).collect()))
    whole = integers(rows)
    assert got == sum((brute_topk(whole, [r], 5) for r in whole if r[0] % 20 == 0 and r[0] < 400), Counter())
    scaled.unpersist()


def brute_links(rows, threshold):
    ok = [n for n, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                u, v = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        ids = [x for x in (i, least.get(find(n))) if x is not None]
        least[find(n)] = min(ids, default=None)
    return Counter((i, links[n], least[find(n)], i is not None and i == least[find(n)]) for n, (i, _) in enumerate(rows))


@pytest.mark.parametrize("tile_rows", [16, 8192])
def test_near_vectors(spark, tile_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 24))
    rows = [(i, [float(x) for x in (centres[i % 6] + rng.normal(size=24) * 0.28) * (1 + i % 3)]) for i in range(120)]
    rows += [(200 + i, [float(x) for x in rng.normal(size=24)]) for i in range(40)]
    rows += [(300 + i, rows[7][1]) for i in range(15)] + [(7, rows[7][1]), (None, rows[7][1]), (None, [9.0] * 24)]
    rows += [(400, None), (401, []), (402, [0.0] * 24), (403, [float("nan")] * 24), (404, [None] * 24), (405, [float("-inf")] * 24), (406, [1.0, 1.0]), (407, [2.0, 2.1]), (408, [1.0]), (409, [3.0]), (410, [-3.0])]
    out = embedding_dedup.near_vectors(vectors(spark, rows), 0.9, tile_rows=tile_rows).collect()
    assert Counter(map(tuple, out)) == brute_links(rows, 0.9)
    assert embedding_dedup.near_vectors(vectors(spark, [])).count() == 0


def test_near_vectors_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert Counter(map(tuple, queries.near_embeddings(spark, SF).collect())) == brute_links(rows, 0.9)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, 4, "z") for r in rows], "id long, uri string, html string, chunk_no int, record_type string")


@pytest.mark.parametrize("chunk", [7, 1 << 18])
def test_warc(spark, chunk):
    long_ = "<p>é日本\U0001F600</p>\r\n\r\nWARC/1.0\r\n" * 40
    rows = [(1, "http://a/x y", long_), (2, None, long_), (5, "http://é", long_), (5, "u", long_), (6, "u", "short"), (7, "u", "short"), (8, "u", ""), (9, "u", None), (None, None, "n"), (10, "a\r\nb", "x" * 999), (11, "u", "x" * 999), (12, "u", "x" * 1000), (13, "u", "x" * 1000)]
    got = warc.archived(pages(spark, rows).repartition(3), chunk).collect()
    whole = {}
    for r in got:
        whole.setdefault((r.archive, r.record_no), []).append(r)
    assert len(whole) == len(rows)
    seen = Counter()
    for parts in whole.values():
        parts.sort(key=lambda r: r.chunk_no)
        last, data = parts[-1], b"".join(bytes(r.data) for r in parts)
        assert [r.chunk_no for r in parts] == list(range(len(parts))) and [r.last for r in parts] == [False] * (len(parts) - 1) + [True]
        assert all(len(r.data) <= chunk for r in parts)
        if last.record_type == "response":
            assert last.digest_so_far == last.payload_digest == hashlib.sha1(data).hexdigest() and last.bytes_so_far == len(data) == last.payload_bytes
        else:
            assert not data
        seen[(last.record_id, last.record_type, last.refers_to, last.payload_bytes, last.payload_digest)] += 1
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        group = [j for j, _, x in rows if (x or "").encode() == b and j is not None]
        visit = len(b) >= 1000 and i != max(group)
        want[(f"page:{'null' if i is None else i}", "revisit" if visit else "response", f"page:{max(group)}" if visit else None, len(b), hashlib.sha1(b).hexdigest())] += 1
    assert seen == want
    assert warc.archived(pages(spark, [])).count() == 0


def test_warc_damage(tmp_path):
    head = warc.record_head("page:1", "response", "u", None, 4, "0" * 40)
    assert [r["data"] for r in warc.records(io.BytesIO(head + b"abcd\r\n\r\n"), 3)] == [b"abc", b"d"]
    for bad in (head + b"ab", head + b"abcdXXXX", b"junk\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad), 3))


def test_warc_writer_checks_digests():
    digest = hashlib.sha1(b"abcd").hexdigest()
    record = warc._Record(out := io.BytesIO(), "page:1", "response", "u", None, 4, digest)
    record.add("page:1", 0, b"ab")
    record.add("page:1", 1, b"cd")
    record.close()
    assert [r["data"] for r in warc.records(io.BytesIO(gzip.decompress(out.getvalue())), 9)] == [b"abcd"]
    for chunks in ([b"ab"], [b"ab", b"cx"], [b"ab", b"cd", b"e"], []):
        record = warc._Record(io.BytesIO(), "page:1", "response", "u", None, 4, digest)
        for k, data in enumerate(chunks):
            record.add("page:1", k, data)
        with pytest.raises(ValueError):
            record.close()
    with pytest.raises(ValueError):
        warc._Record(io.BytesIO(), "page:1", "response", "u", None, 4, digest).add("page:1", 1, b"cd")


def test_warc_default_file_system(spark, tmp_path):
    """With a default file system other than the local one, a path without a scheme is below that one."""
    far, near = tmp_path / "far", tmp_path / "near"
    far.mkdir()
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    html = ["x" * 3000, "y", "x" * 3000, None]
    rows = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "id long, uri string, html string")
    try:
        conf.set("fs.viewfs.mounttable.cluster.link." + str(near), far.as_uri())
        conf.set("fs.viewfs.mounttable.cluster.linkFallback", "file:///")
        conf.set("fs.defaultFS", "viewfs://cluster/")
        warc.write_warc(rows, f"{near}/pages", 1000)
        got = warc.read_warc(spark, f"{near}/pages", 700).filter("last").select("record_id", "bytes_so_far").collect()
    finally:
        conf.set("fs.defaultFS", before or "file:///")
    assert Counter(map(tuple, got)) == Counter({("page:0", 0): 1, ("page:1", 1): 1, ("page:2", 3000): 1, ("page:3", 0): 1})
    assert not near.exists() and any((far / "pages").glob("part-*.warc.gz"))


def test_warc_folders(spark, tmp_path):
    with pytest.raises(ValueError):
        warc._open("/no/scheme")
    with pytest.raises(Exception, match="FileNotFound"):
        warc.read_warc(spark, str(tmp_path / "none"))
    out = tmp_path / "out"
    out.mkdir()
    (out / ".part-lost.warc.gz").write_bytes(b"cut")
    (out / "part-0.warc.gz").write_bytes(b"cut")
    with pytest.raises(ValueError):
        warc._Reader(out.as_uri(), 10).partitions()
    warc._Writer(out.as_uri()).commit([])
    assert not (out / ".part-lost.warc.gz").exists() and len(warc._Reader(out.as_uri(), 10).partitions()) == 1


def test_warc_query(spark):
    html = {r.page_id: (r.html or "").encode() for r in table(spark, SF, "pages").collect()}
    out = queries.archive(spark, SF).collect()
    assert sorted(r.page_id for r in out) == sorted(html)
    for r in out:
        b = html[r.page_id]
        best = max(i for i, x in html.items() if x == b)
        visit = len(b) >= 1000 and best != r.page_id
        assert tuple(r) == (r.page_id, len(b), hashlib.sha1(b).hexdigest(), "revisit" if visit else "response", best if visit else None)


def test_toxicity(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    out = queries.toxic(spark, d).collect()
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    known = [(r.score, labels[r.doc_id]) for r in out if r.doc_id in labels and r.held_out]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    assert sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg) > 0.8
    assert sum(s >= 0.5 for s in neg) / len(neg) < 0.04
    every = [(r.predicted, labels[r.doc_id]) for r in out if r.doc_id in labels]
    assert sum(p == y for p, y in every) / len(every) > 0.93


def test_toxicity_awkward(spark):
    empty = spark.createDataFrame([], "id long, toxic int")
    docs = frame(spark, [(1, "bad words"), (2, None), (3, ""), (None, "bad"), (1, "bad words")]).drop("id").withColumnRenamed("doc_id", "id")
    for labels in (empty, spark.createDataFrame([(1, 1), (1, None), (None, 1), (9, 0)], "id long, toxic int")):
        model = toxicity.train(docs, labels)
        out = toxicity.score(docs, model).collect()
        assert len(out) == 5 and all(0 < r.score < 1 for r in out)
    assert toxicity.score(docs.limit(0), model).count() == 0
    # the non-negative part: positives alone can't be memorised below the loss on clean text
    rng = random.Random(1)
    pos = [np.array([1, 2, rng.randrange(10, 99)], np.uint64) for _ in range(50)]
    unl = [np.array([rng.randrange(10, 99)], np.uint64) for _ in range(400)] + pos[:40]
    model = toxicity.fit(pos, unl, np.arange(99).astype(np.uint64), 0.1)
    assert all(w > 0 for w in model.weights[1:3]) and abs(model.weights[10:]).max() < model.weights[1] and model.weights[1:3].sum() + model.bias > 0 > model.bias


def test_toxicity_counts_and_risk(spark):
    """Counts and risk over all documents against plain sums, and a model of two weights by hand."""
    import pyarrow as pa

    rng = random.Random(4)
    words = ["scum", "trash", "river", "stone", "moron", "garden"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 9)))) for i in range(300)] + [(300, None), (None, "scum"), (7, "trash scum")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(5)
    plain = [set(toxicity.presence(pa.array([t], pa.string()))[1].tolist()) for _, t in rows]
    every = Counter(f for x in plain for f in x)
    seen = toxicity.seen_in(docs)
    assert seen.tolist() == sorted(f for f, n in every.items() if n >= 3)
    held = stored(toxicity.with_presence(docs, seen), "held")
    assert toxicity.feature_counts(held, len(seen)).tolist() == [every[f] for f in seen.tolist()]
    w, b = np.random.default_rng(5).normal(size=len(seen)), -0.3
    z = np.array([sum(w[np.searchsorted(seen, np.uint64(f))] for f in x if every[f] >= 3) + b for x in plain])
    loss, slope = toxicity.risk_everywhere(held, len(seen), len(rows))(w, b)
    assert np.isclose(loss, np.log1p(np.exp(z)).mean()) and np.isclose(slope[-1], (1 / (1 + np.exp(-z))).mean())
    f = int(np.searchsorted(seen, np.uint64(max(every, key=every.get))))
    assert np.isclose(slope[f], sum(1 / (1 + np.exp(-z[i])) for i, x in enumerate(plain) if int(seen[f]) in x) / len(rows))
    # half of the positives have a feature that a tenth of all have: 0.5 ln 5 + 0.5 ln (5/9) nats each
    best = toxicity.chosen(np.arange(3).astype(np.uint64), np.array([500, 100, 10]), 999, np.array([1000, 1000, 1000]), 9999)
    assert best.tolist() == [0]
    one = toxicity.Model(seen[:1], np.array([2.0]), -1.0)
    assert np.allclose(one.score(pa.array([t for _, t in rows])), [1 / (1 + np.exp(1 - 2 * (int(seen[0]) in x))) for x in plain])


def test_toxicity_stores_chosen_features_only(spark, monkeypatch):
    """Texts are counted without storing what they have: stored numbers are those of the model's features."""
    kept = []
    monkeypatch.setattr(toxicity, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1])
    d = "/root/testdata/sf0.01"
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("id"), "toxic")
    model = toxicity.train(docs, labels)
    feats = [np.frombuffer(r.feats, np.uint32) for df in kept if "feats" in df.columns for r in df.collect()]
    assert len(feats) == docs.count() and max(x.max() for x in feats if len(x)) < len(model.features)
    toxic = docs.join(labels.filter("toxic = 1"), "id")
    seen = toxicity.seen_in(toxic)
    assert len(seen) > 2 * len(model.features)
    assert toxicity.text_counts(toxic, seen).tolist() == toxicity.feature_counts(toxicity.with_presence(toxic, seen), len(seen)).tolist()


def test_pipeline_stages(spark):
    """Each stage against a plain version, on rows with nulls, ties and repeated rows."""
    docs = table(spark, SF, "documents").limit(60)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows += [(1000, None, "src1"), (1001, "", None), (1002, "user = bob1 token = 'abcdef123456' end", "src1"), (1003, rows[0][1], "src2"), (1003, rows[0][1], "src2"), (None, "no id here", "src1"), (None, "no id here", "src1")]
    rows += [(2000 + i, "An idiot and moron, scum and trash. " * 3, "src0") for i in range(2)]
    start = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)

    clean = stored(stages["toxicity"](spark, start, SF), "t1")
    assert clean.columns == corpus_pipeline.COLUMNS
    model = queries.toxicity_model(start.select("doc_id", "text"), table(spark, SF, "labels"))
    import pyarrow as pa

    want = [r for r, s in zip(rows, model.score(pa.array([r[1] for r in rows]))) if s < 0.5]
    assert Counter((r.doc_id, r.text, r.source) for r in clean.collect()) == Counter(want)

    alone = stored(stages["near_duplicates"](spark, clean, SF), "t2")
    prints = {(i, t): brute_fingerprint(t) for i, t, _ in want}
    least = {}
    for (i, _), p in prints.items():
        least[p] = min((x for x in (i, least.get(p)) if x is not None), default=None)
    groups = brute_groups(least, least)
    keep = {(i, t, s) for i, t, s in want if groups[prints[(i, t)]] == i}
    got = [(r.doc_id, r.text, r.source) for r in alone.collect()]
    assert Counter(got) == Counter(keep) and len(set(g[0] for g in got)) == len(got)

    masked = stored(stages["secrets"](spark, alone, SF), "t3")
    for r in masked.collect():
        text = next(t for i, t, _ in got if i == r.doc_id)
        spans = brute_spans(text)
        assert (r.text == text) == (not spans)
        assert r.n_chars == (len(r.text) if spans else len(text or ""))
    assert masked.count() == len(got)

    mixed = stored(stages["mixing"](spark, masked, SF), "t4")
    placed, slots = mixing.mix(queries.sized(masked))
    taken = {r.id: r.taken for r in mixing.taken(placed, slots).collect()}
    words = Counter()
    source = {r.doc_id: r.text for r in masked.collect()}
    for r in mixed.collect():
        mine = WORD.findall(r.text)
        words[r.doc_id] += len(mine)
        whole = WORD.findall(source[r.doc_id])
        assert any(whole[a : a + len(mine)] == mine for a in range(len(whole) - len(mine) + 1))
        assert r.n_chars == len(r.text)
    assert words == Counter({i: n for i, n in taken.items() if n})

    pieces = stages["sentencepiece"](spark, mixed, SF).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in pieces) == Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())


def test_pipeline_empty(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_registered(spark):
    assert {k.split("_")[0] for k in entry.queries() if k.startswith("op")} == {f"op{n}" for n in range(1, 11)}
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.columns[0] == "doc_id"


def test_repeated_key_excerpts(spark):
    """Equal rows of one key give each pass once, whatever their number."""
    docs = frame(spark, [(1, "a b c d", "s")] * 3 + [(2, "e f g h", "s")]).select(*corpus_pipeline.COLUMNS)
    placed, mixed = mixing.mix(queries.sized(docs), block=2)
    rows = mixing.excerpts(docs, placed, mixed).collect()
    taken = Counter()
    for r in mixing.taken(placed, mixed).collect():
        taken[r.id] += r.taken
    got = Counter()
    for r in rows:
        got[r.doc_id] += len(r.text.split())
    assert got == Counter({i: n for i, n in taken.items() if n})


def test_secret_kinds():
    assert list(secrets.ROLE) == secrets.KINDS
