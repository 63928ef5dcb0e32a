"""Byte-level BPE, centroid clustering and the Merkle manifest against libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from compare import compare, connect
from skyfact.llm import byte_bpe, centroids, merkle, queries
from skyfact.llm.shared import table

SF = "/root/testdata/sf0.001"


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- byte-level BPE -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec()


AWKWARD = [
    None, "", " ", "  ", "\n \n\n", "a", "it's we'll I'VE", "x" * 3000, "ab" * 2000, "aaa aaaa aaaaa", "日本語 テキスト", "👩‍👩‍👧 🏳️‍🌈 é́",
    "\x00\x01\x7f\x85\xa0 　", "<|endoftext|>", "12345 ½ ⅷ ٣", "nbsp nbsp", "tab\tand   runs   of    spaces ", "\U0010ffff퟿�",
]


def test_byte_bpe_encodes_as_the_library(spark, library):
    rng = random.Random(3)
    mixed = ["".join(chr(rng.choice([rng.randrange(0x20, 0x7F), rng.randrange(0x20), rng.randrange(0xA0, 0x3000), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1FAFF)])) for _ in range(200)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*AWKWARD, *mixed])] + [(None, "no id"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "id long, text string, ids string, offsets int, decoded binary")
    out = byte_bpe.round_trip(docs).collect()
    assert Counter((r.id, tuple(r.ids), bytes(r.decoded)) for r in out) == Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def test_byte_bpe_offsets_and_tokens(spark, codec):
    texts = [t for t in AWKWARD if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    encoded = byte_bpe.encode(docs, offsets=True)
    for r in encoded.collect():
        assert [(o.start, o.end) for o in r.offsets] == codec.tokenizer.encode(texts[r.id]).offsets
    for r in byte_bpe.decode(encoded).collect():
        assert bytes(r.decoded).decode() == "".join(r.tokens) == texts[r.id]
    # an emoji shared by several tokens comes with the last of them
    assert codec.token_texts(codec.encode(["🏳"])[0])[:-1] == [""] * (len(codec.encode(["🏳"])[0]) - 1)
    assert codec.token_texts([codec.encode(["🏳"])[0][0]]) == ["�"]
    null = byte_bpe.decode(spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")).collect()
    assert {r.id: (r.decoded, r.tokens) for r in null} == {1: (None, None), 2: (b"", [])}
    with pytest.raises(ValueError):
        codec.decode([60000])


def test_byte_bpe_long_texts_in_parts(codec, library):
    rng = random.Random(4)
    text = "".join(rng.choice(["word", "Ünder", "1984", "日本", "...", "x"]) + rng.choice([" ", "  ", "\n", " \t", "", " "]) for _ in range(20000))
    for size in (50, 1000, 30000):
        parts = byte_bpe.text_parts(text, size)
        assert "".join(parts) == text and len(parts) > 1
        assert [i for p in parts for i in codec.encode([p])[0].tolist()] == library.encode_ordinary(text)
    assert byte_bpe.text_parts("x" * 1000, 10) == ["x" * 1000]


def test_byte_bpe_pieces_once(library):
    """The library gets each piece once, across batches too, and pieces have the tokens that they have in the text."""
    own = byte_bpe.Codec()
    inner, given = own.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **more):
            given.extend(texts)
            return inner.encode_batch_fast(texts, **more)

    own.tokenizer = Counting()
    rng = random.Random(6)
    parts = ["word", "Über", "été", "it's", "we'LL", "'s", "1984", "日本", "...", "x", "É", "$%", "_a_", "\x1c", "\x85", "\u3000", "’s", "ß", "\u0301"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "  ", "\n", "\r\n", " \t", "", "", ",", "."]) for _ in range(3000)) for _ in range(30)]
    texts += ["plain words, and more of them. " * 300] * 3
    for batch in (texts, texts[::-1], []):
        rows = own.encode(batch)
        assert [r.tolist() for r in rows] == [library.encode_ordinary(t) for t in batch]
        assert own.decode_rows(rows).to_pylist() == [t.encode() for t in batch]
    given.clear()
    own.encode(["plain words, and more of them. " * 300])
    assert sum(map(len, given)) == 0
    with pytest.raises(ValueError):
        own.decode_rows([np.array([60000], np.int32)])


def test_byte_bpe_odd_ranks(tmp_path):
    """A token that merging doesn't make is taken where a match is that token; ranks out of order are those of the tokens."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"ab", b"bcd", b"xyz"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    own = byte_bpe.Codec(str(path))
    theirs = tiktoken.Encoding("odd", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.read_ranks(str(path)), special_tokens={})
    rng = random.Random(1)
    for text in ["xyz", "xyzx", "abcd", "abab cabcd", *["".join(rng.choice("abcdxyz ") for _ in range(30)) for _ in range(300)]]:
        assert own.encode([text])[0].tolist() == theirs.encode_ordinary(text)
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        byte_bpe.Codec(str(path))


def test_byte_bpe_query(spark, library):
    out = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.byte_pieces(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(docs) == len(out)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        assert out[r.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(r.text or ""))
    empty = byte_bpe.round_trip(table(spark, SF, "documents").limit(0).withColumnRenamed("doc_id", "id"))
    assert empty.count() == 0


# --- centroid clustering --------------------------------------------------------------------------


def brute_clusters(rows, n=16, rounds=3, dim=64):
    """Vector by vector, in Python's integers."""
    limit = centroids.FARTHEST
    kept = [(i, [max(-limit, min(limit, math.floor(64 * x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:n]
    middles = [v for _, v in first]
    for k in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middles)) for _, v in kept]
        if k == rounds:
            break
        for j in range(len(middles)):
            own = [v for (_, v), b in zip(kept, best) if b[1] == j]
            if own:
                middles[j] = [sum(x) // len(own) for x in zip(*own)]
    inertia = Counter()
    for d, j in best:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), tuple(middles[j])) for (i, _), (d, j) in zip(kept, best))


def run_clusters(spark, rows, kind="float", **more):
    df = spark.createDataFrame([(*r, 1.5, "c", 7) for r in rows], f"id long, vector array<{kind}>, upper double, cluster string, no int")
    return Counter((r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in centroids.clusters(df, **more).collect())


def lumps(rng, n, dim, lumps_, spread):
    at = rng.standard_normal((lumps_, dim)) * 2
    return [[float(np.float32(x)) for x in at[rng.integers(lumps_)] + rng.standard_normal(dim) * spread] for _ in range(n)]


@pytest.mark.parametrize("spread,n,rounds", [(0.05, 16, 3), (1.0, 16, 3), (0.3, 5, 8)])
def test_clusters(spark, spread, n, rounds):
    rng = np.random.default_rng(int(spread * 100))
    rows = [(i, v) for i, v in enumerate(lumps(rng, 150, 8, 12, spread))]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (1, rows[3][1]), (None, rows[4][1]), (None, rows[5][1]), (200, None), (201, []), (202, [1.0] * 9), (203, [None] + [1.0] * 7), (204, [float("nan")] * 8), (205, [float("inf")] + [0.0] * 7)]
    rows += [(206, [0.0] * 8), (207, [-0.0] * 8), (208, [3e5] * 8), (209, [-3e5] * 8)]
    assert run_clusters(spark, rows, n=n, rounds=rounds, dim=8) == brute_clusters(rows, n, rounds, 8)


def test_clusters_ties_and_few(spark):
    grid = [(i, [float(i % 4), float(i // 4)]) for i in range(16)]
    assert run_clusters(spark, grid, n=4, dim=2) == brute_clusters(grid, 4, 3, 2)
    same = [(i, [0.5, -0.25]) for i in range(40)]  # all centroids are one; all but the first stay empty
    assert run_clusters(spark, same, n=4, dim=2) == brute_clusters(same, 4, 3, 2)
    few = [(7, [1.0, 2.0]), (8, [1.0, -2.0])]
    assert run_clusters(spark, few, n=16, dim=2) == brute_clusters(few, 16, 3, 2)
    assert not run_clusters(spark, [(1, None), (2, [1.0])], n=4, dim=2)
    huge = [(1, [1e30, -1e30]), (2, [3e38, 0.0]), (3, [-1e300, 1e7])]
    assert run_clusters(spark, huge, "double", n=2, dim=2) == brute_clusters(huge, 2, 3, 2)


def test_gain_is_a_bound_and_less_than_the_way():
    rng = np.random.default_rng(2)
    saved = []
    for _ in range(300):
        centre, old = rng.integers(-100, 100, 6), rng.integers(-100, 100, 6)
        new = old + rng.integers(-30, 30, 6)
        radius = float(rng.uniform(0, 150))
        most, way = centroids.gain(centre, radius, old, new), np.linalg.norm(new - old)
        out = rng.standard_normal((400, 6))
        p = centre + out / np.linalg.norm(out, axis=1, keepdims=True) * radius * rng.uniform(0, 1, (400, 1)) ** 0.2
        nearer = np.linalg.norm(p - old, axis=1) - np.linalg.norm(p - new, axis=1)
        assert nearer.max() <= most <= way * (1 + 1e-6) + 1e-5
        saved.append(most / way)
    assert np.mean(saved) < 0.8


def test_bounds_settle_most_vectors(spark):
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lumps(rng, 2000, 8, 16, 0.1))], "id long, vector array<float>")
    passes = centroids.clustered(rows, n=16, rounds=4, dim=8)[2]
    by_all = [p.filter("settled = 2").count() for p in passes]
    assert by_all[0] == 2000 and by_all[-1] < 400


def test_clusters_query(spark):
    assert compare(spark, connect(SF), SF, "op12_centroids") == ""


# --- Merkle manifest ------------------------------------------------------------------------------


def h(*parts):
    return sha("".join(parts))


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """(root, siblings of each leaf by level)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, path in enumerate(paths):
            run = at[k] // 16 * 16
            path.append(("".join(level[run : at[k]]), "".join(level[at[k] + 1 : run + 16])))
            at[k] //= 16
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], paths


def brute_manifest(rows):
    """rows: (id, source, leaf, tampered)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        subs[s] = tree([r[2] for r in groups[s]])
    root, tops = tree([subs[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(groups[s], subs[s][1]):
            fold = r[3] or r[2]
            for left, right in path + top:
                fold = h(left, fold, right)
            out.append((r[0], r[2], subs[s][0], root, h(*[a + b for a, b in path + top]), fold))
    return Counter(out)


def run_manifest(spark, rows):
    df = spark.createDataFrame([(*r, "m") for r in rows], "id long, source string, leaf string, tampered string, members string")
    out = merkle.manifest(df).withColumn("fold", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return Counter((r.id, r.leaf, r.subroot, r.root, r.proof, r.fold) for r in out.withColumn("proof", F.sha2(merkle.proof_text(F.col("path")).cast("binary"), 256)).collect())


def leaves(rng, ids, source, p=0.2):
    return [(i, source, h(source or "", str(i), str(rng.random())), h("t", str(i)) if rng.random() < p else None) for i in ids]


def test_manifest(spark):
    rng = random.Random(8)
    rows = leaves(rng, range(700), "big") + leaves(rng, range(-20, 0), "é") + leaves(rng, [5], "z") + leaves(rng, [7, 1 << 62, -(1 << 62), 64, 63, 128], None) + leaves(rng, range(16), "a") + leaves(rng, range(0, 1700, 100), "b")
    rng.shuffle(rows)
    assert run_manifest(spark, rows) == brute_manifest(rows)


def test_manifest_repeated_ids(spark):
    rng = random.Random(9)
    rows = leaves(rng, [i % 9 for i in range(60)], "s") + leaves(rng, [None, None, None, 3], "s") + leaves(rng, [None], None) + leaves(rng, [1, 2], "")
    rows += [rows[0], rows[0], rows[61]]
    assert run_manifest(spark, rows) == brute_manifest(rows)


def test_manifest_small(spark):
    one = [(3, "s", h("x"), None)]
    assert run_manifest(spark, one) == brute_manifest(one) == Counter([(3, h("x"), h("x"), h("x"), h(), h("x"))])
    many = [(i, f"s{i}", h(str(i)), None) for i in range(300)]  # groups of one each
    assert run_manifest(spark, many) == brute_manifest(many)
    assert not run_manifest(spark, [])


def test_manifest_query(spark, tmp_path):
    assert compare(spark, connect(SF), SF, "op13_merkle_manifest") == ""
    text = ["Ab", "É A", None, "", "plain", "x" * 50000]
    docs = [(i if i != 40 else None, text[i % 6], None if i % 11 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None if i % 5 == 0 else i) for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    leaf = lambda r, t: h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(t))
    small = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    touched = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    rows = [(r[0], r[3], leaf(r, r[1]), leaf(r, small(r[1])) if touched(r) else None) for r in docs]
    out = queries.manifest(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in out) == brute_manifest(rows)
    assert all(r.verified == (r.folded_root == r.root) for r in out)
    assert {r.doc_id for r in out if not r.verified} == {r[0] for r in docs if touched(r) and small(r[1]) != r[1]}
