"""SQL counterparts of the operators that SQL can express on whole tables.

They compute the plain definition, not the operator's way; only the mix states its schedule as SQL.
"""

from __future__ import annotations

from skyfact.llm import centroids, licenses, merkle, mixing, secrets, substring_dedup

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _dedup(window: int = substring_dedup.WINDOW) -> str:
    return f"""
    WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
    windows AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {window - 1} + 1, 1))) AS spot FROM docs),
    keyed AS (SELECT doc_id, spot, array_to_string(words[spot:spot + {window - 1}], ' ') AS k FROM windows WHERE len(words) >= {window}),
    later AS (SELECT doc_id, spot FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, spot) AS n FROM keyed) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(spot, spot + {window})) AS spot FROM later),
    holes AS (SELECT doc_id, list(spot) AS holes, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
           sha256(coalesce(array_to_string(list_filter(words, lambda w, i: NOT list_contains(coalesce(holes, []), i)), ' '), '')) AS kept_sha256
    FROM docs d LEFT JOIN holes USING (doc_id)"""


def _mixture(block: int = mixing.BLOCK, share: float = mixing.SHARE) -> str:
    step, points = mixing.STEP, mixing.POINTS
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
    WITH docs AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
    sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM docs GROUP BY source),
    sources AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sums),
    weighed AS (SELECT *, CAST({weights}[no % {len(mixing.WEIGHTS)} + 1] AS BIGINT) AS w, size * {mixing.PASSES} AS cap FROM sources),
    ranked AS (SELECT *, CAST(sum(size) OVER () AS DOUBLE) * {share} - coalesce(sum(cap) OVER f, 0) AS rem,
               CAST(sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS BIGINT) AS rest
               FROM weighed WINDOW f AS (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT rem AS l_rem, rest AS l_rest FROM ranked WHERE cap * rest > rem * w ORDER BY cap / w, no LIMIT 1),
    targets AS (SELECT no, source, size, CASE WHEN l_rest IS NULL OR cap * l_rest <= l_rem * w THEN CAST(cap AS DOUBLE) ELSE l_rem * w / l_rest END AS target
                FROM ranked LEFT JOIN level ON true),
    shares AS (SELECT no, floor(sum(target) OVER (ORDER BY no ROWS UNBOUNDED PRECEDING) / sum(target) OVER () * {points}) AS upto FROM targets),
    slots AS (SELECT slot, ((slot + 1) % {points}) * {step} % {points} AS point
              FROM (SELECT unnest(range(CAST((SELECT floor(coalesce(sum(target), 0) / {block} + 0.5) FROM targets) AS BIGINT))) AS slot)),
    ends AS (SELECT no, upto, coalesce(lag(upto) OVER (ORDER BY no), 0) AS since FROM shares),
    counts AS (SELECT no, count(*) AS n FROM slots JOIN ends ON point >= since AND point < upto GROUP BY no),
    placed AS (SELECT d.doc_id, d.size, t.size AS source_size, t.target, t.no, {", ".join(
        f"coalesce(sum(d.size) OVER (PARTITION BY t.no ORDER BY md5('mix{k}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + t.size * {k} AS at_{k}" for k in range(mixing.PASSES))}
               FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST({" + ".join(f"greatest(0, least(size, coalesce(n, 0) * {block} - at_{k}))" for k in range(mixing.PASSES))} AS BIGINT) AS taken
    FROM placed LEFT JOIN counts USING (no)"""


TOPK = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
               FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 20"""


def _secrets(reach: int = secrets.REACH) -> str:
    found = []
    for n, (kind, pattern) in enumerate((secrets.STRONG | secrets.WEAK).items()):
        p, group, least = _literal(pattern), 2 if kind == "assign" else 0, secrets.LEAST_VALUE if kind == "assign" else 0
        found.append(
            f"SELECT doc_id, {n} AS kind, unnest(regexp_extract_all(t, {p}, 0)) AS m, unnest(regexp_extract_all(t, {p}, {group})) AS v, unnest(string_split_regex(t, {p})[:-2]) AS gap,"
            f" unnest(range(len(regexp_extract_all(t, {p})))) AS no, {least} AS least FROM docs WHERE regexp_matches(t, {p})"
        )
    names = "[" + ", ".join(map(_literal, secrets.KINDS)) + "]"
    roles = "[" + ", ".join(_literal(secrets.ROLE[k]) for k in secrets.KINDS) + "]"
    near = lambda role: f"EXISTS (SELECT 1 FROM spans o WHERE o.doc_id = s.doc_id AND o.role = '{role}' AND abs(o.start - s.start) <= {reach})"
    linked = " OR ".join(f"(kind = {secrets.KINDS.index(k)} AND {' AND '.join(map(near, need))})" for k, need in secrets.NEEDS.items())
    text = "{names}[kind + 1] || ':' || start || ':' || stop".replace("{names}", names)
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({" UNION ALL ".join(found)}),
    placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY no) - length(m) AS start FROM found),
    spans AS (SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(start + length(m) AS BIGINT) AS stop, {roles}[kind + 1] AS role FROM placed WHERE length(v) >= least),
    kept AS (SELECT * FROM spans s WHERE kind < {len(secrets.STRONG)} OR {linked})
    SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
           sha256(coalesce(string_agg({text}, ',' ORDER BY start, kind) FILTER (kind < {len(secrets.STRONG)}), '')) AS base_sha256,
           coalesce(string_agg({text}, ',' ORDER BY start, kind), '') AS spans
    FROM docs d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id"""


def _licenses() -> str:
    word = f"[^{licenses.SEPARATOR}]+"
    phrase = lambda words: "list_filter(range(1, n_words + 1), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words.split())) + ")"
    places = "list_concat(" * (len(licenses.PHRASES) - 1) + phrase(next(iter(licenses.PHRASES)))
    for p in list(licenses.PHRASES)[1:]:
        places += f", {phrase(p)})"
    labels = "[" + ", ".join(f"CASE WHEN len({phrase(p)}) > 0 THEN '{label}' END" for p, label in licenses.PHRASES.items()) + "]"
    template = " UNION ALL ".join(f"SELECT '{name}' AS template, unnest(string_split('{text}', ' ')) AS word, unnest(range({len(text.split())})) AS spot" for name, (text, _) in licenses.TEMPLATES.items())
    need = " UNION ALL ".join(f"SELECT doc_id, '{name}' AS template FROM docs WHERE " + " AND ".join(f"len({phrase(p)}) > 0" for p in phrases) for name, (_, phrases) in licenses.TEMPLATES.items())
    return rf"""
    WITH docs AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words FROM
        (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w FROM documents)),
    template AS (SELECT template, word, min(spot) AS spot FROM ({template}) GROUP BY ALL),
    df AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(w) AS word FROM docs) WHERE word IN (SELECT word FROM template)) GROUP BY word),
    idf AS (SELECT template, word, spot, ln((SELECT count(*) + 1 FROM docs) / (coalesce(n, 0) + 0.5)) AS idf FROM template LEFT JOIN df USING (word)),
    idx AS (SELECT *, sum(idf) OVER (PARTITION BY template) AS whole FROM (SELECT *, row_number() OVER (PARTITION BY template ORDER BY idf DESC, word) AS n FROM idf) WHERE n <= {licenses.INDEXED}),
    verified AS ({need}),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(n_words)) AS pos FROM docs WHERE doc_id IN (SELECT doc_id FROM verified)),
    votes AS (SELECT doc_id, template, pos - spot AS place, sum(idf) / any_value(whole) AS share FROM words JOIN idx USING (word) JOIN verified USING (doc_id, template) GROUP BY ALL),
    own AS (SELECT doc_id, list(template) AS own, max(score) AS score FROM (SELECT doc_id, template, max(least(share, 1.0)) AS score FROM votes GROUP BY ALL) WHERE score >= {licenses.LEAST_SCORE} GROUP BY doc_id),
    base AS (SELECT doc_id, n_words, {places} AS places, list_sort(list_filter({labels}, lambda x: x IS NOT NULL)) AS labels FROM docs)
    SELECT doc_id, n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
           array_to_string(labels, ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(labels, coalesce(own, [])))), ',') AS labels, coalesce(round(score, 9), 0.0) AS score
    FROM base LEFT JOIN own USING (doc_id)"""


WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    sized AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS best FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
    FROM sized"""

NEAR_VECTORS = """
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
    reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
    least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
    n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON vec_id = least.u LEFT JOIN n ON vec_id = n.u"""


def _centroids(n: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS, dim: int = 64) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT v.no, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e,
            min({{'d': CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS best FROM v, c{k} c GROUP BY v.no)""")
        if k < rounds:
            steps.append(f"""sums{k} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT best.c AS c, unnest(e) AS x, unnest(range({dim})) AS i FROM near{k}) GROUP BY c, i),
            c{k + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{k} c LEFT JOIN
                (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM sums{k} GROUP BY c) m ON m.c = c.c)""")
    return f"""
    WITH v AS MATERIALIZED (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
               WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {n})),
    {", ".join(steps)}
    SELECT a.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance, CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
    FROM near{rounds} a JOIN c{rounds} c ON c.c = a.best.c"""


def _merkle(levels: int = 5, top_levels: int = 3, fan: int = merkle.FAN_OUT) -> str:
    """A level for each power of the fan-out; a node that is alone in its group is carried on as it is."""
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    row = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32, bit by bit
    bits = "list_reduce(list_prepend(xor(c, x), range(8)), lambda b, i: xor(b >> 1, (b & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))), lambda c, x: {bits}), 4294967295)"
    ctes = [
        f"docs AS MATERIALIZED (SELECT *, {row('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {row(small)} END AS tampered FROM documents)",
        "own AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, count(*) OVER (PARTITION BY source) AS n FROM docs)",
        "a0 AS MATERIALIZED (SELECT g, place, n, leaf AS digest FROM own)",
    ]
    joins, proof, fold = [], [], "coalesce(o.tampered, o.leaf)"

    def climb(name: str, count: int, group: str, place: str) -> None:
        nonlocal fold
        for k in range(count):
            ctes.append(f"{name}r{k} AS MATERIALIZED (SELECT g, place // {fan} AS place, (any_value(n) + {fan - 1}) // {fan} AS n, any_value(n) = 1 AS alone, list(digest ORDER BY place) AS d FROM {name}{k} GROUP BY g, place // {fan})")
            ctes.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, place, n, CASE WHEN alone THEN d[1] ELSE sha256(array_to_string(d, '')) END AS digest FROM {name}r{k})")
            r, at = f"{name}r{k}", f"({place} // {fan**k})"
            joins.append(f"JOIN {r} ON {r}.g = {group} AND {r}.place = {at} // {fan}")
            left, right = f"array_to_string({r}.d[:{at} % {fan}], '')", f"array_to_string({r}.d[{at} % {fan} + 2:], '')"
            proof.append(f"CASE WHEN {r}.alone THEN '' ELSE {left} || {right} END")
            joins.append(f"JOIN LATERAL (SELECT CASE WHEN {r}.alone THEN {fold} ELSE sha256({left} || {fold} || {right}) END AS f) AS {name}f{k} ON true")
            fold = f"{name}f{k}.f"

    climb("a", levels, "o.g", "o.place")
    ctes.append(f"b0 AS MATERIALIZED (SELECT 0 AS g, g - 1 AS place, (SELECT count(*) FROM a{levels}) AS n, digest FROM a{levels})")
    climb("b", top_levels, "0", "(o.g - 1)")
    return f"""
    WITH {", ".join(ctes)}
    SELECT o.doc_id, o.leaf, s.digest AS subroot, t.digest AS root, sha256({" || ".join(proof)}) AS proof_sha256, {fold} AS folded_root, {fold} = t.digest AS verified
    FROM own o JOIN a{levels} s ON s.g = o.g JOIN b{top_levels} t ON true {" ".join(joins)}"""


ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": _dedup(),
    "op2_source_mixing": _mixture(),
    "op3_exact_topk": TOPK,
    "op4_secret_scan": _secrets(),
    "op7_license_scan": _licenses(),
    "op8_warc": WARC,
    "op10_embedding_dedup": NEAR_VECTORS,
    "op12_centroids": _centroids(),
    "op13_merkle_manifest": _merkle(),
}
