"""SQL that gives the rows of the corpus queries, for those that SQL can express, in DuckDB's dialect.

Written from the contracts, not from the operators: whole texts, nested loops over lists, windows over whole sources.
"""

from __future__ import annotations

from feedloom.llm import licences, mixing, quality, secrets, sharding

_SPACE = r"[\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secret_scan() -> str:
    found = []
    for number, rule in enumerate(secrets.RULES):
        checked = f"regexp_extract(h, {_text(rule.pattern)}, {rule.group})" if rule.group else "h"
        found.append(f"""
            SELECT doc_id, {number} AS no, {_text(rule.kind)} AS kind, {"true" if rule.base else "false"} AS base, h,
                   length({checked}) >= {rule.least} AS ok, i,
                   list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS a
            FROM (SELECT doc_id, gaps, hits, unnest(hits) AS h, generate_subscripts(hits, 1) AS i
                  FROM (SELECT doc_id, string_split_regex(t, {_text(rule.pattern)}) AS gaps,
                               regexp_extract_all(t, {_text(rule.pattern)}) AS hits FROM texts))""")
    counts = ", ".join(
        f"count(*) FILTER (ok AND kind = {_text(r.kind)}) AS n_{r.kind}" for r in secrets.RULES if r.base
    )
    none = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES if r.base)
    said = "concat_ws(':', kind, a::BIGINT, (a + length(h))::BIGINT)"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({" UNION ALL ".join(found)}),
        summed AS (SELECT doc_id, {counts},
                          string_agg({said}, ',' ORDER BY a, no) FILTER (ok AND base) AS base_spans,
                          string_agg({said}, ',' ORDER BY a, no) FILTER (ok) AS spans
                   FROM found GROUP BY doc_id)
        SELECT d.doc_id, {none}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents d LEFT JOIN summed s USING (doc_id)"""


def _licence_scan() -> str:
    notices = ", ".join(
        f"({n}, {_text(name)}, {_text(text)})"
        for n, (name, text) in enumerate((name, t) for name, ts in licences.TEMPLATES.items() for t in ts)
    )
    shingles = """
        SELECT DISTINCT {keys}, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT {keys}, w, unnest(generate_series(1, len(w) - 4)) AS i
              FROM (SELECT {keys}, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM {source}))"""
    return f"""
        WITH notices(n, name, text) AS (VALUES {notices}),
        wanted AS ({shingles.format(keys="n, name", source="notices")}),
        have AS ({shingles.format(keys="doc_id", source="documents")}),
        found AS (SELECT doc_id, n, any_value(name) AS name, count(*) AS hits FROM wanted JOIN have USING (s) GROUP BY doc_id, n),
        enough AS (SELECT DISTINCT doc_id, f.name FROM found f
                   WHERE hits >= {licences.CONTAINED} * (SELECT count(*) FROM wanted w WHERE w.n = f.n)),
        summed AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM enough GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_licences, coalesce(names, '') AS licences
        FROM documents LEFT JOIN summed USING (doc_id)"""


def _quality_rules() -> str:
    limit = quality.RISK / len(quality.GRID)
    tests = sum(map(len, quality.GRID.values()))
    values = {
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "duplicate_lines": "n_dup_lines / nullif(n_lines, 0)",
        "repeated_words": "n_repeat_words / nullif(n_words, 0)",
        "word_length": "word_chars / nullif(n_words, 0)",
    }
    grid = ", ".join(f"('{rule}', {cutoff!r}::DOUBLE)" for rule, cutoffs in quality.GRID.items() for cutoff in cutoffs)
    long = " UNION ALL ".join(f"SELECT doc_id, lang, good, '{r}' AS rule, {v} AS v FROM holdout" for r, v in values.items())
    above = " ".join(f"WHEN {v} > (SELECT cutoff FROM chosen c WHERE c.rule = '{r}' AND c.lang IS NOT DISTINCT FROM m.lang) THEN '{r}'" for r, v in values.items())
    return f"""
        WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        grams AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)),
        twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
        hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
        lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
                  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w)
                  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
        m AS (SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
                     coalesce(l.dup, 0) AS n_dup_lines, coalesce(h.n, 0) AS n_repeat_words,
                     n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
              FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN hit h USING (doc_id)),
        known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
        holdout AS (SELECT m.*, good FROM m JOIN known USING (doc_id) WHERE NOT base_failed),
        long AS ({long}),
        grid(rule, cutoff) AS (VALUES {grid}),
        tested AS (SELECT lang, rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS bad,
                          count(*) FILTER (good AND v > cutoff) AS k, count(*) FILTER (NOT good AND v > cutoff) AS bad_k
                   FROM long JOIN grid USING (rule) GROUP BY ALL),
        strata AS (SELECT count(*) AS s FROM (SELECT DISTINCT lang FROM holdout)),
        tails AS (SELECT *, bad_k / greatest(bad, 1) - {quality.PRICE} * k / nullif(n, 0) AS gain,
                         list_sum(list_transform(generate_series(0, k), lambda i: exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END
                           - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END + i * ln({limit!r}) + (n - i) * ln(1 - {limit!r})))) AS tail
                  FROM tested WHERE n > 0 AND k <= n * {limit!r}),
        chosen AS (SELECT lang, rule, arg_max(cutoff, gain * 1e6 + cutoff * 1e-6) AS cutoff FROM tails, strata
                   WHERE tail <= {quality.ERROR} / greatest(1, s * {tests}) AND gain > 0 GROUP BY lang, rule)
        SELECT *, rejected_by IS NULL AS kept
        FROM (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                     CASE WHEN base_failed THEN 'base' {above} END AS rejected_by FROM m)"""


def _sharding() -> str:
    bits = sharding.HASH_BITS
    return f"""
        WITH h AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, {bits // 4}))::BIGINT AS h,
                          strlen(coalesce(text, '')) AS b FROM documents),
        buckets AS (SELECT d, h >> ({bits} - d) AS p, sum(b) AS bytes, count(*) AS n
                    FROM h, range({bits} + 1) r(d) GROUP BY ALL),
        fits AS (SELECT d, p, bytes <= {sharding.QUERY_LIMIT} OR n = 1 OR d = {bits} AS ok FROM buckets),
        shards AS (SELECT f.d, f.p FROM fits f LEFT JOIN fits u ON u.d = f.d - 1 AND u.p = f.p >> 1
                   WHERE f.ok AND (f.d = 0 OR NOT u.ok))
        SELECT doc_id, b AS n_bytes, d::INTEGER AS depth, 0::BIGINT AS page,
               CASE WHEN d = 0 THEN 'all' ELSE lpad(bin(p), d::INTEGER, '0') END AS shard
        FROM h JOIN shards ON h >> ({bits} - d) = p"""


_DECONTAMINATION = r"""
    WITH texts AS (SELECT 'd' AS kind, doc_id::VARCHAR AS id, text FROM documents
                   UNION ALL SELECT 'i', coalesce(item_id::VARCHAR, ''), text FROM benchmark),
    w AS (SELECT kind, id, row_number() OVER () AS r,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    items AS (SELECT DISTINCT id AS item, least(10, len(w)) AS n, array_to_string(w[i:i + n - 1], ' ') AS s
              FROM (SELECT id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM w WHERE kind = 'i' AND len(w) > 0)),
    lengths AS (SELECT DISTINCT n FROM items),
    places AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
               FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM w, lengths WHERE kind = 'd')),
    found AS (SELECT r, p.n, i, item FROM places p JOIN items USING (n, s)),
    hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
    SELECT id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN hit USING (r) LEFT JOIN named USING (r) WHERE kind = 'd'"""


def _mixing() -> str:
    scale = float(1 << mixing.RANK_BITS)
    return f"""
        WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                              ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS bits
                       FROM documents),
        sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighed AS (SELECT *, [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER]::DOUBLE AS weight,
                           2.0::DOUBLE * source_size AS cap FROM sums),
        levels AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                              - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
                   FROM weighed),
        targets AS (SELECT *, least(cap, max(level) OVER () * weight) AS target FROM levels),
        classes AS (SELECT source, length(bin(size)) AS w, sum(size)::BIGINT AS words FROM sized WHERE size > 0 GROUP BY ALL),
        shares AS (SELECT c.source, w, words, target,
                          (target - 2 * coalesce(sum(words) OVER (PARTITION BY c.source ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                          / (sum(words * w) OVER (PARTITION BY c.source ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
                   FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
        times AS (SELECT source, w, words, target, least(2.0::DOUBLE, max(level) OVER (PARTITION BY source) * w) AS n FROM shares),
        nearly AS (SELECT source, w, words, target, CASE WHEN abs(n - round(n)) < 1e-9 THEN round(n) ELSE n END AS n FROM times),
        chances AS (SELECT source, w, floor(n) AS whole, n - floor(n) AS chance,
                           target - sum(floor(n) * words) OVER (PARTITION BY source) AS rest, target AS goal FROM nearly),
        ranked AS (SELECT s.*, source_size, target, whole, CASE WHEN rest > 1e-9 * goal THEN chance ELSE 0 END AS chance, rest,
                          (bits + 0.5::DOUBLE) / {scale!r}::DOUBLE AS u, (u / (1 - u)) / (c.chance / (1 - c.chance)) AS q,
                          CASE WHEN c.chance > 0 THEN floor(q / (1 + q) * {scale!r}::DOUBLE) END AS rank
                   FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
                   LEFT JOIN chances c ON s.source IS NOT DISTINCT FROM c.source AND length(bin(s.size)) = c.w),
        run AS (SELECT *, sum(CASE WHEN chance > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY chance > 0 DESC, rank, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM ranked)
        SELECT doc_id, size, source_size, target,
               (size * (coalesce(whole, 0) + CASE WHEN chance > 0 AND (upto <= rest OR (upto - size <= rest AND upto - rest <= rest - (upto - size)))
                                             THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM run"""


_SUBSTRING_DEDUP = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS s
                FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM w)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
    gone AS (SELECT doc_id, list(DISTINCT k) AS gone FROM (SELECT doc_id, unnest(generate_series(i, i + 12)) AS k FROM later) GROUP BY doc_id),
    kept AS (SELECT doc_id, array_to_string(list(x ORDER BY k), ' ') AS kept
             FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM w) s
             WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(gone) AS k FROM gone) g WHERE g.doc_id = s.doc_id AND g.k = s.k)
             GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""


#: All pairs, then what each vector reaches.
_NEAR_VECTORS = """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                         WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                           AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    linked AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                            ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a)
    SELECT e.vec_id, (SELECT count(*) FROM linked l WHERE l.a = e.vec_id)::BIGINT AS n_links,
           (SELECT min(b) FROM reached r WHERE r.a = e.vec_id) AS component_id,
           (SELECT min(b) FROM reached r WHERE r.a = e.vec_id) = e.vec_id AS kept
    FROM embeddings e"""

#: Places where 16 words are repeated q words later; every run has them for its q, and stretches of them are runs.
_RUNS = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                      xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                                                               lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS h
               FROM documents),
    g AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS e FROM w),
    t AS (SELECT doc_id, CASE WHEN a IS NULL THEN w
                 ELSE list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // e) END]) END AS w
          FROM g),
    grams AS (SELECT doc_id, i, sha256(array_to_string(w[i + 1:i + 16], ' ')) AS s
              FROM (SELECT doc_id, w, unnest(range(len(w) - 15)) AS i FROM t)),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
    stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length
                  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
                  GROUP BY doc_id, q, island),
    long AS (SELECT * FROM stretches WHERE length >= greatest(24, 3 * q)),
    runs AS (SELECT * FROM long r WHERE NOT EXISTS (
                 SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
    summed AS (SELECT doc_id, count(*) AS n_runs,
                      list({'start': start, 'length': length, 'period': q} ORDER BY length::DOUBLE / q DESC, start, q)[1] AS best,
                      string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS runs
               FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS k FROM runs),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS kept
             FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS k FROM t) p ANTI JOIN gone g USING (doc_id, k)
             GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
           best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM t LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_FILL_IN_MIDDLE = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    r AS (SELECT doc_id, t, length(t) AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d),
    c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
    p AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || x || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
    FROM p"""


ORACLES: dict[str, str] = {
    "op1_secret_scan": _secret_scan(),
    "op5_licence_scan": _licence_scan(),
    "op6_quality_rules": _quality_rules(),
    "op7_extendible_sharding": _sharding(),
    "op8_benchmark_decontamination": _DECONTAMINATION,
    "op9_source_mixing": _mixing(),
    "op10_substring_dedup": _SUBSTRING_DEDUP,
    "op11_embedding_near_dedup": _NEAR_VECTORS,
    "op12_periodic_runs": _RUNS,
    "op13_fill_in_middle": _FILL_IN_MIDDLE,
}
