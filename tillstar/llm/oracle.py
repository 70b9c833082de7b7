"""DuckDB SQL of the native operators whose results SQL can compute.

The values of the operators' parameters are those that ``queries.py`` uses.
"""

from __future__ import annotations

from .decontam import MASKS, SHORT, SPAN

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_templates(rules: list[tuple[str, str]], max_depth: int = 8, min_labelled: int = 5,
                  z: float = 1.96, smoothing: float = 10.0, min_purity: float = 0.5) -> str:
    """Level by level, as the operator goes: one pair of tables per depth."""
    fits, verdicts = [], []
    for what, text in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = text.partition("/")
        test = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}')"
        fits.append(f"WHEN {test} THEN '{text}'")
        verdicts.append(f"WHEN {test} THEN '{what}'")
    levels = []
    for d in range(max_depth + 1):
        levels.append(f"""
        child{d} AS MATERIALIZED (
            SELECT host, tpl, segs[{d + 1}] AS seg, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad
            FROM level{d} WHERE len(segs) > {d} GROUP BY ALL),
        parent{d} AS (
            SELECT host, tpl, sum(n)::BIGINT AS all_n, sum(bad)::BIGINT AS all_bad FROM child{d} GROUP BY ALL),
        known{d} AS (
            SELECT *, all_n - n AS rest_n, all_bad / all_n AS pooled,
                abs(bad / n - (all_bad - bad) / nullif(all_n - n, 0)) AS gap
            FROM child{d} JOIN parent{d} USING (host, tpl) WHERE n >= {min_labelled}),
        own{d} AS MATERIALIZED (
            SELECT host, tpl, seg FROM known{d} WHERE rest_n > 0 AND gap > 0
                AND gap >= {z}::DOUBLE * sqrt(pooled * (1 - pooled) * (1 / n + 1 / rest_n))),
        level{d + 1} AS MATERIALIZED (
            SELECT l.host, l.segs, l.n, l.bad, CASE WHEN len(l.segs) <= {d} THEN l.tpl ELSE list_append(l.tpl,
                CASE WHEN o.seg IS NOT NULL OR l.segs[{d + 1}] = '**' THEN l.segs[{d + 1}] ELSE '*' END) END AS tpl
            FROM level{d} l LEFT JOIN own{d} o ON o.host = l.host AND o.tpl = l.tpl AND o.seg = l.segs[{d + 1}]),""")
    last, c = f"level{max_depth + 1}", f"{smoothing}::DOUBLE"
    return f"""
        WITH shown AS (
            SELECT page_id, regexp_extract(url, '/([0-9]{{1,18}})(?:[.]html|/)?(?:[?#].*)?$', 1) AS n FROM pages),
        lab AS (
            SELECT page_id, max((quality = 0 OR toxic = 1)::INT) AS bad
            FROM shown JOIN labels ON labels.doc_id = TRY_CAST(nullif(shown.n, '') AS BIGINT)
            WHERE page_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY page_id),
        rests AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rests),
        paths AS (
            SELECT page_id, translate(h, {_LOWER}) AS host,
                regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM parts),
        cut AS (
            SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
                lambda s: regexp_replace(s, '[0-9]+', '#', 'g')) AS every FROM paths),
        judged AS MATERIALIZED (
            SELECT cut.page_id, host, path, lab.bad,
                CASE WHEN len(every) > {max_depth} THEN list_append(every[1:{max_depth}], '**') ELSE every END AS segs
            FROM cut LEFT JOIN lab USING (page_id)),
        level0 AS MATERIALIZED (
            SELECT host, segs, count(bad) AS n, sum(coalesce(bad, 0))::BIGINT AS bad, []::VARCHAR[] AS tpl
            FROM judged GROUP BY host, segs),{"".join(levels)}
        corpus AS (
            SELECT CASE WHEN sum(n) > 0 THEN (sum(n) - sum(bad))::BIGINT / sum(n)::BIGINT ELSE 1 END AS share FROM {last}),
        templates AS (SELECT host, tpl, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM {last} GROUP BY ALL),
        hosts AS (
            SELECT host, (sum(n)::BIGINT - sum(bad)::BIGINT + {c} * any_value(share)) / (sum(n)::BIGINT + {c}) AS prior
            FROM templates, corpus GROUP BY host),
        scored AS (
            SELECT host, tpl, (n - bad + {c} * prior) / (n + {c}) AS purity FROM templates JOIN hosts USING (host)),
        found AS (
            SELECT j.page_id, j.host, j.path, j.host || '/' || coalesce(array_to_string(l.tpl, '/'), '') AS template, s.purity
            FROM judged j JOIN {last} l ON l.host = j.host AND l.segs = j.segs
                JOIN scored s ON s.host = l.host AND s.tpl = l.tpl)
        SELECT page_id, host, path, CASE {" ".join(fits)} END AS rule,
            CASE {" ".join(verdicts)} WHEN purity < {min_purity} THEN 'block' ELSE 'allow' END AS verdict, template, purity
        FROM found"""


def spaced_seeds(window: int = 15, similarity: float = 0.8) -> str:
    """The same masks on the words themselves, and every placement compared."""
    def words(x: str) -> str:
        return f"list_filter(string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"

    def seeds(table: str, key: str) -> str:
        one = " UNION ALL ".join(
            f"SELECT {key}, {k} AS mask, unnest(range(len(w) - {SPAN - 1})) AS pos, unnest(list_transform("
            f"range(len(w) - {SPAN - 1}), lambda i: {' || chr(32) || '.join(f'w[i + {o + 1}]' for o in mask)})) AS seed "
            f"FROM {table} WHERE len(w) >= {SPAN if table == 'd' else SHORT}" for k, mask in enumerate(MASKS))
        one += "".join(
            f" UNION ALL SELECT {key}, {-n} AS mask, unnest(range(len(w) - {n - 1})) AS pos, unnest(list_transform("
            f"range(len(w) - {n - 1}), lambda i: array_to_string(w[i + 1:i + {n}], ' '))) AS seed FROM {table} WHERE len(w) "
            + (f">= {n} AND EXISTS (SELECT 1 FROM i WHERE len(i.w) = {n})" if table == "d" else f"= {n}") for n in range(1, SHORT))
        return f"(SELECT {key}, mask, pos, md5_number(seed) AS seed FROM ({one}))"

    return f"""
        WITH d AS MATERIALIZED (SELECT doc_id, {words("text")} AS w FROM documents WHERE doc_id IS NOT NULL),
        i AS MATERIALIZED (SELECT DISTINCT item_id, {words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
        hits AS MATERIALIZED (
            SELECT DISTINCT x.doc_id, y.item_id, x.pos - y.pos AS shift
            FROM {seeds("d", "doc_id")} x JOIN {seeds("i", "item_id")} y USING (mask, seed)),
        placed AS (
            SELECT doc_id, item_id, greatest(shift, 0) AS f, greatest(-shift, 0) AS skip, d.w AS dw, i.w AS iw,
                least(len(d.w) - greatest(shift, 0), len(i.w) - greatest(-shift, 0)) AS n, least(len(i.w), {window}) AS need
            FROM hits JOIN d USING (doc_id) JOIN i USING (item_id)),
        cut AS (
            SELECT doc_id, item_id, f, n, need, dw[f + 1:f + n] AS a, iw[skip + 1:skip + n] AS b FROM placed WHERE n >= need),
        equal AS (
            SELECT doc_id, item_id, f, n, need, list_transform(range(n), lambda k: (a[k + 1] = b[k + 1])::INT) AS eq FROM cut),
        rated AS (
            SELECT doc_id, item_id, f, n, list_sum(eq) AS equal_words,
                list_max(list_transform(range(n - need + 1), lambda s: list_sum(eq[s + 1:s + need]))) / need AS similarity
            FROM equal),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, equal_words DESC, n, f) AS place
            FROM rated WHERE similarity >= {similarity}::DOUBLE)
        SELECT doc_id, item_id, similarity, equal_words::BIGINT AS equal_words, n::BIGINT AS placed_words,
            f::BIGINT AS first_word
        FROM ranked WHERE place = 1"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, unsigned, bit by bit."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), "
            "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))")


def lower_az(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def merkle(fanout: int = 16) -> str:
    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in fields) + ")"

    def tree(name: str, start: str, part: str) -> str:
        key = f"{part}, " if part else ""
        return f"""
        {name} AS (
            SELECT 0 AS level, {key}pos, size, hash FROM {start}
            UNION ALL
            SELECT level + 1, {key}pos // {fanout}, (size + {fanout - 1}) // {fanout}, sha256(string_agg(hash, '' ORDER BY pos))
            FROM {name} WHERE size > 1 GROUP BY level, {key}size, pos // {fanout}),
        {name}_steps AS (
            SELECT level, {key}pos, {{'a': '', 'l': coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
                   'r': coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')}} AS step
            FROM {name} WHERE size > 1 WINDOW w AS (PARTITION BY level, {key}pos // {fanout} ORDER BY pos))"""

    return f"""
        WITH RECURSIVE hashed AS (
            SELECT doc_id, coalesce('=' || source, '') AS g, {leaf('text')} AS hash,
                   CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 AND text IS NOT NULL THEN {leaf(lower_az('text'))} END AS changed
            FROM documents),
        leaves AS (
            SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos,
                   count(*) OVER (PARTITION BY g) AS size FROM hashed),
        {tree('low', 'leaves', 'g')},
        roots AS (SELECT g, hash, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS size FROM low WHERE size = 1),
        {tree('top', 'roots', '')},
        steps AS (
            SELECT rid, level, step FROM leaves l JOIN low_steps s ON s.g = l.g AND s.pos = l.pos // ({fanout} ** level)::BIGINT
            UNION ALL
            SELECT rid, 1000 + level, step FROM leaves l JOIN roots r USING (g) JOIN top_steps s ON s.pos = r.pos // ({fanout} ** level)::BIGINT),
        ways AS (SELECT rid, list(step ORDER BY level) AS way FROM steps GROUP BY rid),
        folded AS (
            SELECT l.*, coalesce(way, []) AS way, list_reduce(list_prepend({{'a': coalesce(changed, hash), 'l': '', 'r': ''}}, coalesce(way, [])),
                   lambda x, y: {{'a': sha256(y.l || x.a || y.r), 'l': '', 'r': ''}}).a AS folded_root
            FROM leaves l LEFT JOIN ways USING (rid))
        SELECT f.doc_id, f.hash AS leaf, r.hash AS subroot, t.hash AS root, f.pos AS position,
               sha256(array_to_string(list_transform(way, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = t.hash AS verified
        FROM folded f JOIN roots r USING (g) CROSS JOIN (SELECT hash FROM top WHERE size = 1) t
    """


def source_divergence(least_docs: int = 30, top: int = 50) -> str:
    def share(count: str, n: str) -> str:
        return f"1 + (1000000000::HUGEINT * ({count} + 5)) // ({n} + 5 * v)"

    return f"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({lower_az("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs
              FROM (SELECT rid, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
        k AS (SELECT lang, term, sum(n) AS n_term FROM c GROUP BY ALL HAVING sum(docs) >= {least_docs}),
        x AS (SELECT lang, source, term, coalesce(n, 0) AS n, n_term, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS n_all,
                     sum(n_term) OVER (PARTITION BY lang, source) AS n_lang, count(*) OVER (PARTITION BY lang, source) AS v
              FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (SELECT lang, source, term, n, {share('n', 'n_all')} AS p, {share('n_term', 'n_lang')} AS q FROM x),
        r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(pa.p - pb.p)), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN p pa ON pa.lang = a.lang AND pa.source = a.source
            LEFT JOIN p pb ON pb.lang = b.lang AND pb.source = b.source AND pb.term = pa.term GROUP BY ALL
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
        WHERE part = 'pair' OR rank <= {top}
    """
