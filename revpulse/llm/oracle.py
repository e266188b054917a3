"""DuckDB answers for the operators that SQL can express."""

from __future__ import annotations

from .host_reputation import BOUND, LEAST_GOOD, STRONGEST, WEAKEST, Rule
from .mixing import Weights
from .params import DOMAIN_WEIGHTS, URL_RULES

_WORD = r"[^\x20\x09-\x0D]+"

NGRAM_JACCARD_JOIN = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '{_WORD}') AS words
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(words) >= 5
        THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
    FROM worded
), sized AS (
    SELECT doc_id, shingles, CAST(len(shingles) AS BIGINT) AS n FROM shingled
), posting AS (
    SELECT doc_id, n, unnest(shingles) AS shingle FROM sized
), link AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM posting a JOIN posting b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN link l ON r.other = l.x
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id
FROM sized s JOIN reached r USING (doc_id)
GROUP BY s.doc_id, s.n
"""


def _case(column: str, table: dict, default) -> str:
    quoted = (lambda v: f"'{v}'") if isinstance(default, str) else str
    whens = " ".join(f"WHEN '{k}' THEN {quoted(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {quoted(default)} END" if table else quoted(default)


def _split(level: str, name: str, parent: str, keys: str) -> str:
    """Budgets of the nodes ``name`` from those of ``parent``, by the level to which the budget rises.

    The budget's level is that of the first node, by capacity for each unit of weight, that it does not fill.
    """
    on = f"USING ({keys})" if keys else "ON true"
    by = f"PARTITION BY {keys}" if keys else ""
    path = f"{keys}, {level}" if keys else level
    return f"""
{name}_ranked AS (
    SELECT n.*, p.given - coalesce(sum(capacity) OVER earlier, 0) AS remaining, sum(weight) OVER later AS rest
    FROM {name} n JOIN {parent} p {on}
    WINDOW earlier AS ({by} ORDER BY capacity / CAST(weight AS DOUBLE), {path} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           later AS ({by} ORDER BY capacity / CAST(weight AS DOUBLE), {path} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), {name}_levels AS (
    SELECT {f"{keys}, " if keys else ""}max(rest) FILTER (WHERE remaining * weight < capacity * rest) AS bottom,
           arg_max(remaining, rest) FILTER (WHERE remaining * weight < capacity * rest) AS top
    FROM {name}_ranked {f"GROUP BY {keys}" if keys else ""}
), {name}_given AS (
    SELECT {path}, CAST(CASE WHEN remaining * weight >= capacity * rest THEN capacity
                             ELSE top * weight // bottom END AS HUGEINT) AS given
    FROM {name}_ranked JOIN {name}_levels {on}
)"""


def mixing(weights: Weights, epochs: int = 4, seed: int = 1) -> str:
    """All leaves' budgets, and every document's place in its leaf's epochs by one window."""
    weight = {c: _case(c, getattr(weights, c), weights.other_weight) for c in ("domain", "lang", "source")}
    return rf"""
WITH counted AS (
    SELECT doc_id, {_case("coalesce(source, 'unknown')", weights.domains, weights.other_domain)} AS domain,
           coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS n_tokens
    FROM documents WHERE doc_id IS NOT NULL
), used AS (
    SELECT * FROM counted WHERE n_tokens > 0
), leaf AS (
    SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS supply, {epochs} * CAST(sum(n_tokens) AS HUGEINT) AS capacity,
           CAST({weight["source"]} AS HUGEINT) AS weight
    FROM used GROUP BY domain, lang, source
    HAVING ({weight["domain"]}) * ({weight["lang"]}) * ({weight["source"]}) > 0
), tongue AS (
    SELECT domain, lang, CAST(sum(capacity) AS HUGEINT) AS capacity, CAST({weight["lang"]} AS HUGEINT) AS weight FROM leaf GROUP BY domain, lang
), area AS (
    SELECT domain, CAST(sum(capacity) AS HUGEINT) AS capacity, CAST({weight["domain"]} AS HUGEINT) AS weight FROM leaf GROUP BY domain
), root AS (
    SELECT CAST(least(sum(supply), sum(capacity)) AS HUGEINT) AS given FROM leaf
), {_split("domain", "area", "root", "")}, {_split("lang", "tongue", "area_given", "domain")},
{_split("source", "leaf", "tongue_given", "domain, lang")}
, budget AS (
    SELECT domain, lang, source, CAST(given // supply AS BIGINT) AS whole, CAST(given % supply AS BIGINT) AS over_whole
    FROM leaf JOIN leaf_given USING (domain, lang, source)
), placed AS (
    SELECT u.*, b.over_whole, b.whole AS epoch,
           sum(n_tokens) OVER (PARTITION BY domain, lang, source
               ORDER BY md5('{seed}:' || b.whole || ':' || doc_id), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS before
    FROM used u JOIN budget b USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, CAST(unnest(range(epoch)) AS BIGINT) AS epoch, n_tokens, n_tokens AS taken FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, epoch, n_tokens, CAST(least(n_tokens, over_whole - before) AS BIGINT) AS taken
FROM placed WHERE before < over_whole
"""


def _strength(groups: str) -> str:
    spread = "prior * (1 - prior)"
    missed = "n * (good / n - prior) * (good / n - prior)"
    return f"""SELECT greatest({WEAKEST}, least({STRONGEST}, CASE WHEN sum({missed}) > sum({spread})
        THEN sum({spread} * (n - 1)) / (sum({missed}) - sum({spread})) - 1 ELSE {STRONGEST} END)) AS k
        FROM {groups} WHERE n > 0"""


def url_filters(rules: tuple[Rule, ...]) -> str:
    listed = ", ".join(f"('{r.name}', '{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    return rf"""
WITH rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES {listed}),
located AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail FROM pages
), page AS (
    SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
    FROM located
), outcome AS (
    SELECT p.page_id, avg(l.quality) AS good
    FROM page p JOIN labels l ON TRY_CAST(nullif(regexp_extract(p.path, '/([0-9]{{1,18}})', 1), '') AS BIGINT) = l.doc_id
    WHERE l.quality IS NOT NULL GROUP BY p.page_id
), host0 AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0.0) AS good FROM page LEFT JOIN outcome USING (page_id) GROUP BY host
), host1 AS (
    SELECT *, split_part(host, '.', -1) AS suffix,
           CASE WHEN instr(host, '.') > 0 THEN split_part(host, '.', -1) || '.' || split_part(host, '.', -2) ELSE host END AS site
    FROM host0
), site0 AS (SELECT suffix, site, sum(n) AS n, sum(good) AS good FROM host1 GROUP BY suffix, site),
suffix0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM site0 GROUP BY suffix),
suffix1 AS (SELECT *, (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5) FROM suffix0) AS prior FROM suffix0),
suffix2 AS (SELECT suffix, (good + prior * k) / (n + k) AS prior FROM suffix1, ({_strength("suffix1")})),
site1 AS (SELECT site, n, good, prior FROM site0 JOIN suffix2 USING (suffix)),
site2 AS (SELECT site, (good + prior * k) / (n + k) AS prior FROM site1, ({_strength("site1")})),
host2 AS (SELECT host, n, good, prior FROM host1 JOIN site2 USING (site)),
host3 AS (SELECT host, n + k AS after, (good + prior * k) / (n + k) AS mean FROM host2, ({_strength("host2")})),
fitting AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
    FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN mean - {BOUND} * sqrt(mean * (1 - mean) / (after + 1)) >= {LEAST_GOOD} THEN 'allow' ELSE 'block' END) AS verdict
FROM page JOIN host3 USING (host) LEFT JOIN fitting USING (page_id)
"""


QUALITY_RULES = rf"""
WITH worded AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), token AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM worded
), windowed AS (
    SELECT doc_id, pos, word, lead(word) OVER following AS second, lead(word, 2) OVER following AS third
    FROM token WINDOW following AS (PARTITION BY doc_id ORDER BY pos)
), hashed AS (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, word, second, third) AS times FROM windowed WHERE third IS NOT NULL
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place FROM hashed WHERE times >= 2) GROUP BY doc_id
), stretched AS (
    SELECT doc_id, count(*) AS n_distinct_words FROM (SELECT DISTINCT doc_id, (pos - 1) // 1000 AS stretch, word FROM token) GROUP BY doc_id
), lined AS (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM worded
), counted AS (
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
           CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
           length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS n_beyond_ascii,
           len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
           coalesce(d.n_distinct_words, 0) AS n_distinct_words
    FROM worded w JOIN lined l USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN stretched d USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR n_upper > n_lower + n_beyond_ascii OR 10 * n_dup_lines > 4 * n_lines
            OR 10 * n_letter_words < 7 * n_words OR 10 * n_distinct_words < n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words AND 2 * n_beyond_ascii < word_chars) AS kept
FROM judged
"""


def centroid_clustering(clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Every round as two steps: each vector's nearest centroid, then each centroid's exact means."""

    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
    SELECT r, min({{'distance': distance, 'j': j}}) AS best
    FROM (SELECT r, j, CAST(list_sum(list_transform(list_zip(kept.v, c{k}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
          FROM kept CROSS JOIN c{k})
    GROUP BY r
)"""

    def moved(k: int) -> str:
        return f"""c{k + 1} AS MATERIALIZED (
    SELECT j, coalesce(m.v, c{k}.v) AS v
    FROM c{k} LEFT JOIN (
        SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
        FROM (SELECT j, i, sum(x) AS s, count(*) AS n
              FROM (SELECT best.j AS j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k} JOIN kept USING (r))
              GROUP BY j, i)
        GROUP BY j) m USING (j)
)"""

    steps = ", ".join(f"{nearest(k)}, {moved(k)}" for k in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY hash, v) - 1 AS INTEGER) AS j, v
    FROM (SELECT sha256('{seed}:' || vec_id) AS hash, v FROM kept ORDER BY hash, v LIMIT {clusters})
), {steps}, {nearest(rounds)}
SELECT vec_id, best.j AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.j = best.j
"""


def statements() -> dict[str, str]:
    return {
        "op1_mixing": mixing(DOMAIN_WEIGHTS),
        "op5_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
        "op6_url_filters": url_filters(URL_RULES),
        "op10_quality_rules": QUALITY_RULES,
        "op13_centroid_clustering": centroid_clustering(),
    }
