"""SQL for DuckDB that gives the rows of corpus queries that need no tokenizer, learnt model or index."""

from __future__ import annotations

from fundlake.llm.mixing import DOMAINS, LEAF, WEIGHTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Every 50-byte string with the smallest doc_id that holds it; windows held earlier cover bytes, covered bytes make islands.
REPEATS = """
WITH docs AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS raw, strlen(coalesce(text, '')) AS n_bytes FROM documents),
windows AS MATERIALIZED (
    SELECT doc_id, pos, raw[pos + 1 : pos + 50] AS w FROM docs, unnest(range(0, greatest(n_bytes - 49, 0))) AS u(pos)),
firsts AS (SELECT w, min(doc_id) AS owner FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS opens
    FROM windows JOIN firsts USING (w) WHERE owner < doc_id),
numbered AS (SELECT doc_id, pos, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM hits),
islands AS (SELECT doc_id, island, min(pos) AS first, max(pos) + 50 AS stop FROM numbered GROUP BY ALL),
gaps AS (
    SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY first), 0) AS a, first AS b FROM islands
    UNION ALL SELECT doc_id, coalesce(max(stop), 0), max(n_bytes) FROM docs LEFT JOIN islands USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, sum(b - a) AS n_kept, count(*) - 1 AS n_spans, string_agg(hex(raw[a + 1 : b]), '' ORDER BY a) AS digits
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_bytes, CAST(n_bytes - n_kept AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(digits)) AS kept_sha256
FROM docs JOIN kept USING (doc_id)
"""

#: Shingle sets, every pair with a shingle in common, links by the contract's inequality, reachability.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS u(i)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach AS (
    SELECT doc_id, doc_id AS c FROM documents
    UNION SELECT e.x, reach.c FROM reach JOIN (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links) e ON e.y = reach.doc_id),
least_reached AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_reached LEFT JOIN sizes USING (doc_id)
"""


def _cases(level: str) -> str:
    known = " ".join(f"WHEN '{name}' THEN {w}" for name, w in WEIGHTS[level].items())
    return f"CASE {level} {known} ELSE 1 END" if known else "1"


def mixture(percent: int = 60, epochs: int = 3, seed: int = 17) -> str:
    """Budgets level by level.  A node is full if the level to which its parent's budget fills its siblings, each up to its
    capacity, is at its brim: the sum over siblings of least(capacity, weight * level) at that level is within the budget."""
    domain = f"CASE WHEN regexp_matches(source, '[0-9]{{1,9}}$') THEN ['{"', '".join(DOMAINS)}'][CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % {len(DOMAINS)} + 1] ELSE 'none' END"
    parts = [
        f"light AS MATERIALIZED (SELECT doc_id, {domain} AS domain, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, CAST(len({WORDS}) AS BIGINT) AS n_tokens FROM documents)",
        "leaves AS MATERIALIZED (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM light GROUP BY ALL)",
        f"budget0 AS (SELECT 0 AS root, CAST(sum(tokens) AS BIGINT) * {percent} // 100 AS amount FROM leaves)",
    ]
    for i, level in enumerate(LEAF, 1):
        up, keys = ", ".join(["root", *LEAF[: i - 1]]), ", ".join(["root", *LEAF[:i]])
        same = " AND ".join(f"y.{k} = x.{k}" for k in ["root", *LEAF[: i - 1]])
        parts += [
            f"nodes{i} AS MATERIALIZED (SELECT {keys}, capacity, {_cases(level)} AS weight, amount FROM (SELECT 0 AS root, {', '.join(LEAF[:i])}, CAST(sum(tokens) AS BIGINT) * {epochs} AS capacity FROM leaves GROUP BY ALL) JOIN budget{i - 1} USING ({up}))",
            # at x's brim sibling y holds least(y.capacity, y.weight * x.capacity / x.weight); times x.weight to stay in integers
            f"full{i} AS MATERIALIZED (SELECT x.*, (SELECT sum(least(CAST(y.capacity AS HUGEINT) * x.weight, CAST(y.weight AS HUGEINT) * x.capacity)) FROM nodes{i} y WHERE {same}) <= CAST(x.amount AS HUGEINT) * x.weight AS is_full FROM nodes{i} x)",
            f"open{i} AS (SELECT {up}, max(amount) - coalesce(sum(capacity) FILTER (is_full), 0) AS rest, sum(weight) FILTER (NOT is_full) AS weights FROM full{i} GROUP BY {up})",
            f"budget{i} AS MATERIALIZED (SELECT {keys}, CAST(CASE WHEN is_full THEN capacity ELSE weight * rest // weights END AS BIGINT) AS amount FROM full{i} JOIN open{i} USING ({up}))",
        ]
    parts += [
        "plan AS (SELECT domain, lang, source, amount // tokens AS whole, amount % tokens AS rest FROM budget3 JOIN leaves USING (domain, lang, source) WHERE tokens > 0 AND amount > 0)",
        f"ranked AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat('{seed}:', whole + 1, ':', coalesce(CAST(doc_id AS VARCHAR), 'none')))) AS upto FROM light JOIN plan USING (domain, lang, source))",
        "taken AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM ranked)",
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, domain, d.lang AS lang, d.source AS source, n_tokens FROM taken JOIN documents d USING (doc_id), unnest(range(1, times + 1)) AS u(epoch)"


ORACLE_SQL = {"op3_repeated_spans": REPEATS, "op5_source_mixture": mixture(), "op9_near_duplicates": NEAR_DUPLICATES}
