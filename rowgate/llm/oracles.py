"""SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from rowgate.llm.urls import CONTEXT, RULES


def _ruled(shown: str) -> str:
    """The longest fitting rule's text or verdict."""
    cases = []
    for rule in sorted(RULES, key=lambda r: len(r.text), reverse=True):
        fits = f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"
        cases.append(f"WHEN {fits} THEN {repr(rule.text) if shown == 'rule' else rule.allow}")
    return f"CASE {' '.join(cases)} END"


def url_filter() -> str:
    """Counts, interpolated orders and the curve of the URL filter, one common table expression for each."""
    steps = [
        "u1 AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS after_ FROM pages)",
        "u2 AS (SELECT page_id, regexp_extract(after_, '^[^/?#]*') AS raw, after_ FROM u1)",
        "u3 AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,"
        " substring(after_, length(raw) + 1) AS tail FROM u2)",
        "u4 AS (SELECT *, regexp_extract(tail, '^[^?#]*') AS path FROM u3)",
        f"u5 AS MATERIALIZED (SELECT *, {_ruled('rule')} AS rule, {_ruled('allow')} AS allow,"
        " substring(md5(host || tail), 1, 1) < '3' AS held_out,"
        f" repeat(chr(2), {CONTEXT}) || host || tail || chr(3) AS piece, row_number() OVER () AS id FROM u4)",
        f"g AS MATERIALIZED (SELECT id, allow, held_out, unnest([substring(piece, i, {CONTEXT + 1})"
        f" FOR i IN range(1, length(piece) - {CONTEXT} + 1)]) AS gram FROM u5)",
        f"l{CONTEXT} AS MATERIALIZED (SELECT gram, count(*) FILTER (allow AND NOT held_out) AS yes,"
        " count(*) FILTER (NOT allow AND NOT held_out) AS no FROM g GROUP BY gram)",
    ]
    for k in range(CONTEXT - 1, -1, -1):
        steps.append(f"l{k} AS MATERIALIZED (SELECT substring(gram, 2) AS gram, sum(yes) AS yes, sum(no) AS no FROM l{k + 1} GROUP BY 1)")
    for k in range(CONTEXT + 1):
        steps.append(
            f"c{k} AS (SELECT substring(gram, 1, {k}) AS context, sum(yes) AS ny, sum(no) AS nn,"
            f" count(*) FILTER (yes > 0) AS ty, count(*) FILTER (no > 0) AS tn FROM l{k} GROUP BY 1)"
        )
        lower = f"JOIN p{k - 1} b ON b.gram = substring(l.gram, 2)" if k else "CROSS JOIN (SELECT 1.0::DOUBLE / count(*) AS py, 1.0::DOUBLE / count(*) AS pn FROM l0) b"
        steps.append(
            f"p{k} AS MATERIALIZED (SELECT l.gram,"
            " CASE WHEN ny + ty > 0 THEN (yes + ty * b.py) / (ny + ty)::DOUBLE ELSE b.py END AS py,"
            " CASE WHEN nn + tn > 0 THEN (no + tn * b.pn) / (nn + tn)::DOUBLE ELSE b.pn END AS pn"
            f" FROM l{k} l JOIN c{k} c ON c.context = substring(l.gram, 1, {k}) {lower})"
        )
    steps += [
        f"s AS (SELECT id, sum(ln(py) - ln(pn)) / count(*) AS score FROM g JOIN p{CONTEXT} USING (gram) GROUP BY id)",
        "m AS (SELECT count(*) FILTER (allow) AS n1, count(*) FILTER (NOT allow) AS n0, avg(score) FILTER (allow) AS m1,"
        " avg(score) FILTER (NOT allow) AS m0, coalesce(var_pop(score) FILTER (allow), 0) AS v1,"
        " coalesce(var_pop(score) FILTER (NOT allow), 0) AS v0 FROM s JOIN u5 USING (id) WHERE held_out AND allow IS NOT NULL)",
        "k AS (SELECT CASE WHEN n1 > 0 AND n0 > 0 AND n1 * v1 + n0 * v0 > 0 AND m1 > m0"
        " THEN (m1 - m0) * (n1 + n0) / (n1 * v1 + n0 * v0) END AS slope, ln(n1 / n0) AS prior, (m1 + m0) / 2 AS middle"
        " FROM (SELECT n1::DOUBLE AS n1, n0::DOUBLE AS n0, m1, m0, v1, v0 FROM m WHERE n1 > 0 AND n0 > 0))",
        "f AS (SELECT coalesce((SELECT slope FROM k), 1.0) AS slope,"
        " coalesce((SELECT prior - slope * middle FROM k), 0.0) AS shift)",
    ]
    return (
        "WITH " + ", ".join(steps) + " SELECT page_id, host, path, rule,"
        " CASE WHEN coalesce(allow, score * slope + shift >= 0) THEN 'allow' ELSE 'block' END AS verdict"
        " FROM u5 JOIN s USING (id) CROSS JOIN f"
    )
