"""The queries that SQL can express, for DuckDB over views of the raw tables."""

from __future__ import annotations

from . import hard_negatives, mixing, url_reputation
from .common import LOWER, UPPER


def _mixing() -> str:
    parts = mixing.whole_parts(mixing.WEIGHTS, mixing.REST, mixing.CYCLE)
    slots = mixing.cycle_slots(parts)
    rows = ", ".join(f"('{'' if k is None else k}', {n}, {slot}, {len(places)})"
                     for k, places in slots.items() for n, slot in enumerate(places))
    names = ", ".join(f"'{k}'" for k in parts if k is not None)
    return f"""
        WITH cycle(name, n, slot, parts) AS (VALUES {rows}),
        named AS (SELECT doc_id, source, CASE WHEN source IN ({names}) THEN source END AS mix_class FROM documents),
        numbered AS (SELECT *, row_number() OVER (
            PARTITION BY mix_class ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS mix_number FROM named)
        SELECT doc_id, source, mix_class, mix_number, mix_number // {mixing.BLOCK_ROWS} AS mix_block,
               mix_number // {mixing.BLOCK_ROWS} // parts * {mixing.CYCLE} + slot AS mix_slot,
               mix_number % {mixing.BLOCK_ROWS} AS mix_place
        FROM numbered JOIN cycle
          ON name = coalesce(mix_class, '') AND n = mix_number // {mixing.BLOCK_ROWS} % parts"""


def _urls() -> str:
    u = url_reputation
    rules = sorted(u.RULES, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules))
    shared = ", ".join(f"'{name}'" for name in u.SHARED_SUFFIXES)
    said = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, rules))
    return f"""
        WITH parts AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                                 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        placed AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS host,
                   substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path
            FROM parts),
        marked AS (SELECT doc_id AS page_id, CASE WHEN min(quality) > 0 THEN 1 ELSE 0 END AS good
                   FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
        hosts AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good
                  FROM placed LEFT JOIN marked USING (page_id) GROUP BY host),
        sums AS (SELECT count(*) AS k, sum(n) AS n, sum(good) AS g, sum(n * (good / n) * (good / n)) AS npp,
                        sum(1.0 / n) AS inverse FROM hosts WHERE n > 0),
        moments AS (SELECT *, g / n AS p, k * (npp - n * (g / n) * (g / n)) / ((k - 1) * n) AS spread FROM sums),
        prior AS (
            SELECT (coalesce(g, 0) + 1.0) / (coalesce(n, 0) + 1.0) AS share,
                   least(greatest(CASE WHEN k > 1 AND spread - p * (1.0 - p) * inverse / k > 0
                                       THEN (p * (1.0 - p) - spread) / (spread - p * (1.0 - p) * inverse / k)
                                       ELSE {u.UNKNOWN} END, {u.WEAKEST}), {u.STRONGEST}) AS strength FROM moments),
        names AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM hosts),
        ends AS (SELECT *, array_to_string(string_split(name, '.')[-2:], '.') AS last_two,
                        regexp_matches(name, '{u.IP_HOST}') AS address FROM names),
        seen AS (SELECT host, n, good, CASE WHEN address THEN name WHEN last_two IN ({shared})
                            THEN array_to_string(string_split(name, '.')[-3:], '.') ELSE last_two END AS domain,
                        CASE WHEN address THEN '{u.IP_SUFFIX}' WHEN last_two IN ({shared}) THEN last_two
                             ELSE string_split(name, '.')[-1] END AS suffix FROM ends),
        suffixes AS (SELECT suffix, (sum(good) + any_value(strength * share)) / (sum(n) + any_value(strength)) AS above
                     FROM seen, prior GROUP BY suffix),
        domains AS (SELECT domain, (sum(good) + any_value(strength * above)) / (sum(n) + any_value(strength)) AS mean
                    FROM seen JOIN suffixes USING (suffix), prior GROUP BY domain),
        rated AS (SELECT host, n, strength, (good + strength * mean) / (n + strength) AS rate
                  FROM seen JOIN domains USING (domain), prior),
        bounds AS (SELECT host, rate - {u.Z} * sqrt(rate * (1.0 - rate) / (n + strength + 1.0)) AS bound FROM rated)
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {said} WHEN bound < {u.LEAST_GOOD} THEN 'block' ELSE 'allow' END AS verdict,
               round(bound, 6) AS bound
        FROM placed JOIN bounds USING (host)"""


def _hard_negatives() -> str:
    h = hard_negatives
    return f"""
        WITH parts AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor({h.SCALE} * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                   CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM parts a JOIN parts b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {h.POSITIVES})
        SELECT anchor_id, positive_id, CAST(row_number() OVER (
                   PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND {h.LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {h.HIGH_PERCENT} * positive_score
        QUALIFY rank <= {h.NEGATIVES}"""


def _exact_duplicates() -> str:
    return f"""
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""


def oracle_sql() -> dict[str, str]:
    return {"op7_mixing": _mixing(), "op10_url_reputation": _urls(), "op11_hard_negatives": _hard_negatives(),
            "op13_exact_duplicates": _exact_duplicates()}
