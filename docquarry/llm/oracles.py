"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import mixing, quality

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _position(knots: tuple, y: str) -> str:
    """``mixing.invert`` in SQL, with the same order of operations."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, done, cases = sum(areas), 0.0, []
    for (t, v), (u, w), area in zip(knots, knots[1:], areas):
        rest = f"({y} * {total!r}::DOUBLE - {done!r}::DOUBLE)"
        root = f"sqrt(greatest({v * v!r}::DOUBLE + {rest} * {2 * (w - v) / (u - t)!r}::DOUBLE, 0.0::DOUBLE))"
        time = f"least({t!r}::DOUBLE + CASE WHEN {rest} > 0 THEN {rest} * 2::DOUBLE / ({root} + {v!r}::DOUBLE) ELSE 0.0::DOUBLE END, {u!r}::DOUBLE)"
        cases.append(f"WHEN {y} * {total!r}::DOUBLE <= {done + area!r}::DOUBLE OR {len(cases) == len(areas) - 1} THEN {time}")
        done += area
    return f"CASE {' '.join(cases)} END"


_SCHEDULES = " ".join(f"WHEN {k} THEN {_position(s, 'y')}" for k, s in enumerate(mixing.SCHEDULES))
_WEIGHT = " ".join(f"WHEN {k} THEN {float(w)!r}::DOUBLE" for k, w in enumerate(mixing.WEIGHTS))

OP1 = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len({WORDS.format('text')}), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS rank FROM s),
w AS (
  SELECT *, CASE rank % {len(mixing.WEIGHTS)} {_WEIGHT} END AS weight, source_size * {float(mixing.MOST)!r}::DOUBLE AS cap,
    (sum(source_size) OVER ())::DOUBLE * {mixing.SHARE!r}::DOUBLE AS demand FROM r),
l AS (
  SELECT *, row_number() OVER o AS place,
    (demand - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
f AS (SELECT min_by(level, place) AS level FROM l WHERE cap / weight > level),
t AS (SELECT l.source, source_size, rank, coalesce(least(cap, f.level * weight), cap) AS target FROM l LEFT JOIN f ON true),
p AS (
  SELECT d.*, source_size, rank, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    floor(round(target, 6) + 0.5)::BIGINT AS goal FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * size
    + least(greatest(goal - CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * source_size - start, 0), size) AS taken,
    start::DOUBLE / greatest(goal, 1)::DOUBLE AS y FROM p)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, CASE WHEN taken > 0 THEN CASE rank % {len(mixing.SCHEDULES)} {_SCHEDULES} END END AS position FROM k"""

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT k, i, array_to_string(w[i : i + 7], ' ') AS x FROM d, unnest(range(1, len(w) - 6)) u(i)),
again AS (SELECT k, x FROM windows GROUP BY k, x HAVING count(*) > 1),
repeated AS (SELECT k, count(DISTINCT j) AS n FROM windows JOIN again USING (k, x), unnest(range(i, i + 8)) v(j) GROUP BY k),
lines AS (SELECT k, line, {WORDS.format('line')} AS words FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)),
full_lines AS (SELECT k, line, len(words) AS n, translate(array_to_string(words, ' '), '{_UPPER}', '{_LOWER}') AS normal FROM lines WHERE len(words) > 0),
dups AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY k),
held AS (SELECT d.source, normal, count(DISTINCT t) AS n FROM full_lines JOIN d USING (k) GROUP BY d.source, normal),
hosts AS (SELECT source, count(*) AS lines_, sum(n) AS documents FROM held GROUP BY source),
common AS (SELECT held.source, normal FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source WHERE n > {quality.MIN_DOCUMENTS} AND n * lines_ > documents * {quality.SPREAD}),
removed AS (SELECT k, sum(n) AS n FROM full_lines JOIN d USING (k) JOIN common ON d.source IS NOT DISTINCT FROM common.source AND full_lines.normal = common.normal GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN dups USING (k) LEFT JOIN repeated USING (k) LEFT JOIN removed USING (k)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND removed_words <= {quality.MAX_REMOVED}::DOUBLE * n_words AS kept FROM b"""

OP7 = f"""
WITH u AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT u.page_id, u.host, u.path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS v
  FROM u LEFT JOIN r ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
  GROUP BY u.page_id, u.host, u.path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS dg FROM p),
q AS (SELECT *, min(page_id) OVER (PARTITION BY dg) AS first FROM d),
b AS (SELECT *, array_to_string([lpad(bin(strpos('0123456789abcdef', substr(dg, k + 1, 1)) - 1), 4, '0') for k in range(40)], '') AS bits FROM q)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
      + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b"""
