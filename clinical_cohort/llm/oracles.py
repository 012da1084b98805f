"""DuckDB SQL for the queries that SQL can express."""

from . import licenses, quality, secrets, warc

_STOPS = ", ".join("'" + w + "'" for w in sorted({w for ws in quality.STOP_WORDS.values() for w in ws}))

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN cov USING (doc_id)
), f AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m
)
SELECT *, (NOT base_failed
           AND 2 * word_chars >= 3 * n_words AND word_chars <= 25 * n_words
           AND 10 * n_symbols <= n_words
           AND (n_words < 50 OR 100 * n_stop_words >= n_words)
           AND (n_words < 50 OR 2 * n_dup_lines <= n_lines)) AS kept
FROM f
"""


def _secret_part(order: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind, i, s + coalesce(before, 0) AS s, s + coalesce(before, 0) + len AS e
  FROM (SELECT doc_id, i, piece_sum AS s, length(m) AS len, length(v) AS vlen,
               sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
        FROM (SELECT doc_id, i, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS piece_sum, m, v
              FROM (SELECT doc_id, unnest(string_split_regex(t, '{pattern}')) AS p,
                           unnest(regexp_extract_all(t, '{pattern}', 0)) AS m,
                           unnest(regexp_extract_all(t, '{pattern}', {rule.group})) AS v,
                           unnest(generate_series(1, len(string_split_regex(t, '{pattern}')))) AS i
                    FROM d WHERE regexp_matches(t, '{pattern}'))))
  WHERE len IS NOT NULL AND vlen >= {rule.min_length}"""


def _secret_text(where: str) -> str:
    return f"""coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) FILTER (WHERE {where}), '')"""


_BASE = ", ".join(f"'{r.kind}'" for r in secrets.BASE)

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_secret_part(i, r) for i, r in enumerate(secrets.RULES))})
SELECT d.doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)},
       sha256({_secret_text(f"kind IN ({_BASE})")}) AS base_sha256, {_secret_text("kind IS NOT NULL")} AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
        FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN win USING (n, s)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

WARC = f"""
WITH n AS (SELECT greatest(1, ceil(count(*) / {warc.RECORDS_PER_FILE}.0))::BIGINT AS files FROM pages),
p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, count(*) AS copies FROM pages GROUP BY ALL
), r AS (
  SELECT page_id, copies, sha256(url || chr(10) || html) AS i,
         'WARC/1.1{{r}}WARC-Type: response{{r}}WARC-Record-ID: <urn:uuid:' AS h1, url, html FROM p
), t AS (
  SELECT page_id, copies, replace(h1 || substr(i, 1, 8) || '-' || substr(i, 9, 4) || '-' || substr(i, 13, 4) || '-'
           || substr(i, 17, 4) || '-' || substr(i, 21, 12) || '>{{r}}WARC-Date: {warc.WARC_DATE}{{r}}WARC-Target-URI: ', '{{r}}',
           chr(13) || chr(10)) || url || chr(13) || chr(10) || 'WARC-Payload-Digest: sha256:' || sha256(html)
         || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
         || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS bytes FROM r
), d AS (
  SELECT page_id, copies, strlen(bytes)::BIGINT AS length, sha256(bytes) AS digest FROM t
), f AS (
  SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT % (SELECT files FROM n) AS file,
         ('0x' || substr(digest, 9, 8))::BIGINT % 500 AS fate FROM d
)
SELECT file, (sum(length) OVER (PARTITION BY file ORDER BY digest, page_id) - length)::BIGINT AS "offset", length, page_id, copies,
       digest, CASE WHEN fate IN (0, 1) THEN 'changed' WHEN fate = 2 THEN 'missing' ELSE 'ok' END AS status
FROM f
"""


def _license_view(name: str, wrapped: bool) -> str:
    t = r"regexp_replace(t, '[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*', ' ', 'g')" if wrapped else "t"
    known = ", ".join(f"'{v}': '{k}'" for k, v in licenses.SENTENCES.items())
    lower = f"translate(x, '{licenses.UPPER}', '{licenses.LOWER}')"
    return rf"""
{name} AS (
  SELECT doc_id, list_filter(list_transform(list_filter(list_transform(
           string_split(regexp_replace({t}, '([.!?;])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)),
           lambda x: trim(regexp_replace({lower}, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> ''),
         lambda x: coalesce((MAP {{{known}}})[x], '-')), lambda x: true) AS ids FROM d
)"""


def _license_found() -> str:
    after, tests = licenses.longer(), []
    for r in licenses.RULES:
        sequence = "s"
        for x in after[r.sentences]:
            sequence = f"regexp_replace({sequence}, '{licenses.sequence_pattern(x)}', ',', 'g')"
        tests.append(f"CASE WHEN regexp_matches({sequence}, '{licenses.sequence_pattern(r)}') THEN '{r.license}' END")
    return f"list_distinct(list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL))"


def _license_shorter() -> str:
    """Whether licence x is the beginning of a longer one that a cut shows without it."""
    return " OR ".join(f"(x = '{short}' AND ((list_contains(fa, '{long}') AND NOT list_contains(fa, x)) "
                       f"OR (list_contains(fb, '{long}') AND NOT list_contains(fb, x))))" for short, long in licenses.beaten_by())


_SPDX_MAP = ", ".join(f"'{k}': '{v}'" for k, v in licenses.SPDX.items())
_ALONE = ", ".join(f"'{x}'" for x in licenses.ALONE)

LICENSES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_license_view("a", True)}, {_license_view("b", False)},
va AS (SELECT doc_id, len(list_filter(ids, lambda x: x <> '-')) AS na, {_license_found()} AS fa
       FROM (SELECT doc_id, ids, ',' || array_to_string(ids, ',') || ',' AS s FROM a)),
vb AS (SELECT doc_id, len(list_filter(ids, lambda x: x <> '-')) AS nb, {_license_found()} AS fb
       FROM (SELECT doc_id, ids, ',' || array_to_string(ids, ',') || ',' AS s FROM b)),
n AS (SELECT doc_id, list_filter(list_transform(
        flatten(list_transform(regexp_extract_all(t, '{licenses.SPDX_LINE}', 1),
                               lambda x: string_split_regex(translate(x, '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.SPDX_BETWEEN}'))),
        lambda x: (MAP {{{_SPDX_MAP}}})[x]), lambda x: x IS NOT NULL) AS named FROM d),
v AS (SELECT doc_id, greatest(na, nb) AS n_known,
             list_distinct(list_concat(list_filter(list_concat(fa, fb), lambda x: NOT ({_license_shorter()})), named)) AS found
      FROM va JOIN vb USING (doc_id) JOIN n USING (doc_id))
SELECT doc_id, n_known, array_to_string(list_sort(CASE WHEN len(list_filter(found, lambda x: x NOT IN ({_ALONE}))) > 0
         THEN list_filter(found, lambda x: x NOT IN ({_ALONE})) ELSE found END), ',') AS licenses FROM v
"""
