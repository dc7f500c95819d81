"""SQL twins of the registered queries, where SQL can say them."""

from __future__ import annotations

from panelspark.llm import secret_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, least(13, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM i)),
dw AS (
  SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM i))),
h AS (SELECT DISTINCT doc_id, s, m, item_id FROM dw JOIN iw USING (m, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM h) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def _spans(kind: int, pattern: str, group: int, least: int, extra: str = "") -> str:
    """Rows (doc_id, source, lang, kind, start, stop, value) of one kind's matches."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, lang, {kind} AS kind, z - len AS start, z AS stop, value FROM (
    SELECT doc_id, source, lang, value, length(m) AS len,
      sum(gap + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS z FROM (
      SELECT doc_id, source, lang, i, ms[i] AS m, vs[i] AS value, length(gaps[i]) AS gap FROM (
        SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
          SELECT doc_id, source, lang, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS ms,
            regexp_extract_all(t, '{p}', {group}) AS vs
          FROM d WHERE regexp_matches(t, '{p}')))))
  WHERE length(value) >= {least} {extra}"""


_MIXED = "AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]')"

OP2 = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
base AS ({_spans(0, secret_scan.ASSIGN, 2, secret_scan.LEAST_VALUE)} UNION ALL
  {_spans(1, secret_scan.ACCESS, 0, secret_scan.LEAST_ACCESS)} UNION ALL {_spans(2, secret_scan.HEX, 0, 24)}),
own AS (SELECT * FROM ({_spans(3, secret_scan.OWNED, 0, 24, _MIXED)}) o WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.start < o.stop AND o.start < b.stop)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM own),
held AS (
  SELECT value, count(DISTINCT coalesce(source, '')) <= {secret_scan.MOST_OWNERS}
    AND count(DISTINCT coalesce(source, '') || '/' || coalesce(lang, '')) <= {secret_scan.MOST_REPOSITORIES} AS live
  FROM spans GROUP BY value),
kept AS (
  SELECT doc_id, kind, start, live, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || CAST(start AS BIGINT) || ':'
    || CAST(stop AS BIGINT) AS said
  FROM spans JOIN held USING (value) WHERE kind < 3 OR live),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind < 3 AND live) AS n_live,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM documents LEFT JOIN told USING (doc_id)
"""


def _best_shard(shards: int) -> str:
    bids = ", ".join(
        f"{{'bid': ln((('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{s}'), 1, 13))::BIGINT + 1)::DOUBLE "
        f"/ {16 ** 13}.0), 'shard': {-s}}}" for s in range(shards)
    )
    return f"CAST(-list_max([{bids}]).shard AS INTEGER)"


def _crc_steps() -> list[int]:
    """CRC-32 of each byte, by the reversed polynomial."""
    steps = list(range(256))
    for _ in range(8):
        steps = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in steps]
    return steps


_CRC = f"""xor(list_reduce(
  list_transform(range(0, strlen(t)), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
  lambda crc, b: xor(crc >> 8, list_extract(CAST({_crc_steps()} AS BIGINT[]), (xor(crc, b) & 255) + 1)),
  4294967295::BIGINT), 4294967295)"""

OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
told AS (
  SELECT doc_id, CAST(strlen(t) + 1 AS BIGINT) AS size, CAST({_CRC} AS BIGINT) AS text_crc32,
    {_best_shard(8)} AS shard, {_best_shard(9)} AS grown_shard
  FROM d)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS BIGINT) AS slot
FROM told
"""

OP4 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
