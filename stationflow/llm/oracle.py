"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# words of a text after lower-casing A-Z, as the two contracts define them
_LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce({c}, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op6_prefix_decontamination"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_ALNUM.format(c="text")} AS w FROM documents),
i AS (SELECT cast(item_id AS varchar) AS item_id, {_ALNUM.format(c="text")} AS w FROM benchmark),
iw AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN iw USING (size, shingle)),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY 1),
names AS (SELECT doc_id, list(DISTINCT item_id ORDER BY item_id) AS items FROM hits GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
"""

ORACLE["op1_low_discrepancy_mix"] = f"""
WITH d AS (SELECT doc_id, source, cast(len({_WORDS.format(c="text")}) AS bigint) AS size, md5('mix:' || cast(doc_id AS varchar)) AS key FROM documents),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM d GROUP BY 1),
s1 AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
              row_number() OVER (ORDER BY source NULLS LAST) AS sid, 3 * source_size AS cap FROM s),
s2 AS (SELECT *, cap::double / w AS ratio FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::double
              / sum(w) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
water AS (SELECT ratio AS r, sid AS i, level AS l FROM s3 WHERE ratio >= level ORDER BY ratio, sid LIMIT 1),
goal AS (SELECT source, source_size, CASE WHEN (ratio, sid) < (r, i) THEN cap::double ELSE w * l END AS target FROM s3, water),
line AS (
  SELECT doc_id, d.source, size, source_size, target, least(cast(floor(target + 0.5) AS bigint), 3 * source_size) AS stop,
         cast(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS bigint) - size AS start
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source
)
SELECT doc_id, source, size, source_size, target,
       cast(greatest(0, least(start + size, stop) - start)
          + greatest(0, least(source_size + start + size, stop) - (source_size + start))
          + greatest(0, least(2 * source_size + start + size, stop) - (2 * source_size + start)) AS bigint) AS taken
FROM line
"""

_ESCAPED = "replace(replace(replace({c}, '\\', '\\\\'), '<', '<\\'), '[', '[\\')"
ORACLE["op5_relational_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
b AS (SELECT *, coalesce(lag(role) OVER w <> role, true) AS fresh FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length({_ESCAPED.format(c="text")}) + CASE WHEN fresh THEN length({_ESCAPED.format(c="role")}) + 19 ELSE 6 END) AS bigint) AS formatted_chars
FROM b GROUP BY conv_id
"""

_QUAD = "cast('0x' || substr(sha, 5 * i + 1, 5) AS BIGINT)"  # 20 bits: four base32 digits
_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(({_QUAD} >> {k}) & 31 AS INTEGER) + 1, 1)" for k in (15, 10, 5, 0))
ORACLE["op8_warc_salvage"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, cast(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: {_DIGITS}), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
