"""SQL of the adapters, as parts of WITH clauses for the checks."""

from __future__ import annotations

from stepmark.functions.sizes import CONVERSION_MAX_PIXELS, CONVERSION_MIN_PIXELS
from stepmark.functions.text import TOKEN_PATTERN
from stepmark.plans.adapters import BASE, REMOTE

ITEMS = """
docs AS (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS k FROM docs),
items AS (
  SELECT doc_id, 0 AS msg, 0 AS pos, 'system' AS role, 'text' AS type,
         source AS text, NULL::VARCHAR AS image, NULL::BIGINT AS idx FROM documents
  UNION ALL
  SELECT doc_id, 1 + 2*k, 0, 'user', 'text',
         CASE WHEN (doc_id + k) % 11 <> 0 THEN line END, NULL, NULL FROM lines
  UNION ALL
  SELECT doc_id, 1, 1, 'user', 'image', NULL,
         CASE WHEN doc_id % 5 <> 0 THEN '<image>' END, doc_id % 3 FROM documents
  UNION ALL
  SELECT doc_id, 2 + 2*k, 0, 'assistant', 'text',
         CASE WHEN substr(md5(concat(doc_id, '-', k)), 1, 1) < '8' THEN '<+>' ELSE '<->' END,
         NULL, NULL FROM lines
),
usable AS (
  SELECT * FROM items
  WHERE (type = 'text' AND text IS NOT NULL) OR (type = 'image' AND image IS NOT NULL)
)"""

IMAGES = f"""
imgs AS (
  SELECT doc_id, n, concat('{REMOTE}', doc_id, '/', n, '.png') AS uri,
         concat('{BASE}/', doc_id, '/', n, '.png') AS path
  FROM documents, range(3) t(n) WHERE n < doc_id % 4
),
listing AS (SELECT path FROM imgs WHERE (doc_id * 7 + n) % 10 <> 0)"""

RESOLVED = """
resolved AS (
  SELECT i.doc_id, i.msg, i.pos, i.role, i.type, i.text, g.uri AS image
  FROM items i LEFT JOIN imgs g ON i.type = 'image' AND g.doc_id = i.doc_id AND g.n = i.idx
  WHERE (i.type = 'text' AND i.text IS NOT NULL) OR (i.type = 'image' AND g.uri IS NOT NULL)
)"""


def render(items: str, order: str, out: str) -> str:
    """The rendered text of each example from a table of items."""
    return f"""
{out}_msgs AS (
  SELECT doc_id, msg, any_value(role) AS role,
         string_agg(CASE WHEN type = 'image' THEN '<image>' ELSE text END, '' ORDER BY {order}) AS body
  FROM {items} GROUP BY doc_id, msg
),
{out} AS (
  SELECT doc_id, string_agg('<|' || role || '|>' || chr(10) || body || '<|end|>' || chr(10), '' ORDER BY msg) AS text
  FROM {out}_msgs GROUP BY doc_id
)"""


MEDIA_FIRST = "CASE WHEN type = 'image' THEN 0 ELSE 1 END, pos"
RENDERED = ITEMS + "," + render("usable", MEDIA_FIRST, "rendered")
TOKENS = RENDERED + f""",
toks AS (SELECT doc_id, regexp_extract_all(text, '{TOKEN_PATTERN}', 1) AS t FROM rendered),
tok AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM toks)"""
VOCAB = TOKENS + """,
vocab AS (
  SELECT token, (row_number() OVER (ORDER BY n DESC, token) - 1)::INTEGER AS token_id
  FROM (SELECT token, count(*) AS n FROM tok GROUP BY token)
)"""
PAD_ID = "(SELECT count(*) FROM vocab)"
# One hash per example over all items of its messages, in order, NULL told from empty.
MESSAGES = """
hashes AS (
  SELECT doc_id, md5(string_agg(concat_ws('|', role, type, coalesce('=' || text, '-'), coalesce('=' || image, '-'),
                                          coalesce('=' || idx, '-')), chr(10) ORDER BY msg, pos)) AS messages
  FROM items GROUP BY doc_id
)"""
ENCODED = VOCAB + """,
enc AS (
  SELECT doc_id, pos, token, v.token AS known, coalesce(v.token_id, -1) AS id
  FROM tok LEFT JOIN vocab v USING (token)
),
lab AS (
  SELECT *, CASE WHEN known IN ('<+>', '<->') THEN id ELSE -100 END AS label FROM enc
)"""
# On their own so that a hash order can be put next to any of the above.
ORDERED = """
ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5(concat(doc_id, '-42-0')), doc_id) - 1 AS idx FROM documents
)"""
RUN_LOG = """
log AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
         ts, value AS loss
  FROM events
)"""
DIMS = """
dims AS (
  SELECT l_orderkey, l_linenumber,
         1 + (l_orderkey * 37) % 4000 AS height,
         1 + (l_partkey * 53) % 4000 AS width,
         CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber * 3136 END AS min_pixels,
         CASE WHEN l_linenumber % 3 = 0 THEN l_linenumber * 78400 END AS max_pixels,
         CASE WHEN l_suppkey % 2 = 0 THEN 1 + (l_suppkey * 31) % 2000 END AS resized_height,
         CASE WHEN l_suppkey % 3 = 0 THEN 1 + (l_suppkey * 17) % 2000 END AS resized_width
  FROM lineitem
)"""


def planned_side(
    side: str, h: str = "height", w: str = "width", low: str = str(CONVERSION_MIN_PIXELS), high: str = str(CONVERSION_MAX_PIXELS)
) -> str:
    """Planned length of one side, NULL where the aspect is rejected."""

    def rounded(s: str) -> str:
        return f"greatest(28, CAST(round_even(CAST({s} AS DOUBLE) / 28, 0) * 28 AS BIGINT))"

    area = f"(CAST({h} AS DOUBLE) * {w})"
    return f"""CASE
      WHEN greatest({h}, {w})::DOUBLE / least({h}, {w}) > 200 THEN NULL
      WHEN {rounded(h)} * {rounded(w)} > {high}
        THEN greatest(28, CAST(floor({side} / sqrt({area} / {high}) / 28) * 28 AS BIGINT))
      WHEN {rounded(h)} * {rounded(w)} < {low}
        THEN CAST(ceil({side} * sqrt({low} / {area}) / 28) * 28 AS BIGINT)
      ELSE {rounded(side)} END"""


# Pixels of the drawn images, one row per pixel and channel: gray has channel 0 three times,
# alpha (channel 3) is laid on white.
PIXELS = """
img AS (
  SELECT vec_id, (vec_id % 3)::INTEGER AS kind, embedding,
         CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 4 END AS height,
         CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 16 END AS width
  FROM embeddings
),
lv AS (
  SELECT vec_id, kind, i, unnest([0, 1, 2]) AS c,
         list_transform(embedding, lambda x: ((floor(x::DOUBLE * 1000)::BIGINT % 256) + 256) % 256) AS l
  FROM img, range(64) t(i)
),
px AS (
  SELECT vec_id, i, c,
         CASE kind WHEN 0 THEN l[i + 1]
                   WHEN 1 THEN l[(i + c) % 64 + 1]
                   ELSE (l[(i + c) % 64 + 1] * l[(i + 3) % 64 + 1]
                         + 255 * (255 - l[(i + 3) % 64 + 1]) + 127) // 255 END AS v
  FROM lv
)"""

# The PAM files: their raw samples, their bytes as hexadecimal digits, and the RGB pixels of whole ones.
PICTURES = """
pic AS (
  SELECT vec_id, [1, 3, 4][(vec_id % 3 + 1)::INTEGER] AS depth,
         CASE WHEN vec_id % 25 = 3 THEN 1 WHEN vec_id % 2 = 0 THEN 8 ELSE 4 END AS height,
         CASE WHEN vec_id % 25 = 3 THEN 256 WHEN vec_id % 2 = 0 THEN 8 ELSE 16 END AS width,
         list_transform(embedding, lambda x: ((floor(x::DOUBLE * 1000)::BIGINT % 256) + 256) % 256) AS l
  FROM embeddings
),
raw AS (
  SELECT vec_id, i, c, l[(i + c) % 64 + 1] AS v FROM pic, range(256) p(i), range(4) q(c)
  WHERE i < height * width AND c < depth
),
bodies AS (SELECT vec_id, string_agg(lpad(upper(to_hex(v)), 2, '0'), '' ORDER BY i, c) AS body FROM raw GROUP BY vec_id),
picture_bytes AS (
  SELECT vec_id, upper(hex(encode(concat('P7', chr(10), 'WIDTH ', width, chr(10), 'HEIGHT ', height, chr(10), 'DEPTH ', depth,
         chr(10), 'MAXVAL 255', chr(10), 'TUPLTYPE ', ['GRAYSCALE', 'RGB', '', 'RGB_ALPHA'][CASE depth WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 4 END], chr(10),
         CASE WHEN vec_id % 50 = 7 THEN '' ELSE 'ENDHDR' || chr(10) END))))
         || CASE WHEN vec_id % 50 = 7 THEN '' ELSE body END AS bytes
  FROM pic JOIN bodies USING (vec_id)
),
rgb AS (
  SELECT p.vec_id, i, c, height, width,
         CASE depth WHEN 1 THEN l[i % 64 + 1]
                    WHEN 3 THEN l[(i + c) % 64 + 1]
                    ELSE (l[(i + c) % 64 + 1] * l[(i + 3) % 64 + 1] + 255 * (255 - l[(i + 3) % 64 + 1]) + 127) // 255 END AS v
  FROM pic p, range(256) s(i), range(3) t(c) WHERE i < height * width AND vec_id % 50 <> 7
)"""


def picked(base: str) -> str:
    """CTE outcome(doc_id, messages, vec_id, reason) of the examples with pictures, files under `base`."""
    return f"""
last_ref AS (
  SELECT doc_id, messages, CASE WHEN doc_id % 4 > 0 THEN (doc_id * 7 + (doc_id % 4 - 1) * 13) % 1100 END AS n FROM hashes
),
outcome AS (
  SELECT doc_id, messages, n,
         CASE WHEN n IS NULL THEN 'no image'
              WHEN doc_id % 10 = 9 THEN 'not found: {base}/' || (n % 10) || '/gone' || n || '.pam'
              WHEN vec_id IS NULL THEN 'not found: {base}/' || (n % 10) || '/' || n || '.pam'
              WHEN n % 50 = 7 THEN 'not an image: {base}/' || (n % 10) || '/' || n || '.pam'
              WHEN n % 25 = 3 THEN 'aspect ratio' END AS reason
  FROM last_ref LEFT JOIN embeddings ON vec_id = n
)"""
