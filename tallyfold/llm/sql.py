"""The SQL of the queries that SQL can express, for DuckDB on the same tables.

Mixing depends on a hash of Spark's, packing and alignment on tokenizers, sharding on a search,
licences on a parser, spelling variants on CRC-32 and toxicity on a fitted model: those are
tested in tests/llm against plain versions.
"""

from tallyfold.llm.secret_scan import BASE, RULES

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _plain(pattern: str) -> str:
    """The same pattern without the marks that keep a quantifier from giving back."""
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    return pattern.replace("(?i:password|passwd|secret|token|api_?key)", either).replace("}+", "}")


_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, {place} AS rank, '{r.kind}' AS kind, {r.least} AS least, regexp_split_to_array(t, {_text(_plain(r.pattern))}) AS parts,
    regexp_extract_all(t, {_text(_plain(r.pattern))}) AS whole,
    regexp_extract_all(t, {_text(_plain(r.pattern))}, {r.group}) AS counted FROM texts"""
    for place, r in enumerate(RULES)
)
_BASE = ", ".join(f"'{r.kind}'" for r in BASE)
_JOINED = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
ORACLE["op1_secret_scan"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
each AS (
  SELECT doc_id, rank, kind, least, k, length(whole[k]) AS n, length(counted[k]) AS m,
    list_sum(list_transform(parts[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:k - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS k FROM found)),
spans AS (SELECT doc_id, rank, kind, CAST(a AS BIGINT) AS a, CAST(a + n AS BIGINT) AS b FROM each WHERE m >= least)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce({_JOINED} FILTER (kind IN ({_BASE})), '')) AS base_sha256, coalesce({_JOINED}, '') AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""

ORACLE["op3_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""

_TRIM = r"regexp_replace(l[i + {k}], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
ORACLE["op6_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, {", ".join(f"{_TRIM.format(k=k)} AS w{k}" for k in (1, 2, 3))}
  FROM (SELECT *, unnest(range(0, len(l) - 2)) AS i FROM split)),
later AS (
  SELECT doc_id, i FROM windows WHERE w1 <> '' OR w2 <> '' OR w3 <> ''
  QUALIFY row_number() OVER (PARTITION BY w1, w2, w3 ORDER BY doc_id, i) > 1),
covered AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM later),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS p FROM split),
joined AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) FILTER (c.p IS NULL) AS text, count(c.p) AS n_removed
  FROM lines LEFT JOIN covered c USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CASE WHEN l IS NOT NULL THEN coalesce(text, '') END AS text,
  CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM split LEFT JOIN joined USING (doc_id)
"""

def _components(width: int, percent: int, kept: str = "") -> str:
    """Size of each document's set of shingles, and the smallest doc_id reachable by links."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least({width}, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least({width}, len(w)) + 2)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * met.n >= {percent} * (p.n + q.n - met.n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reached.x, edges.y FROM reached JOIN edges ON reached.y = edges.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id{kept}
FROM documents JOIN reached ON doc_id = x LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


ORACLE["op7_near_copies"] = _components(5, 75, ", doc_id = min(y) AS kept")
ORACLE["op11_ngram_join"] = _components(4, 85)

# The rules of the quality query, written out here: part, whole and step of each signal.
_RATIOS = [
    ("symbol_ratio", "n_symbols", "n_words", 0.05),
    ("dup_line_ratio", "n_dup_lines", "n_lines", 0.05),
    ("repeat_ratio", "n_repeat_words", "n_words", 0.05),
    ("mean_word", "word_chars", "n_words", 0.5),
]
_SIGNALS = ", ".join(
    f"{{'signal': '{name}', 'bucket': CAST(floor(ln(1 + CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) / {step}) / ln(1.01)) AS BIGINT)}}"
    for name, part, whole, step in _RATIOS
)


def _fence(keys: str) -> str:
    """Fence, middle and documents per group, in buckets; `keys` ends in a comma, or is empty."""
    return f"""
  SELECT {keys} signal, total, middle, coalesce(edge,
    CASE WHEN high > low THEN high + greatest(3 * (high - low), 20) ELSE top + greatest(3 * (top - high), 20) END) AS fence
  FROM (
    SELECT {keys} signal, any_value(total) AS total, min(bucket) FILTER (upto >= 0.25 * total) AS low,
      min(bucket) FILTER (upto >= 0.5 * total) AS middle, min(bucket) FILTER (upto >= 0.75 * total) AS high,
      min(bucket) FILTER (upto >= 0.99 * total) AS top, min(bucket) FILTER (upto >= 0.9 * total AND gap >= 139) AS edge
    FROM (
      SELECT *, sum(n) OVER (PARTITION BY {keys} signal ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys} signal) AS total,
        lead(bucket) OVER (PARTITION BY {keys} signal ORDER BY bucket) - bucket AS gap
      FROM (SELECT {keys} signal, bucket, count(*) AS n FROM marks GROUP BY ALL))
    GROUP BY {keys} signal)"""


ORACLE["op9_quality"] = rf"""
WITH read AS (
  SELECT doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM read)))
    WHERE n > 1) GROUP BY doc_id),
copies AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM read)
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, t, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(copies.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    CAST(len(string_split(t, chr(10))) AS BIGINT) AS n_lines
  FROM read LEFT JOIN repeats USING (doc_id) LEFT JOIN copies USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
signals AS (SELECT doc_id, lang, source, t, base_failed, unnest([{_SIGNALS}], recursive := true) FROM judged),
marks AS (SELECT DISTINCT lang, source, t, signal, bucket FROM signals WHERE NOT base_failed),
own AS ({_fence("lang, source,")}),
by_lang AS ({_fence("lang,")}),
overall AS ({_fence("")}),
wider AS (
  SELECT own.*, CASE WHEN by_lang.total >= 100 THEN by_lang.fence ELSE overall.fence END AS wide
  FROM own JOIN by_lang ON own.lang = by_lang.lang AND own.signal = by_lang.signal JOIN overall ON own.signal = overall.signal),
fences AS (
  SELECT lang, source, signal,
    CASE WHEN total < 100 THEN wide WHEN middle <= wide THEN least(fence, wide) ELSE fence END AS fence FROM wider),
above AS (
  SELECT DISTINCT doc_id FROM signals JOIN fences USING (lang, source, signal) WHERE bucket > fences.fence)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM above) AS kept FROM judged
"""
