"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import warc

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_UNITS = {"line": r"[^\n]+\n*|\n+", "sentence": r"[^\n.!?]+[\n.!?]*|[\n.!?]+"}


def _repeats(kinds: tuple[str, ...], min_words: int) -> str:
    """Repeated units of each kind, which is ranked apart."""
    pieces = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, regexp_extract_all(text, '{_UNITS[k]}') AS p FROM documents" for k in kinds)
    return rf"""
WITH pieces AS ({pieces}),
cut AS (SELECT doc_id, kind, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM pieces),
placed AS (
  SELECT doc_id, kind, piece, sum(length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY k)::BIGINT AS stop FROM cut),
plain AS (
  SELECT doc_id, kind, stop - length(piece) AS "start", stop AS "end",
         trim(regexp_replace(translate(piece, '{_UPPER}', '{_LOWER}'), '[ \t\r\n\f\v]+', ' ', 'g'), ' .!?') AS unit
  FROM placed),
counted AS (
  SELECT *, (CASE WHEN unit = '' THEN 0 ELSE length(unit) - length(replace(unit, ' ', '')) + 1 END)::INT AS n_words FROM plain),
ranked AS (
  SELECT *, row_number() OVER w AS r, first_value(doc_id) OVER w AS kept_id, first_value("start") OVER w AS kept_start
  FROM counted WHERE n_words >= {min_words} WINDOW w AS (PARTITION BY kind, unit ORDER BY doc_id, "start"))
SELECT doc_id, "start", "end", n_words, kept_id, kept_start FROM ranked WHERE r > 1
"""


_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.component_id
FROM sets s JOIN (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""


def _quoted(text: str) -> str:
    parts = text.replace("'", "''").split("\n")
    return "(" + " || chr(10) || ".join(f"'{p}'" for p in parts) + ")" if len(parts) > 1 else f"'{parts[0]}'"


def _decoded(x: str) -> str:
    for entity, char in warc.ENTITIES:
        x = f"replace({x}, {_quoted(entity)}, {_quoted(char)})"
    return x


def _text(x: str) -> str:
    for pattern in warc.DROPPED:
        x = f"regexp_replace({x}, {_quoted(pattern)}, '', 'g')"
    x = f"regexp_replace({x}, {_quoted(warc.BREAKS)}, chr(10), 'g')"
    x = _decoded(f"regexp_replace({x}, {_quoted(warc.TAG)}, '', 'g')")
    for pattern, blank in warc.BLANKS:
        x = f"regexp_replace({x}, {_quoted(pattern)}, {_quoted(blank) if blank != chr(10) else 'chr(10)'}, 'g')"
    return f"trim({x}, ' ' || chr(10))"


def _uuid(x: str) -> str:
    return f"regexp_replace(md5({x}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '<urn:uuid:\\1-\\2-\\3-\\4-\\5>')"


def _sha1(x: str) -> str:
    groups = " || ".join(f"to_base(('0x' || substr(sha1({x}), {10 * k + 1}, 10))::BIGINT, 32, 8)" for k in range(4))
    return f"'sha1:' || translate({groups}, '{warc.CONV32}', '{warc.BASE32}')"


_CRLF = "chr(13) || chr(10)"
_WARC = f"""
WITH base AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html,
         {_uuid("'response|' || page_id || '|' || coalesce(url, '')")} AS refers_to,
         'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: ' || strlen(coalesce(html, '')) AS source_headers
  FROM pages),
read AS (
  SELECT *, {_sha1("html")} AS payload_digest, {_text("html")} AS text,
         trim(regexp_replace({_decoded(f"regexp_extract(html, {_quoted(warc.TITLE)}, 1)")}, '\\s+', ' ', 'g')) AS title,
         regexp_extract(html, {_quoted(warc.LANG)}, 1) AS lang, len(regexp_extract_all(html, {_quoted(warc.LINK)}, 1)) AS links
  FROM base),
records AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'title: ' || title || {_CRLF} || 'language: ' || lang || {_CRLF} || 'outlinks: ' || links || {_CRLF} || 'source-payload-digest: '
         || payload_digest || {_CRLF} || 'source-header: ' || replace(source_headers, {_CRLF}, {_CRLF} || 'source-header: ') || {_CRLF} AS block FROM read
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', text FROM read)
SELECT page_id, record_type, {_uuid("record_type || '|' || refers_to")} AS record_id, refers_to, target_uri, '{warc.EPOCH}' AS date, content_type,
       source_headers, payload_digest, {_sha1("block")} AS block_digest, strlen(block)::BIGINT AS content_length, block
FROM records
"""

SQL: dict[str, str] = {
    "op3_unit_dedup": _repeats(("sentence",), 8),
    "op3_line_sentence_dedup": _repeats(("line", "sentence"), 1),
    "op5_warc_derivatives": _WARC,
    "op6_ngram_jaccard": _JACCARD,
}
