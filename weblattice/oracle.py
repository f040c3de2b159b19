"""DuckDB twins of the registered queries (test oracle).

Written independently of the Spark code paths: plain SQL over the same
parquet views. Iterative jobs are unrolled into one materialized CTE per
round. Column names match ``weblattice.catalog``.
"""

from __future__ import annotations

from . import catalog as c

D = "::DOUBLE"
TELEPORT_COMPUTED = f"(1{D} - 0.85{D})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _java_split_space(s: str) -> str:
    return (f"CASE WHEN {s} = '' THEN [''] WHEN rtrim({s}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({s}, ' '), ' ') END")


def _java_split_comma(s: str) -> str:
    t = f"regexp_replace({s}, ',+$', '')"
    return f"CASE WHEN {s} = '' THEN [''] WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split({t}, ',') END"


def _java_split_ws(s: str) -> str:
    t = f"regexp_replace({s}, '\\s+$', '')"
    return f"CASE WHEN {s} = '' THEN [''] WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split_regex({t}, '\\s+') END"


LINES = ("lines AS (SELECT unnest(CASE WHEN text IS NULL OR text = '' THEN []::VARCHAR[] "
         "ELSE string_split_regex(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') END) "
         "AS value FROM documents)")
TOKENS = f"toks AS (SELECT unnest({_java_split_space('value')}) AS word FROM lines)"
COUNTS = "counts AS (SELECT word, count(*) AS n FROM toks GROUP BY word)"

TAGS = "html, '<(a|div|html|meta) [a-z]+=\"([^\"]*)\"'"
CRAWL = ("tags AS (SELECT regexp_extract(url, '://([^/]+)', 1) AS url, html LIKE '%</html>' AS complete, "
         f"list_append(regexp_extract_all({TAGS}, 1), 'a') AS types, "
         f"list_append(regexp_extract_all({TAGS}, 2), regexp_extract(url, 'ref=([A-Za-z0-9]*)', 1)) AS refs FROM pages), "
         "crawl AS (SELECT url, complete, len(types) AS n_all, "
         "[refs[i] FOR i IN range(1, len(types) + 1) IF types[i] = 'a'] AS hrefs FROM tags)")
KEEP = "keep AS (SELECT url, list_filter(hrefs, lambda h: h <> '') AS links FROM crawl WHERE complete)"
NOCOMMA = ("nocomma AS (SELECT url, list_filter(hrefs, lambda h: h <> '' AND NOT contains(h, ',')) AS links "
           "FROM crawl WHERE complete)")
SENT = ("sent AS (SELECT CASE WHEN complete THEN url ELSE 'random' END AS url, "
        "CASE WHEN complete THEN list_filter(hrefs, lambda h: h <> '' AND NOT contains(h, ',')) "
        "ELSE ['random'] END AS links FROM crawl)")

LO = ("lo AS (SELECT l_partkey, l_suppkey, l_returnflag, o_custkey FROM lineitem "
      "JOIN orders ON l_orderkey = o_orderkey)")
TRADE = ("trade AS ("
         "SELECT 'c:' || CAST(o_custkey AS VARCHAR) AS src, 'p:' || CAST(l_partkey AS VARCHAR) AS dst FROM lo "
         "UNION ALL SELECT 'p:' || CAST(l_partkey AS VARCHAR), 's:' || CAST(l_suppkey AS VARCHAR) FROM lineitem "
         "UNION ALL SELECT 's:' || CAST(l_suppkey AS VARCHAR), 'c:' || CAST(o_custkey AS VARCHAR) FROM lo "
         "WHERE l_returnflag = 'R' "
         "UNION ALL SELECT 'c:' || CAST(c_custkey AS VARCHAR), 'n:' || CAST(c_nationkey AS VARCHAR) FROM customer)")
SHELF = ("trade AS (SELECT 'l:' || lang AS src, 'd:' || CAST(doc_id AS VARCHAR) AS dst FROM documents "
         "UNION ALL SELECT 'd:' || CAST(doc_id AS VARCHAR), 's:' || source FROM documents "
         "UNION ALL SELECT 's:' || source, 'l:' || lang FROM documents)")
LI_EDGES = ("li_edges AS (SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst "
            "FROM lineitem)")


def _merged(src: str, dedupe: bool) -> list[str]:
    rows = f"SELECT url, unnest(links) AS link FROM {src}"
    if dedupe:
        e = f"medges AS (SELECT DISTINCT url, link, 1::BIGINT AS n FROM ({rows}))"
    else:
        e = f"medges AS (SELECT url, link, count(*) AS n FROM ({rows}) GROUP BY url, link)"
    empty = (f"mempty AS (SELECT DISTINCT url, NULL::VARCHAR AS link, 0::BIGINT AS n FROM {src} "
             f"WHERE url NOT IN (SELECT url FROM medges))")
    return [e, empty]


def _rows_of(src: str, dedupe: bool) -> list[str]:
    return _merged(src, dedupe) + [
        f"adj AS (SELECT url, 1.0{D} AS rank, link, n FROM medges UNION ALL SELECT url, 1.0{D}, 'dangling', n FROM mempty)"]


def _rank_table(rank_field: str, tolerant: bool) -> str:
    links_text = "array_to_string(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), ',')"
    if tolerant:
        rank = f"coalesce(TRY_CAST(NULLIF({rank_field}, '') AS DOUBLE), 1.0{D})"
    else:
        rank = f"CAST({rank_field} AS DOUBLE)"
    links = f"CASE WHEN lt = '' THEN NULL ELSE {_java_split_comma('lt')} END"
    return (f"SELECT url, rank, array_to_string(links, '|') AS links, len(links) AS n_links FROM ("
            f"SELECT url, {rank} AS rank, {links} AS links FROM ("
            f"SELECT url, {links_text} AS lt FROM pages))")


def _active(rounds: int, graph: tuple[str, ...] = (LO, TRADE)) -> list[str]:
    ctes = [*graph,
            "e AS MATERIALIZED (SELECT DISTINCT src, dst FROM trade)",
            f"d AS MATERIALIZED (SELECT src, count(*){D} AS deg FROM e GROUP BY src)",
            f"r0 AS MATERIALIZED (SELECT src AS node, 1.0{D} AS rank FROM d)"]
    for i in range(rounds):
        ctes.append(
            f"r{i + 1} AS MATERIALIZED (SELECT e.dst AS node, 0.15{D} + sum(r.rank * (1{D} / d.deg)) * 0.85{D} "
            f"AS rank FROM e JOIN d USING (src) JOIN r{i} r ON r.node = e.src GROUP BY e.dst)")
    return ctes


ALL_SOURCES = [LO, TRADE,
               f"e AS MATERIALIZED (SELECT src, dst, count(*){D} AS n FROM trade GROUP BY src, dst)",
               "d AS MATERIALIZED (SELECT src, sum(n) AS deg FROM e GROUP BY src)",
               f"r0 AS MATERIALIZED (SELECT src AS node, 1.0{D} AS rank, true AS has_links FROM d)"]
BARE_TABLE = [
    "lt AS (SELECT url, array_to_string(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), ',') AS lt FROM pages)",
    f"lines AS MATERIALIZED (SELECT url, CASE WHEN lt = '' THEN NULL ELSE {_java_split_comma('lt')} END AS links FROM lt)",
    f"e AS MATERIALIZED (SELECT src, dst, count(*){D} AS n FROM (SELECT url AS src, unnest(links) AS dst FROM lines) GROUP BY src, dst)",
    "d AS MATERIALIZED (SELECT src, sum(n) AS deg FROM e GROUP BY src)",
    f"r0 AS MATERIALIZED (SELECT url AS node, 1.0{D} AS rank, url IN (SELECT src FROM d) AS has_links, "
    "bool_and(links IS NULL) AS self_vote FROM lines GROUP BY url)"]


def _all_nodes(rounds: int, compat: bool, start: list[str] = ALL_SOURCES) -> list[str]:
    ctes = list(start)
    for i in range(rounds):
        extra = ""
        if compat and i == 0 and start is BARE_TABLE:
            extra = " UNION ALL SELECT node, rank, false FROM r0 WHERE self_vote"
        if compat and i > 0:
            extra = f" UNION ALL SELECT 'dangling', rank, false FROM r{i} WHERE NOT has_links"
        ctes.append(
            f"r{i + 1} AS MATERIALIZED (SELECT node, {TELEPORT_COMPUTED} + 0.85{D} * sum(c) AS rank, "
            f"bool_or(hl) AS has_links FROM ("
            f"SELECT e.dst AS node, r.rank * (e.n / d.deg) AS c, false AS hl "
            f"FROM e JOIN d USING (src) JOIN r{i} r ON r.node = e.src "
            f"UNION ALL SELECT node, 0.0{D}, has_links FROM r{i}{extra}) GROUP BY node)")
    return ctes


def _dangling(rounds: int, round_mass: bool = True, compat: bool = False) -> list[str]:
    ctes = [CRAWL, SENT,
            "pg AS MATERIALIZED (SELECT DISTINCT url AS node FROM sent)",
            "e AS MATERIALIZED (SELECT DISTINCT url AS src, link AS dst FROM "
            "(SELECT url, unnest(links) AS link FROM sent))",
            f"d AS MATERIALIZED (SELECT src, count(*){D} AS deg FROM e GROUP BY src)",
            f"r0 AS MATERIALIZED (SELECT node, 1.0{D} AS rank, node IN (SELECT src FROM d) AS has_links FROM pg)"]
    for i in range(rounds):
        raw = f"coalesce(sum(rank) FILTER (WHERE NOT has_links), 0{D})"
        mass = f"floor({raw} + 0.5{D})" if round_mass else raw
        extra = f" UNION ALL SELECT 'dangling', rank, false FROM r{i} WHERE NOT has_links" if compat and i else ""
        ctes += [
            f"m{i} AS MATERIALIZED (SELECT {mass} AS mass, {raw} AS raw FROM r{i})",
            f"s{i + 1} AS MATERIALIZED (SELECT node, sum(c) AS s, bool_or(hl) AS has_links FROM ("
            f"SELECT e.dst AS node, r.rank * (1{D} / d.deg) AS c, false AS hl "
            f"FROM e JOIN d USING (src) JOIN r{i} r ON r.node = e.src "
            f"UNION ALL SELECT node, 0.0{D}, has_links FROM r{i}{extra}) GROUP BY node)",
            f"n{i + 1} AS MATERIALIZED (SELECT count(*) AS nodes FROM s{i + 1})",
            f"r{i + 1} AS MATERIALIZED (SELECT node, {TELEPORT_COMPUTED} + 0.85{D} * "
            f"(s + (SELECT mass FROM m{i}) / (SELECT nodes FROM n{i + 1})) AS rank, has_links FROM s{i + 1})",
        ]
    return ctes


R6 = "round(rank, 6) AS rank"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["tokenize_lines"] = _with(LINES, TOKENS) + "SELECT word FROM toks"
    q["tokenize_lines_blank_tail"] = _with(
        LINES.replace("FROM documents", "FROM (SELECT text || chr(10) || chr(10) AS text FROM documents)"), TOKENS) + "SELECT word FROM toks"
    q["word_count"] = _with(LINES, TOKENS, COUNTS) + "SELECT word, n FROM counts"
    q["word_count_pairs_text"] = _with(LINES, TOKENS, COUNTS) + \
        "SELECT '(' || word || ',' || CAST(n AS VARCHAR) || ')' AS value FROM counts"
    q["edge_parse"] = _with(LI_EDGES) + "SELECT src, dst FROM li_edges"
    q["edge_distinct"] = _with(LI_EDGES) + "SELECT DISTINCT src, dst FROM li_edges"
    q["adjacency"] = _with(LI_EDGES, "de AS (SELECT DISTINCT src, dst FROM li_edges)") + \
        "SELECT src, dst, count(*) OVER (PARTITION BY src) AS deg FROM de"
    q["part_file_select"] = (
        "SELECT name FROM (SELECT 'metadata-' || printf('%05d', page_id) AS name FROM pages) "
        "WHERE regexp_extract(name, 'metadata-00(\\d{3})', 1) <> '' "
        "AND CAST(regexp_extract(name, 'metadata-00(\\d{3})', 1) AS INTEGER) "
        f"BETWEEN {c.PART_RANGE[0]} AND {c.PART_RANGE[1]}")
    q["rank_tsv_parse"] = _rank_table("'1.0'", tolerant=False)
    q["rank_parse_tolerant"] = _rank_table("regexp_extract(url, 'page=(\\d+)', 1)", tolerant=True)
    q["crawl_parse"] = _with(CRAWL) + (
        "SELECT url, CASE WHEN complete THEN n_all END AS n_links, NOT complete AS bad FROM crawl")
    view = "SELECT url, array_to_string(links, '|') AS links, len(links) AS n_links FROM "
    q["crawl_links"] = _with(CRAWL, KEEP) + view + "keep"
    q["crawl_links_no_comma"] = _with(CRAWL, NOCOMMA) + view + "nocomma"
    q["crawl_links_sentinel"] = _with(CRAWL, SENT) + view + "sent"
    q["adjacency_merge_concat"] = _with(CRAWL, KEEP, *_merged("keep", False)) + \
        "SELECT url, link, n FROM medges UNION ALL SELECT url, link, n FROM mempty"
    q["adjacency_merge_union"] = _with(CRAWL, SENT, *_merged("sent", True)) + \
        "SELECT url, link, n FROM medges UNION ALL SELECT url, link, n FROM mempty"
    q["clean_crawl"] = _with(CRAWL, KEEP, *_rows_of("keep", False)) + "SELECT url, rank, link, n FROM adj"
    q["clean_crawl_dedup"] = _with(CRAWL, SENT, *_rows_of("sent", True)) + "SELECT url, rank, link, n FROM adj"
    field = "replace(replace(replace(replace({}, chr(92), chr(92) || chr(92)), chr(9), chr(92) || 't'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r')"
    q["adjacency_text"] = _with(CRAWL, KEEP, *_rows_of("keep", False)) + (
        f"SELECT chr(9) || '+' || chr(9) || {field.format('url')} || chr(9) || CAST(rank AS VARCHAR) || chr(9) || {field.format('link')} "
        "|| chr(9) || CAST(n AS VARCHAR) AS value FROM adj")
    q["initial_ranks"] = _with(LO, TRADE) + f"SELECT DISTINCT src AS node, 1.0{D} AS rank FROM trade"
    q["out_degree"] = _with(LO, TRADE) + "SELECT src, count(*) AS deg FROM trade GROUP BY src"
    q["dangling_nodes"] = _with(LO, TRADE) + \
        "SELECT DISTINCT dst AS node FROM trade WHERE dst NOT IN (SELECT src FROM trade)"
    act1 = _active(1)
    q["contributions"] = _with(*act1[:-1]) + \
        f"SELECT e.src, e.dst AS node, round(1.0{D} * (1{D} / d.deg), 6) AS c FROM e JOIN d USING (src)"
    q["contribution_sums"] = _with(*act1[:-1]) + \
        f"SELECT e.dst AS node, round(sum(1.0{D} * (1{D} / d.deg)), 6) AS s FROM e JOIN d USING (src) GROUP BY e.dst"
    q["rank_step"] = _with(*act1) + f"SELECT node, {R6} FROM r1"
    q["rank_step_all_nodes"] = _with(*_all_nodes(1, False)) + f"SELECT node, {R6} FROM r1"
    q["rank_step_dangling"] = _with(*_dangling(1)) + f"SELECT node, {R6} FROM r1"
    dg0 = _dangling(0)
    q["key_counts"] = _with(*dg0) + (
        "SELECT node, sum(c) AS n FROM (SELECT node, 1::BIGINT AS c FROM r0 "
        "UNION ALL SELECT dst AS node, 1::BIGINT FROM e) GROUP BY node")
    q["node_count"] = _with(*dg0) + \
        "SELECT count(DISTINCT node) AS nodes FROM (SELECT node FROM r0 UNION ALL SELECT dst FROM e)"
    q["dangling_mass"] = _with(*_dangling(1)) + \
        f"SELECT floor(coalesce(sum(rank) FILTER (WHERE NOT has_links), 0{D}) + 0.5{D}) AS dangling_mass FROM r1"
    dg = _dangling(c.ROUNDS_DANGLING)
    q["rank_lookup"] = _with(*dg) + f"SELECT node, {R6} FROM r{c.ROUNDS_DANGLING} WHERE node = '{c.LOOKUP_KEY}'"
    q["rank_lookup_pruned"] = q["rank_lookup"]
    q["rank_lookup_mapped"] = _with(*_dangling(1), f"k AS (SELECT '{c.LOOKUP_KEY}' AS node)") + (
        "SELECT r.node, NULL::VARCHAR AS src, round(r.rank / coalesce(d.deg, 1), 6) AS value, 1::BIGINT AS n "
        "FROM r1 r JOIN k USING (node) LEFT JOIN d ON d.src = r.node "
        "UNION ALL SELECT e.dst, e.src, round(r.rank / d.deg, 6), 1::BIGINT FROM e JOIN k ON e.dst = k.node "
        "JOIN d ON d.src = e.src JOIN r1 r ON r.node = e.src")
    q["rank_round_metrics"] = _with(*dg) + " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS round, (SELECT nodes FROM n{i + 1}) AS nodes, "
        f"round((SELECT mass FROM m{i}), 6) AS dangling_mass, "
        f"round((SELECT raw FROM m{i}), 6) AS dangling_mass_raw"
        for i in range(c.ROUNDS_DANGLING))
    act = _active(c.ROUNDS_ACTIVE)
    q["pagerank_active"] = _with(*act) + f"SELECT node, {R6} FROM r{c.ROUNDS_ACTIVE}"
    q["rank_report"] = _with(*act) + \
        f"SELECT node || ' has rank: ' || CAST(round(rank, 6) AS VARCHAR) || '.' AS value FROM r{c.ROUNDS_ACTIVE}"
    q["pagerank_all_nodes"] = _with(*_all_nodes(c.ROUNDS_TABLE, False)) + \
        f"SELECT node, {R6} FROM r{c.ROUNDS_TABLE}"
    q["pagerank_all_nodes_compat"] = _with(*_all_nodes(c.ROUNDS_TABLE, True)) + \
        f"SELECT node, {R6} FROM r{c.ROUNDS_TABLE}"
    q["pagerank_hubs"] = _with(*_active(c.ROUNDS_ACTIVE, (SHELF,))) + f"SELECT node, {R6} FROM r{c.ROUNDS_ACTIVE}"
    q["pagerank_table_compat"] = _with(*_all_nodes(c.ROUNDS_COMPAT, True, BARE_TABLE)) + \
        f"SELECT node, {R6} FROM r{c.ROUNDS_COMPAT}"
    q["pagerank_dangling_compat"] = _with(*_dangling(c.ROUNDS_DANGLING + 1, compat=True)) + \
        f"SELECT node, {R6} FROM r{c.ROUNDS_DANGLING + 1}"
    q["pagerank_dangling"] = _with(*dg) + f"SELECT node, {R6} FROM r{c.ROUNDS_DANGLING}"
    q["node_dictionary"] = _with(LO, TRADE) + (
        "SELECT node, row_number() OVER (ORDER BY node) - 1 AS id FROM "
        "(SELECT src AS node FROM trade UNION SELECT dst FROM trade)")
    q["pagerank_active_ids"] = q["pagerank_active"]
    q["pagerank_dangling_ids"] = q["pagerank_dangling_compat"]
    return q
