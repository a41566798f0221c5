"""DuckDB SQL twins of the registered queries (same column names and types).

Written independently of the Spark plans where that helps the check: the
paging stop uses window functions here, the flat name is the first
candidate that fits, and ids are global ``row_number`` windows.
"""

from __future__ import annotations

from quire.functions.pdf import PDF_STUB
from quire.plans.derive import EPOCH
from quire.plans.queries import BUCKET_ID, LANDING, OTHER_BUCKET_ID, PAGE_CAP, REPORT_PART, SINCE_DAYS, WIKI_BATCH

NL = "chr(10)"


def _sql_text(data: str) -> str:
    """A SQL expression for a text with newlines (DuckDB literals have no escapes)."""
    parts = data.split("\n")
    out = " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)
    return f"({out})"


PDF_TEXT = _sql_text(PDF_STUB.decode("ascii"))

GIT_DIR = "translate('git_' || 'https://git.example.com/' || {s} || '_main', '/:', '__')"

DOC_FILES = f"""
doc_files AS (
  SELECT {GIT_DIR.format(s='source')} AS source_dir,
         CASE doc_id % 11 WHEN 0 THEN '.git/' WHEN 1 THEN 'a/target/' WHEN 2 THEN 'targets/'
                          WHEN 3 THEN '.github/' ELSE 'src/' END
         || repeat('seg' || CAST(doc_id % 7 AS VARCHAR) || '/', CAST(doc_id % 60 AS INTEGER))
         || CASE WHEN doc_id % 13 = 0 THEN 'target' ELSE 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' END
           AS rel_path,
         CAST(strlen(text) AS BIGINT) AS length, text AS content, doc_id
  FROM documents
  UNION ALL
  SELECT {GIT_DIR.format(s='source')}, 'README.md', CAST(strlen(t) AS BIGINT), t, d
  FROM (SELECT source, arg_min(text, doc_id) AS t, min(doc_id) AS d
        FROM documents WHERE n_chars < 300 GROUP BY source)
)"""

DOC_CAT = f"""
doc_cat AS (
  SELECT *, row_number() OVER (ORDER BY source_dir) AS pos FROM (
    SELECT 'git' AS type, 'https://git.example.com/' || source AS repo_url,
           {GIT_DIR.format(s='source')} AS source_dir,
           'https://git.example.com/' || source AS logical_name
    FROM (SELECT DISTINCT source FROM documents)
    UNION ALL
    SELECT 'confluence', NULL,
           translate('confluence_' || rtrim('https://wiki.example.com/' || lang || '/', '/') || '_' || upper(lang), '/:', '__'),
           'https://wiki.example.com/' || lang || '/' || ':' || upper(lang)
    FROM (SELECT DISTINCT lang FROM documents)
  )
)"""


def flat_items_cte(files: str = "doc_files", cat: str = "doc_cat", name: str = "doc_items") -> str:
    return f"""
{name} AS (
  SELECT c.pos, c.logical_name AS source_name, c.source_dir, x.rel_path, x.content, x.length, x.doc_id,
         coalesce(
           list_filter(
             list_transform(range(0, len(x.dirs)),
                            lambda i: array_to_string(x.dirs[i + 1:], '__') || '__' || x.base),
             lambda n: strlen(n) <= 180)[1],
           x.base) AS filename
  FROM (SELECT *, string_split(rel_path, '/')[1:len(string_split(rel_path, '/')) - 1] AS dirs,
               string_split(rel_path, '/')[-1] AS base
        FROM {files}) x
  JOIN {cat} c ON c.source_dir = x.source_dir
  WHERE NOT list_has_any(x.dirs, ['.git', 'target'])
)"""


DOC_ITEMS = flat_items_cte()

LOADED = """
srcs AS (
  SELECT pos, row_number() OVER (ORDER BY pos) AS source_id, logical_name AS source_name FROM doc_cat
),
loaded AS (
  SELECT s.source_id, row_number() OVER (ORDER BY s.source_id, i.filename, i.rel_path, sha256(i.content)) AS item_id,
         i.filename, i.rel_path, i.content, i.doc_id
  FROM doc_items i JOIN srcs s USING (pos)
)"""


def markdown(col: str) -> str:
    out = col
    for i in range(1, 7):
        out = f"replace({out}, '<h{i}>', {NL} || '{'#' * i} ')"
        out = f"replace({out}, '</h{i}>', {NL})"
    for tag, rep in (("<p>", f"{NL} || {NL}"), ("</p>", NL), ("<br>", NL), ("<br/>", NL), ("<ul>", NL),
                     ("</ul>", NL), ("<ol>", NL), ("</ol>", NL), ("<li>", "'- '"), ("</li>", NL)):
        out = f"replace({out}, '{tag}', {rep})"
    return f"regexp_replace({out}, '<[^>]+>', '', 'g')"


def stem(parts: str) -> str:
    return (
        "trim(array_to_string(list_transform(" + parts + ", lambda q: replace(translate(q, "
        "'/\\:*?\"<>|', '_________'), '__', '_')), '__'), '_.')"
    )


CLEAN = "regexp_replace(url, '[?#].*$', '')"
HOST = f"split_part(split_part({CLEAN}, '://', 2), '/', 1)"
SEGS = f"string_split(split_part({CLEAN}, '://', 2), '/')[2:]"
PAGE_DIR = "translate('confluence_' || rtrim('https://' || {h} || '/wiki', '/') || '_KB', '/:', '__')"

WIKI_PAGES = f"""
wiki_pages AS (
  SELECT page_id, url, html AS body, {PAGE_DIR.format(h='host')} AS source_dir,
         nullif(regexp_extract(html, '<title>(.*?)</title>', 1), '') AS title,
         list_transform(segs[1:len(segs) - 1],
                        lambda s: CASE WHEN regexp_full_match(s, '[0-9]+') THEN NULL ELSE s END) AS anc,
         segs[1] AS lang
  FROM (SELECT *, {HOST} AS host, {SEGS} AS segs FROM pages)
)"""

HIER = "list_concat(list_filter(anc, lambda t: t IS NOT NULL), [coalesce(title, 'untitled')])"


def kept_pages_cte(b: int) -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_dir ORDER BY page_id) - 1 AS p FROM wiki_pages
),
listed AS (SELECT * FROM ranked WHERE NOT contains(url, '?page=')),
batches AS (
  SELECT source_dir, (p // {b}) * {b} AS start, count(*) AS n,
         bool_or(contains(url, '.html')) OR bool_and(suffix(url, '#top')) AS failed
  FROM listed GROUP BY source_dir, (p // {b}) * {b}
),
flagged AS (
  SELECT *,
         coalesce(bool_or(failed OR n < {b}) OVER (PARTITION BY source_dir ORDER BY start
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended_before,
         bool_or(start <> coalesce(prev_start + {b}, 0)) OVER (PARTITION BY source_dir ORDER BY start
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gapped
  FROM (SELECT *, lag(start) OVER (PARTITION BY source_dir ORDER BY start) AS prev_start FROM batches)
),
kept_pages AS (
  SELECT l.*, f.start, row_number() OVER (PARTITION BY l.source_dir, f.start ORDER BY l.p) - 1 AS pos
  FROM listed l JOIN flagged f ON l.source_dir = f.source_dir AND (l.p // {b}) * {b} = f.start
  WHERE NOT f.ended_before AND NOT f.gapped AND NOT f.failed
)"""


WHOLE_PAGES = f"""
kept_pages AS (
  SELECT page_id, source_dir, title, anc, lang, CASE WHEN contains(url, '?page=') THEN '' ELSE body END AS body,
         (p // {WIKI_BATCH}) * {WIKI_BATCH} AS start, p % {WIKI_BATCH} AS pos
  FROM (SELECT *, row_number() OVER (PARTITION BY source_dir ORDER BY page_id) - 1 AS p FROM wiki_pages)
)"""


SPACES = f"""
spaces AS (
  SELECT DISTINCT {PAGE_DIR.format(h=HOST)} AS source_dir,
         '{{"key":"KB","name":"' || {HOST} || '"}}' AS body
  FROM pages
)"""

WIKI_FILES = f"""
wiki_named AS (
  SELECT source_dir, start + pos AS ordinal, {stem(HIER)} || '.md' AS rel_path, {markdown('body')} AS markdown
  FROM kept_pages
),
wiki_files AS (
  SELECT source_dir, rel_path, CAST(strlen(markdown) AS BIGINT) AS length, markdown AS content,
         CAST(NULL AS BIGINT) AS doc_id
  FROM (SELECT *, row_number() OVER (PARTITION BY source_dir, rel_path ORDER BY ordinal DESC) AS rn FROM wiki_named)
  WHERE rn = 1
  UNION ALL
  SELECT source_dir, 'space.json', CAST(strlen(body) AS BIGINT), body, NULL FROM spaces
)"""

PAGE_SOURCES = f"""
srcrows AS (
  SELECT CAST(page_id AS BIGINT) AS pos,
         CASE WHEN starts_with(url, 'http:') THEN 'git' ELSE 'confluence' END AS type,
         CASE WHEN starts_with(url, 'http:') THEN {CLEAN} END AS repo_url,
         CASE WHEN starts_with(url, 'http:') THEN nullif(regexp_extract(url, '#(.*)$', 1), '') END AS reference,
         CASE WHEN NOT starts_with(url, 'http:') THEN {CLEAN} END AS base_url,
         CASE WHEN NOT starts_with(url, 'http:') THEN upper({SEGS}[1]) END AS space_key,
         {SEGS}[1] AS lang
  FROM pages
)"""

SRC_DIR = (
    "CASE WHEN type = 'git' THEN translate('git_' || repo_url || '_' || coalesce(reference, 'main'), '/:', '__') "
    "ELSE translate('confluence_' || rtrim(base_url, '/') || '_' || space_key, '/:', '__') END"
)
LOGICAL = "CASE WHEN type = 'git' THEN repo_url ELSE base_url || ':' || space_key END"


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["source_dir_names"] = w(PAGE_SOURCES) + f"SELECT pos, type, {SRC_DIR} AS source_dir FROM srcrows"

ORACLE["source_manifest"] = w(PAGE_SOURCES) + f"""
SELECT pos, type, {LOGICAL} AS logical_name, {SRC_DIR} AS source_dir, repo_url,
       coalesce(reference, 'main') AS reference, base_url, space_key,
       CASE WHEN kind IN ('ReadmeToPDF', 'readme_to_pdf', 'readme2pdf') THEN 'ReadmeToPDF' ELSE 'FlattenFiles' END AS processor,
       coalesce(kind IN ('ReadmeToPDF', 'readme_to_pdf', 'readme2pdf', 'FlattenFiles', 'flattenfiles', 'flatten_files'), false) AS kind_known
FROM (SELECT *, CASE lang WHEN 'en' THEN 'FlattenFiles' WHEN 'fr' THEN 'readme2pdf' WHEN 'de' THEN 'flatten_files'
                          WHEN 'es' THEN 'ReadmeToPdf' ELSE lang END AS kind FROM srcrows)"""

ORACLE["flatten_items"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS) + """
SELECT pos, source_name, rel_path, filename, CAST(strlen(content) AS BIGINT) AS n_bytes FROM doc_items"""

ORACLE["readme_items"] = w(DOC_FILES, DOC_CAT) + f"""
SELECT c.source_dir, c.logical_name AS source_name, 'README.pdf' AS filename,
       CAST(strlen({PDF_TEXT}) AS BIGINT) AS pdf_bytes, '%PDF' AS pdf_magic,
       CAST(strlen(f.content) AS BIGINT) AS readme_bytes
FROM doc_cat c JOIN doc_files f ON f.source_dir = c.source_dir AND f.rel_path = 'README.md'"""

ORACLE["missing_readme"] = w(DOC_FILES, DOC_CAT) + """
SELECT source_dir, 'no_readme' AS reason, logical_name AS detail FROM doc_cat c
WHERE NOT EXISTS (SELECT 1 FROM doc_files f WHERE f.source_dir = c.source_dir AND f.rel_path = 'README.md')"""

ORACLE["flat_name_collisions"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS) + """
SELECT pos, filename, count(*) AS n FROM doc_items GROUP BY pos, filename HAVING count(*) > 1"""

ORACLE["html_to_markdown"] = f"SELECT page_id, {markdown('html')} AS markdown FROM pages"

ORACLE["page_stems"] = w(WIKI_PAGES) + f"""
SELECT page_id, source_dir, {stem(HIER)} AS stem, {stem(HIER)} || '.md' AS filename FROM wiki_pages"""

ORACLE["paging_stop"] = w(WIKI_PAGES, kept_pages_cte(WIKI_BATCH)) + """
SELECT source_dir, CAST(start AS BIGINT) AS start, CAST(pos AS BIGINT) AS pos, page_id FROM kept_pages"""

ORACLE["page_cap"] = w(WIKI_PAGES, kept_pages_cte(WIKI_BATCH)) + f"""
SELECT source_dir, CAST(start AS BIGINT) AS start, CAST(pos AS BIGINT) AS pos, page_id FROM kept_pages
WHERE start + pos < {PAGE_CAP}"""

ORACLE["last_write_wins"] = w(WIKI_PAGES, WHOLE_PAGES, SPACES) + f"""
SELECT source_dir, rel_path, page_id, CAST(strlen(md) AS BIGINT) AS n_bytes FROM (
  SELECT source_dir, {stem("[lang]")} || '.md' AS rel_path, page_id, {markdown('body')} AS md,
         row_number() OVER (PARTITION BY source_dir, {stem("[lang]")} ORDER BY start + pos DESC) AS rn
  FROM kept_pages) WHERE rn = 1
UNION ALL
SELECT source_dir, 'space.json', CAST(NULL AS BIGINT), CAST(strlen(body) AS BIGINT) FROM spaces"""

ORACLE["bucket_sources_load"] = w(DOC_CAT) + f"""
SELECT CAST({BUCKET_ID} AS INTEGER) AS bucket_id, CAST(row_number() OVER (ORDER BY pos) AS INTEGER) AS external_source_id,
       logical_name AS external_source_name, CAST(0 AS INTEGER) AS updated_by,
       CAST(NULL AS VARCHAR) AS updated_datetime
FROM doc_cat"""

ITEM_COLS = f"""CAST({BUCKET_ID} AS BIGINT) AS bucket_id, CAST(source_id AS BIGINT) AS external_source_id,
       CAST(item_id AS BIGINT) AS external_item_id, filename AS url, content, sha256(content) AS content_hash,
       'Submitted' AS processing_state, 'Active' AS state, CAST(NULL AS VARCHAR) AS updated_datetime"""

ORACLE["bucket_items_load"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + f"SELECT {ITEM_COLS} FROM loaded"

ORACLE["state_gate"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT CAST(l.item_id AS BIGINT) AS external_item_id, l.filename AS url, 'Failed' AS processing_state
FROM loaded l JOIN labels b ON b.doc_id = l.doc_id WHERE b.toxic = 1"""

PAGE_CAT = f"""
page_cat AS (
  SELECT *, row_number() OVER (ORDER BY source_dir) AS pos FROM (
    SELECT DISTINCT {PAGE_DIR.format(h=HOST)} AS source_dir,
           'https://' || {HOST} || '/wiki' || ':KB' AS logical_name FROM pages)
)"""

TWO_BUCKETS = f"""
two AS (
  SELECT CAST({BUCKET_ID} AS INTEGER) AS bucket_id, CAST(row_number() OVER (ORDER BY pos) AS INTEGER) AS external_source_id,
         logical_name AS external_source_name FROM doc_cat
  UNION ALL
  SELECT CAST({OTHER_BUCKET_ID} AS INTEGER),
         CAST(row_number() OVER (ORDER BY pos) + (SELECT count(*) FROM doc_cat) AS INTEGER), logical_name FROM page_cat
)"""

ORACLE["bucket_list"] = w(DOC_CAT, PAGE_CAT, TWO_BUCKETS) + f"SELECT * FROM two WHERE bucket_id = {OTHER_BUCKET_ID}"
ORACLE["bucket_get"] = w(DOC_CAT, PAGE_CAT, TWO_BUCKETS) + "SELECT * FROM two WHERE external_source_id = 3"

COUNTS = """
SELECT CAST(s.source_id AS BIGINT) AS source_id, s.source_name, CAST(count(k.item_id) AS BIGINT) AS n_items
FROM {srcs} s LEFT JOIN {items} k ON k.source_id = s.source_id
GROUP BY s.source_id, s.source_name"""

ORACLE["bucket_delete_source"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """,
tomb AS (
  SELECT source_id FROM srcs s WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.source_id = s.source_id)
  UNION
  SELECT l.source_id FROM loaded l JOIN labels b ON b.doc_id = l.doc_id WHERE b.quality = 0 AND b.toxic = 1
),
ks AS (SELECT * FROM srcs WHERE source_id NOT IN (SELECT source_id FROM tomb)),
ki AS (SELECT * FROM loaded WHERE source_id NOT IN (SELECT source_id FROM tomb))
""" + COUNTS.format(srcs="ks", items="ki")

ORACLE["bucket_delete_item"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT CAST(source_id AS BIGINT) AS external_source_id, CAST(item_id AS BIGINT) AS external_item_id,
       filename AS url, sha256(content) AS content_hash
FROM loaded l WHERE NOT EXISTS (SELECT 1 FROM labels b WHERE b.doc_id = l.doc_id AND b.toxic = 1)"""

ORACLE["refresh_replace"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + f""",
readme AS (
  SELECT c.pos, f.rel_path FROM doc_cat c JOIN doc_files f ON f.source_dir = c.source_dir AND f.rel_path = 'README.md'
),
n AS (SELECT (SELECT count(*) FROM doc_cat) AS ns, (SELECT count(*) FROM loaded) AS ni)
SELECT CAST({OTHER_BUCKET_ID} AS BIGINT) AS bucket_id, CAST(source_id + n.ns AS BIGINT) AS external_source_id,
       CAST(item_id + n.ni AS BIGINT) AS external_item_id, filename AS url, sha256(content) AS content_hash
FROM loaded, n
UNION ALL
SELECT CAST({BUCKET_ID} AS BIGINT), CAST(s.source_id + 2 * n.ns AS BIGINT),
       CAST(row_number() OVER (ORDER BY s.source_id, r.rel_path) + 2 * n.ni AS BIGINT),
       'README.pdf', sha256({PDF_TEXT})
FROM readme r JOIN srcs s USING (pos), n"""

ORACLE["items_per_source"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + COUNTS.format(srcs="srcs", items="loaded")

ORACLE["sync_report"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT CAST(s.source_id AS BIGINT) AS source_id, s.source_name, CAST(l.item_id AS BIGINT) AS item_id,
       l.filename AS item_name
FROM srcs s LEFT JOIN loaded l ON l.source_id = s.source_id"""

ORACLE["sync_report_nested"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + f""",
firsts AS (SELECT source_id, min(item_id) AS first_id FROM loaded GROUP BY source_id),
parts AS (
  SELECT l.source_id, (l.item_id - f.first_id) // {REPORT_PART} AS part,
         list({{'item_id': CAST(l.item_id AS BIGINT), 'item_name': l.filename}} ORDER BY l.item_id) AS items
  FROM loaded l JOIN firsts f USING (source_id) GROUP BY ALL
)
SELECT CAST(s.source_id AS BIGINT) AS source_id, s.source_name, CAST(coalesce(p.part, 0) AS BIGINT) AS part,
       CAST(to_json(coalesce(p.items, [])) AS VARCHAR) AS items
FROM srcs s LEFT JOIN parts p ON p.source_id = s.source_id"""

MIXED_CAT = f"""
mixed_cat AS (
  SELECT *, row_number() OVER (ORDER BY source_dir) AS pos FROM (
    SELECT source_dir, logical_name FROM doc_cat WHERE type = 'git'
    UNION ALL
    SELECT source_dir, logical_name FROM page_cat)
),
all_files AS (
  SELECT source_dir, rel_path, length, content, doc_id FROM doc_files
  UNION ALL
  SELECT source_dir, rel_path, length, content, doc_id FROM wiki_files
)"""

ORACLE["mixed_sources"] = w(
    DOC_FILES, DOC_CAT, PAGE_CAT, WIKI_PAGES, WHOLE_PAGES, SPACES, WIKI_FILES, MIXED_CAT,
    flat_items_cte("all_files", "mixed_cat", "mixed_items"),
) + """
SELECT CAST(pos AS BIGINT) AS pos, source_name, filename, CAST(strlen(content) AS BIGINT) AS n_bytes FROM mixed_items"""

ORACLE["dedup_exact"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT sha256(content) AS content_hash, CAST(arg_min(source_id, item_id) AS BIGINT) AS external_source_id,
       CAST(min(item_id) AS BIGINT) AS external_item_id
FROM loaded GROUP BY sha256(content)"""

PREV_DOCS = """
prev_docs AS (
  SELECT d.doc_id, d.source, d.lang, d.n_chars,
         CASE WHEN b.quality = 0 THEN d.text || chr(10) || '(draft)' ELSE d.text END AS text
  FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id
  WHERE coalesce(b.toxic, 0) <> 1
)"""

ORACLE["snapshot_diff"] = w(DOC_FILES, PREV_DOCS) + f""",
prev AS (
  SELECT {GIT_DIR.format(s='source')} AS source_dir,
         CASE doc_id % 11 WHEN 0 THEN '.git/' WHEN 1 THEN 'a/target/' WHEN 2 THEN 'targets/'
                          WHEN 3 THEN '.github/' ELSE 'src/' END
         || repeat('seg' || CAST(doc_id % 7 AS VARCHAR) || '/', CAST(doc_id % 60 AS INTEGER))
         || CASE WHEN doc_id % 13 = 0 THEN 'target' ELSE 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' END AS rel_path,
         sha256(text) AS h
  FROM prev_docs
  UNION ALL
  SELECT DISTINCT {GIT_DIR.format(s='source')}, 'CHANGELOG.md', sha256('changes of ' || source) FROM documents
),
cur AS (SELECT source_dir, rel_path, sha256(content) AS h FROM doc_files)
SELECT coalesce(p.source_dir, c.source_dir) AS source_dir, coalesce(p.rel_path, c.rel_path) AS rel_path,
       CASE WHEN p.h IS NULL THEN 'added' WHEN c.h IS NULL THEN 'removed'
            WHEN p.h <> c.h THEN 'changed' ELSE 'unchanged' END AS change
FROM prev p FULL OUTER JOIN cur c ON p.source_dir = c.source_dir AND p.rel_path = c.rel_path"""

PREV_FILES = PREV_DOCS + f""",
prev_files AS (
  SELECT {GIT_DIR.format(s='source')} AS source_dir,
         CASE doc_id % 11 WHEN 0 THEN '.git/' WHEN 1 THEN 'a/target/' WHEN 2 THEN 'targets/'
                          WHEN 3 THEN '.github/' ELSE 'src/' END
         || repeat('seg' || CAST(doc_id % 7 AS VARCHAR) || '/', CAST(doc_id % 60 AS INTEGER))
         || CASE WHEN doc_id % 13 = 0 THEN 'target' ELSE 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' END AS rel_path,
         text AS content, CAST(strlen(text) AS BIGINT) AS length, doc_id
  FROM prev_docs
  UNION ALL
  SELECT DISTINCT {GIT_DIR.format(s='source')}, 'CHANGELOG.md', 'changes of ' || source, 0, NULL FROM documents
)"""

ORACLE["incremental_ids"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, PREV_FILES, flat_items_cte("prev_files", "doc_cat", "prev_items")) + """,
ids AS (SELECT pos, source_dir, row_number() OVER (ORDER BY pos) AS source_id FROM doc_cat WHERE type = 'git'),
before AS (
  SELECT s.source_id, i.rel_path, sha256(i.content) AS h,
         row_number() OVER (ORDER BY s.source_id, i.filename, i.rel_path, sha256(i.content)) AS item_id
  FROM prev_items i JOIN ids s USING (pos)
),
before_nth AS (SELECT *, row_number() OVER (PARTITION BY source_id, rel_path, h ORDER BY item_id) AS nth FROM before),
now AS (
  SELECT s.source_id, s.source_dir, i.filename, i.rel_path, sha256(i.content) AS h,
         row_number() OVER (PARTITION BY s.source_id, i.rel_path, sha256(i.content) ORDER BY i.doc_id) AS nth
  FROM doc_items i JOIN ids s USING (pos)
),
met AS (SELECT n.*, b.item_id FROM now n LEFT JOIN before_nth b USING (source_id, rel_path, h, nth)),
fresh AS (
  SELECT *, row_number() OVER (ORDER BY source_id, filename, rel_path, h) + (SELECT count(*) FROM before) AS new_id
  FROM met WHERE item_id IS NULL
)
SELECT CAST(source_id AS BIGINT) AS external_source_id, CAST(item_id AS BIGINT) AS external_item_id, source_dir, rel_path, h AS content_hash
FROM met WHERE item_id IS NOT NULL
UNION ALL
SELECT CAST(source_id AS BIGINT), CAST(new_id AS BIGINT), source_dir, rel_path, h FROM fresh"""

ORACLE["checksum_audit"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT CAST(l.source_id AS BIGINT) AS external_source_id, CAST(l.item_id AS BIGINT) AS external_item_id,
       l.filename AS url, coalesce(b.quality, 1) <> 0 AS ok
FROM loaded l LEFT JOIN labels b ON b.doc_id = l.doc_id"""

ORACLE["lossy_text"] = """
SELECT doc_id, t AS text, CAST(length(t) - length(replace(t, chr(65533), '')) AS BIGINT) AS n_replaced
FROM (SELECT doc_id, substring(text, 1, length(text) // 2) || chr(65533) || substring(text, length(text) // 2 + 1)
             || chr(65533) AS t FROM documents)"""

ORACLE["tree_scan"] = w(DOC_FILES) + """
SELECT source_dir, rel_path, CAST(strlen(arg_max(content, doc_id)) AS BIGINT) AS length,
       sha256(arg_max(content, doc_id)) AS content_hash
FROM doc_files
WHERE NOT list_has_any(string_split(rel_path, '/')[1:len(string_split(rel_path, '/')) - 1], ['.git', 'target'])
GROUP BY source_dir, rel_path"""

ORACLE["snapshot_replace"] = w(DOC_FILES, PREV_DOCS) + f""",
prev AS (
  SELECT {GIT_DIR.format(s='source')} AS source_dir,
         CASE doc_id % 11 WHEN 0 THEN '.git/' WHEN 1 THEN 'a/target/' WHEN 2 THEN 'targets/'
                          WHEN 3 THEN '.github/' ELSE 'src/' END
         || repeat('seg' || CAST(doc_id % 7 AS VARCHAR) || '/', CAST(doc_id % 60 AS INTEGER))
         || CASE WHEN doc_id % 13 = 0 THEN 'target' ELSE 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' END AS rel_path,
         text AS content
  FROM prev_docs
  UNION ALL
  SELECT DISTINCT {GIT_DIR.format(s='source')}, 'CHANGELOG.md', 'changes of ' || source FROM documents
),
refreshed AS (
  SELECT DISTINCT f.source_dir FROM doc_files f JOIN labels b ON b.doc_id = f.doc_id
  WHERE b.toxic = 1 AND b.quality = 0
)
SELECT source_dir, rel_path, sha256(content) AS content_hash FROM prev
WHERE source_dir NOT IN (SELECT source_dir FROM refreshed)
UNION ALL
SELECT source_dir, rel_path, sha256(content) FROM doc_files
WHERE source_dir IN (SELECT source_dir FROM refreshed)"""


ORACLE["tree_links"] = w(DOC_FILES) + f"""
, seen AS (
  SELECT source_dir, rel_path, CAST(strlen(arg_max(content, doc_id)) AS BIGINT) AS length, sha256(arg_max(content, doc_id)) AS content_hash
  FROM doc_files GROUP BY source_dir, rel_path
), tree AS (
  SELECT * FROM seen WHERE NOT list_has_any(string_split(rel_path, '/')[1:len(string_split(rel_path, '/')) - 1], ['.git', 'target'])
), firsts AS (
  SELECT f.source_dir, f.rel_path FROM doc_files f JOIN (SELECT min(doc_id) AS doc_id FROM documents WHERE doc_id % 11 > 3 GROUP BY source) m
  ON f.doc_id = m.doc_id AND f.rel_path <> 'README.md'
)
SELECT * FROM tree
UNION ALL
SELECT s.source_dir, 'links/first', s.length, s.content_hash FROM firsts f JOIN seen s ON s.source_dir = f.source_dir AND s.rel_path = f.rel_path"""

ORACLE["catalogue_manifest"] = w(DOC_CAT) + f"""
SELECT row_number() OVER (ORDER BY type, coalesce(repo_url, base_url)) - 1 AS pos, type, logical_name, source_dir,
       '{LANDING}/' || source_dir AS local_path, repo_url, space_key
FROM (SELECT type, repo_url, source_dir, logical_name, CAST(NULL AS VARCHAR) AS base_url, CAST(NULL AS VARCHAR) AS space_key FROM doc_cat WHERE type = 'git'
      UNION ALL
      SELECT 'confluence', NULL, translate('confluence_' || rtrim(b, '/') || '_' || upper(lang), '/:', '__'), b || ':' || upper(lang), b, upper(lang)
      FROM (SELECT DISTINCT lang, 'https://wiki.example.com/' || lang || '/' AS b FROM documents))"""

ORACLE["deep_name_collisions"] = w(DOC_CAT) + f"""
SELECT c.pos, 'file' || CAST(d.doc_id % 20 AS VARCHAR) || '.txt' AS filename, count(*) AS n
FROM documents d JOIN doc_cat c ON c.source_dir = {GIT_DIR.format(s='d.source')} GROUP BY ALL HAVING count(*) > 1"""

ORACLE["space_failures"] = w(SPACES) + """
SELECT source_dir, CASE WHEN length(source_dir) % 2 = 0 THEN 503 END AS status, body FROM spaces
WHERE length(source_dir) % 2 = 0 OR length(source_dir) % 3 = 0"""

ORACLE["content_store"] = w(DOC_FILES, DOC_CAT, DOC_ITEMS, LOADED) + """
SELECT sha256(content) AS content_hash, CAST(any_value(strlen(content)) AS BIGINT) AS n_bytes, count(*) AS n_items
FROM loaded GROUP BY sha256(content)"""

ORACLE["recently_modified"] = w(DOC_FILES) + f"""
SELECT f.source_dir, f.rel_path, f.length, t.at AS modified
FROM doc_files f JOIN (SELECT doc_id, CAST({EPOCH} + (ascii(right(source, 1)) % 5 * 100 + doc_id % 97) * 86400 AS BIGINT) AS at FROM documents) t
  ON f.doc_id = t.doc_id AND f.rel_path <> 'README.md'
WHERE t.at >= {EPOCH + SINCE_DAYS * 86400}"""
