"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark operators: pages are read with regular
expressions instead of the element stage, rules are plain aggregates, and so
on.  Only the input derivations (``derive``) are shared, so both sides audit
the same bytes.
"""

from __future__ import annotations

from . import derive

ORACLE: dict[str, str] = {}


def _snap() -> str:
    return derive.stages_sql(derive.page_snapshot_stages("duckdb"), "pages")


def _decode(x: str) -> str:
    # the four entities present in the driver pages; &amp; last
    return (f"regexp_replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), "
            f"'&middot;', '·'), '&amp;?', '&', 'g')")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_TIPO = """CASE WHEN lower(url) LIKE '%/content/%' THEN 'Pagina (CMS)'
  WHEN ends_with(lower(url), '.html') THEN 'Prodotto'
  WHEN ends_with(lower(url), '.it/') OR ends_with(lower(url), '.it/it/')
       OR length(lower(url)) - length(replace(lower(url), '/', '')) < 4 THEN 'Homepage'
  ELSE 'Categoria' END"""


def _audit_sql(strict: bool = False, source: str = "") -> str:
    strict_filter = ("WHERE NOT (canon_tag <> '' AND NOT regexp_matches(canon_tag, ' href=\"')) "
                     "AND NOT (robots_tag <> '' AND NOT regexp_matches(robots_tag, ' content=\"'))"
                     if strict else "")
    return f"""
WITH snap AS ({source or _snap()}),
ok AS (SELECT * FROM snap
       WHERE fetch_error IS NULL AND coalesce(content_type, '') LIKE '%text/html%'),
x AS (
  SELECT page_id, url, status,
    CASE WHEN regexp_extract(html, '<title>([^<]*)</title>', 1) <> ''
         THEN {_strip(_decode("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} END AS title,
    regexp_extract(html, '<meta name="description"[^>]*>', 0) AS desc_tag,
    regexp_extract(html, '<meta name="robots"[^>]*>', 0) AS robots_tag,
    regexp_extract(html, '<link rel="[^"]*\\bcanonical\\b[^"]*"[^>]*>', 0) AS canon_tag,
    CASE WHEN regexp_matches(html, '<h1>')
         THEN {_strip(_decode("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} END AS h1,
    len(regexp_extract_all(html, '<h2>')) AS h2,
    regexp_extract_all(html, '<img[^>]*>') AS imgs
  FROM ok)
SELECT url AS "URL",
  {_TIPO} AS "Tipo",
  CAST(status AS INTEGER) AS "Status",
  CASE WHEN robots_tag = '' THEN 'index, follow'
       WHEN regexp_matches(robots_tag, ' content="') THEN regexp_extract(robots_tag, ' content="([^"]*)"', 1)
  END AS "Robots",
  CASE WHEN canon_tag = '' THEN 'Mancante'
       WHEN regexp_matches(canon_tag, ' href="') THEN regexp_extract(canon_tag, ' href="([^"]*)"', 1)
  END AS "Canonical",
  coalesce(title, 'Mancante') AS "Title",
  CAST(coalesce(length(title), 0) AS INTEGER) AS "Lung. Title",
  CASE WHEN desc_tag <> '' AND regexp_matches(desc_tag, ' content="')
       THEN {_strip("regexp_extract(desc_tag, ' content=\"([^\"]*)\"', 1)")} ELSE 'Mancante' END AS "Meta Desc",
  coalesce(h1, 'Mancante') AS "H1",
  CAST(h2 AS INTEGER) AS "H2 Totali",
  CAST(len(imgs) AS INTEGER) AS "Img Totali",
  CAST(len(list_filter(imgs, lambda t: NOT regexp_matches(t, 'alt="[^"]*[^\\s"][^"]*"'))) AS INTEGER)
    AS "Img senza ALT",
  page_id
FROM x {strict_filter}"""


ORACLE["url_class"] = f"SELECT page_id, url, {_TIPO} AS \"Tipo\" FROM pages"
ORACLE["page_audit"] = _audit_sql()
ORACLE["page_audit_strict"] = _audit_sql(strict=True)

_BROKEN = "try_cast(\"Status\" AS DOUBLE) IS DISTINCT FROM 200"


def _missing(c: str) -> str:
    return f"({c} IS NULL OR {c} = 'Mancante' OR {_strip(c)} = '')"


def _rule_counts(table: str, more: str = "") -> str:
    return f"""SELECT
  count(*) AS total,
  count(*) FILTER (WHERE {_BROKEN}) AS broken_status,
  count(*) FILTER (WHERE {_missing('"Title"')}) AS title_missing,
  count(*) FILTER (WHERE "Lung. Title" > 0 AND "Lung. Title" < 30) AS title_short,
  count(*) FILTER (WHERE "Lung. Title" > 60) AS title_long,
  count(*) FILTER (WHERE {_missing('"Meta Desc"')}) AS meta_desc_missing,
  count(*) FILTER (WHERE {_missing('"H1"')}) AS h1_missing,
  count(*) FILTER (WHERE "Img senza ALT" > 0) AS img_missing_alt,
  count(*) FILTER (WHERE lower(coalesce("Robots", '')) LIKE '%noindex%') AS noindex,
  count(*) FILTER (WHERE "Title" IS DISTINCT FROM 'Mancante')
    - count(DISTINCT CASE WHEN "Title" IS DISTINCT FROM 'Mancante' THEN {{'t': "Title"}} END) AS duplicate_title,
  count(*) FILTER (WHERE {_BROKEN} OR {_missing('"Title"')} OR {_missing('"H1"')}) AS priority,
  {more}
  FROM {table}"""


ORACLE["audit_rule_summary"] = f"""
WITH a AS ({_audit_sql()}), w AS ({_rule_counts("a")})
UNPIVOT w ON COLUMNS(*) INTO NAME rule VALUE n_pages"""

_SEVERITY = ", ".join(f"('{r}', '{s}')" for s, rules in {
    "error": "broken_status priority", "warning": "title_missing title_short title_long meta_desc_missing h1_missing",
    "notice": "img_missing_alt noindex duplicate_title"}.items() for r in rules.split())
ORACLE["audit_rule_report"] = f"""
SELECT rule, severity, n_pages, (SELECT n_pages FROM ({ORACLE["audit_rule_summary"]}) t WHERE rule = 'total') AS n_total
FROM ({ORACLE["audit_rule_summary"]}) s JOIN (VALUES {_SEVERITY}) v(rule, severity) USING (rule)"""

# The export's NA tokens read back as null; a time over two seconds is slow.
ORACLE["csv_rule_report"] = f"""
WITH a AS (
  SELECT * REPLACE (CASE WHEN page_id % 13 <> 0 THEN "Status" END AS "Status",
                    CASE WHEN page_id % 11 <> 0 THEN "H1" END AS "H1")
  FROM ({_audit_sql()}) t),
w AS ({_rule_counts("a", "count(*) FILTER (WHERE page_id % 7 > 4) AS slow_page")})
UNPIVOT w ON COLUMNS(*) INTO NAME rule VALUE n_pages"""

ORACLE["priority_pages"] = f"""
SELECT * FROM ({_audit_sql()}) a
WHERE {_BROKEN} OR {_missing('"Title"')} OR {_missing('"H1"')}"""

ORACLE["duplicate_titles"] = f"""
SELECT page_id, "URL", "Title" FROM (
  SELECT *, row_number() OVER (PARTITION BY "Title" ORDER BY page_id) AS rn
  FROM ({_audit_sql()}) a WHERE "Title" IS DISTINCT FROM 'Mancante') d
WHERE rn > 1"""


ORACLE["priority_export"] = f"""
SELECT CAST(page_id AS VARCHAR) AS page_id, "URL", CAST("Status" AS VARCHAR) AS "Status", nullif("Title", '') AS "Title", nullif("H1", '') AS "H1"
FROM ({ORACLE["priority_pages"]}) p"""

# Captures: of each URL the latest one counts; duplicates in input order.
_CAPTURES = f"""
SELECT * FROM (
  SELECT *, page_id AS captured FROM ({_snap()}) a
  UNION ALL
  SELECT * REPLACE (regexp_replace(html, '<title>[^<]*</title>', '<title>Pagina ' || (page_id // 15) || '</title>', 'g') AS html), page_id + 86400
  FROM ({_snap()}) b WHERE page_id % 3 = 0) c
QUALIFY row_number() OVER (PARTITION BY url ORDER BY captured DESC) = 1"""
ORACLE["report_duplicates"] = f"""
SELECT "URL", "Title", row_number() OVER (ORDER BY page_id) - 1 AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY "Title" ORDER BY page_id) AS rn
  FROM ({_audit_sql(source=_CAPTURES)}) a WHERE "Title" IS DISTINCT FROM 'Mancante') d
WHERE rn > 1"""


# Structured data: DuckDB reads the JSON-LD itself -- blocks by regex, JSON
# functions for the items, a window for the "rest of the block is skipped"
# cut and arg_max for "the last product wins".
def _json_text(j: str) -> str:
    """Python ``str`` of a JSON value (absent -> placeholder, null -> NULL)."""
    return f"""CASE WHEN {j} IS NULL THEN 'Mancante' WHEN json_type({j}) = 'NULL' THEN NULL
      WHEN json_type({j}) = 'VARCHAR' THEN json_extract_string({j}, '$')
      WHEN json_type({j}) = 'DOUBLE' THEN CAST(CAST({j} AS DOUBLE) AS VARCHAR)
      WHEN json_type({j}) = 'BOOLEAN' THEN CASE WHEN CAST({j} AS BOOLEAN) THEN 'True' ELSE 'False' END
      ELSE CAST({j} AS VARCHAR) END"""


def _has(word: str) -> str:
    return f"""(CASE json_type(disp) WHEN 'VARCHAR' THEN contains(json_extract_string(disp, '$'), '{word}')
      WHEN 'ARRAY' THEN list_contains(json_extract_string(disp, '$[*]'), '{word}')
      WHEN 'OBJECT' THEN list_contains(json_keys(disp), '{word}') ELSE false END)"""


ORACLE["structured_data"] = f"""
WITH prod AS ({'SELECT ' + ', '.join(derive.product_snapshot_exprs('duckdb')) + ' FROM part'}),
allp AS (SELECT url, status, html, fetch_error FROM prod
         UNION ALL SELECT url, status, html, fetch_error FROM ({_snap()})),
listed AS (SELECT * FROM allp WHERE ends_with(url, '.html')),
blk AS (
  SELECT url, unnest(range(1, len(b) + 1)) AS bpos, unnest(b) AS txt
  FROM (SELECT url, regexp_extract_all(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1) AS b
        FROM listed WHERE fetch_error IS NULL AND status = 200)),
parsed AS (SELECT url, bpos, CAST(txt AS JSON) AS j FROM blk WHERE json_valid(txt)),
items AS (
  SELECT url, bpos, unnest(range(1, len(l) + 1)) AS ipos, unnest(l) AS item
  FROM (SELECT url, bpos, CASE WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') ELSE [j] END AS l
        FROM parsed)),
j1 AS (
  SELECT url, bpos, ipos, json_type(item) = 'OBJECT' AS obj,
    json_type(item) = 'OBJECT'
      AND coalesce(contains(json_extract_string(item, '$."@type"'), 'Product'), false) AS product,
    json_extract(item, '$.offers') AS offers
  FROM items),
j2 AS (
  SELECT *, CASE WHEN json_type(offers) = 'ARRAY' THEN json_extract(offers, '$[0]') ELSE offers END AS offer
  FROM j1),
j3 AS (
  SELECT *, offers IS NULL OR coalesce(json_type(offer) = 'OBJECT', false) AS offer_ok,
    json_extract(offer, '$.price') AS price_j, json_extract(offer, '$.priceCurrency') AS cur_j,
    json_extract(offer, '$.availability') AS disp
  FROM j2),
j4 AS (
  SELECT *, disp IS NULL OR json_type(disp) IN ('VARCHAR', 'ARRAY', 'OBJECT') AS testable FROM j3),
j5 AS (
  SELECT *, NOT obj OR (product AND NOT (offer_ok AND testable)) AS fail,
    {_json_text('price_j')} AS price,
    {_json_text('cur_j')} AS currency,
    CASE WHEN disp IS NULL THEN '⚠️ Non specificata'
         WHEN {_has('InStock')} THEN '🟢 Disponibile'
         WHEN {_has('OutOfStock')} THEN '🔴 Esaurito'
         ELSE '⚠️ Non specificata' END AS avail
  FROM j4),
kept AS (
  SELECT * FROM (SELECT *, min(ipos) FILTER (WHERE fail) OVER (PARTITION BY url, bpos) AS cut FROM j5)
  WHERE cut IS NULL OR ipos <= cut),
agg AS (
  SELECT url, bool_or(product) AS found, bool_or(product AND offer_ok) AS priced,
    arg_max_null(price, (bpos, ipos)) FILTER (WHERE product AND offer_ok) AS price,
    arg_max_null(currency, (bpos, ipos)) FILTER (WHERE product AND offer_ok) AS currency,
    arg_max(avail, (bpos, ipos)) FILTER (WHERE product AND offer_ok AND testable) AS avail
  FROM kept GROUP BY url)
SELECT l.url AS "URL",
  CASE WHEN l.fetch_error IS NOT NULL THEN 'Errore' WHEN l.status <> 200 THEN '❌ NO'
       WHEN coalesce(a.found, false) THEN '✅ SI' ELSE '❌ NO' END AS "Prodotto Trovato",
  CASE WHEN l.fetch_error IS NOT NULL THEN NULL WHEN l.status <> 200 THEN 'Errore HTTP'
       WHEN coalesce(a.priced, false) THEN a.price ELSE 'N/D' END AS "Prezzo",
  CASE WHEN l.fetch_error IS NOT NULL OR l.status <> 200 THEN NULL
       WHEN coalesce(a.priced, false) THEN a.currency ELSE 'N/D' END AS "Valuta",
  CASE WHEN l.fetch_error IS NOT NULL THEN NULL WHEN l.status <> 200 THEN 'N/D'
       ELSE coalesce(a.avail, 'N/D') END AS "Disponibilità",
  l.fetch_error AS "Errore"
FROM listed l LEFT JOIN agg a USING (url)"""


# Backlinks: DuckDB finds the first link to our domain in the HTML, the
# container that spans it (article/main vs footer/aside) and its anchor text;
# toxicity is read from the page text (markup, scripts, styles, comments removed).
ORACLE["url_column_detect"] = """
WITH e AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS sito, url AS pagina, page_id AS rnk FROM pages)
SELECT CASE WHEN bool_or(contains(sito, 'http')) THEN 'Sito'
            WHEN bool_or(contains(pagina, 'http')) THEN 'Pagina di collegamento'
            WHEN bool_or(contains(CAST(rnk AS VARCHAR), 'http')) THEN 'Rank' END AS url_column
FROM e"""

_TEXT = ("lower(" + _decode("regexp_replace(regexp_replace(html, "
         "'(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')") + ")")

_LINK_TAG = "'<a [^>]*href=\"[^\"]*" + derive.OWN_DOMAIN.replace(".", r"\.") + "[^\"]*\"[^>]*>'"


def _inside(open_tag: str, close_tag: str) -> str:
    return (f"(instr(html, '{open_tag}') > 0 AND instr(html, '{open_tag}') < lp "
            f"AND (instr(html, '{close_tag}') = 0 OR lp < instr(html, '{close_tag}')))")


ORACLE["backlink_audit"] = f"""
WITH s AS ({derive.stages_sql(derive.backlink_snapshot_stages("duckdb"), "pages")}),
t AS (
  SELECT *, regexp_matches({_TEXT}, 'casino|betting|crypto|porn') AS toxic,
         regexp_extract(html, {_LINK_TAG}, 0) AS link_tag
  FROM s),
u AS (
  SELECT *, instr(html, link_tag) AS lp,
         fetch_error IS NULL AND status = 200 AND link_tag <> '' AS scored,
         {_strip(_decode("regexp_replace(regexp_extract(substr(html, instr(html, link_tag) + length(link_tag)), '(?s)^(.*?)</a>', 1), '<[^>]*>', '', 'g')"))} AS anchor
  FROM t),
v AS (
  SELECT *, {_inside('<article', '</article>')} OR {_inside('<main', '</main>')} AS editorial,
         {_inside('<footer', '</footer>')} OR {_inside('<aside', '</aside>')} AS marginal
  FROM u)
SELECT url AS "URL Sorgente",
  CASE WHEN fetch_error IS NOT NULL THEN 'ERRORE' WHEN status <> 200 THEN 'OFFLINE'
       WHEN link_tag = '' THEN 'RIMOSSO' WHEN toxic THEN '💀 TOSSICO'
       WHEN editorial THEN '⭐️ ECCELLENTE' WHEN marginal THEN '🔴 SCARSO'
       ELSE '🟡 MEDIO' END AS "Tipo Risultato",
  CAST(CASE WHEN NOT scored OR toxic THEN 0 WHEN editorial THEN 10
            WHEN marginal THEN 2 ELSE 5 END AS INTEGER) AS "Power Score",
  CASE WHEN NOT scored THEN 'N/D' WHEN anchor = '' THEN '[Immagine/Vuoto]' ELSE anchor END AS "Anchor Text",
  CASE WHEN fetch_error IS NOT NULL THEN fetch_error WHEN status <> 200 THEN 'Errore Connessione'
       WHEN link_tag = '' THEN 'Link non più presente' ELSE 'Attivo' END AS "Note"
FROM v"""


ORACLE["backlink_audit_gaps"] = ORACLE["backlink_audit"] + " WHERE page_id % 9 <> 0"


# Sitemaps: the same site as an edge relation; reachability by recursive UNION.
_SHOP = derive.SHOP
_EDGES = f"""
cust AS (SELECT c_custkey, c_nationkey, c_custkey // 500 AS chunk FROM customer),
nat AS (SELECT DISTINCT c_nationkey AS n, chunk, n_regionkey AS r,
          '{_SHOP}/sitemaps/nation_' || n || '_' || chunk || '.xml' AS u
        FROM cust JOIN nation ON n_nationkey = c_nationkey),
reg AS (SELECT DISTINCT r, chunk // 500 AS g,
          '{_SHOP}/sitemaps/region_' || r || '_' || (chunk // 500) || '.xml' AS u FROM nat),
edges AS (
  SELECT nat.u AS parent, '{_SHOP}/it/customer/' || c_custkey AS loc
    FROM cust JOIN nat ON nat.n = cust.c_nationkey AND nat.chunk = cust.chunk
    WHERE (nat.n + nat.chunk) % 11 <> 10
  UNION ALL SELECT reg.u, nat.u FROM nat JOIN reg ON reg.r = nat.r AND reg.g = nat.chunk // 500
  UNION ALL SELECT u, '{_SHOP}/it/region/' || r FROM reg
  UNION ALL SELECT u, '{derive.SITEMAP_ROOT}' FROM reg WHERE r = 0 AND g = 0
  UNION ALL SELECT '{derive.SITEMAP_ROOT}', u FROM reg
  UNION ALL SELECT '{derive.SITEMAP_ROOT}', '{_SHOP}/it/'
  UNION ALL SELECT '{derive.SITEMAP_ROOT}', '{_SHOP}/feed?f=a.xml'
  UNION ALL SELECT '{derive.SITEMAP_ROOT}', '{_SHOP}/it/search?q=a&p=2')"""

ORACLE["sitemap_edges"] = f"""
WITH {_EDGES}
SELECT parent, loc, contains(lower(loc), '.xml') AS is_sitemap FROM edges"""

ORACLE["sitemap_expand"] = f"""
WITH RECURSIVE {_EDGES},
reach(u) AS (SELECT '{derive.SITEMAP_ROOT}'
             UNION SELECT e.loc FROM edges e JOIN reach ON e.parent = reach.u
                   WHERE contains(lower(e.loc), '.xml'))
SELECT DISTINCT loc AS url FROM edges
WHERE parent IN (SELECT u FROM reach) AND NOT contains(lower(loc), '.xml')"""


# Keywords: probes by a cross join with the 27 suffixes; suggestions by a
# starts_with join and a windowed top-10.
_LETTERS = ", ".join(["NULL"] + [f"'{chr(c)}'" for c in range(ord('a'), ord('z') + 1)])
_PROBES = f"""
seeds AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS seed FROM part),
probes AS (SELECT seed, letter, concat_ws(' ', seed, letter) AS query
           FROM seeds CROSS JOIN (SELECT unnest([{_LETTERS}]) AS letter))"""
_SUGGEST = f"""
WITH {_PROBES},
corpus AS (SELECT keyword, count(*) AS popularity FROM (
             SELECT p_name AS keyword FROM part
             UNION ALL SELECT concat_ws(' ', p_name, lower(p_type)) FROM part) GROUP BY keyword),
hits AS (SELECT seed, query, keyword,
           row_number() OVER (PARTITION BY seed, query ORDER BY popularity DESC, keyword) AS rk
         FROM probes JOIN corpus ON starts_with(keyword, query))"""

ORACLE["keyword_probes"] = f"WITH {_PROBES} SELECT * FROM probes"
ORACLE["keyword_suggest"] = f"""{_SUGGEST}
SELECT seed, query, keyword AS suggestion, CAST(NULL AS INTEGER) AS rank FROM hits"""
ORACLE["keyword_suggest_probes"] = ORACLE["keyword_suggest"]
ORACLE["keyword_expand"] = f"""{_SUGGEST}
SELECT DISTINCT seed, keyword AS "Keyword" FROM hits"""
ORACLE["keyword_suggestions"] = ORACLE["keyword_expand"]
ORACLE["keyword_preview"] = f"""{_SUGGEST},
kw AS (SELECT DISTINCT seed, keyword AS "Keyword" FROM hits)
SELECT * FROM (SELECT seed, "Keyword", CAST(row_number() OVER (PARTITION BY seed ORDER BY "Keyword") AS INTEGER) AS pos
               FROM kw) WHERE pos <= 30"""
ORACLE["keyword_order"] = f"""
SELECT *, row_number() OVER (ORDER BY seed, "Keyword") - 1 AS position FROM ({ORACLE["keyword_expand"]}) e"""
ORACLE["keyword_payloads"] = """
WITH p AS (
  SELECT split_part(p_name, ' ', 1) AS seed, p_partkey, p_name, p_type, p_brand FROM part),
s AS (
  SELECT seed, CASE
    WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 THEN []
    WHEN p_partkey % 19 = 0 THEN ['a', 'b']
    ELSE [p_name || ' ' || lower(p_type), p_name || ' ' || lower(p_brand)] END AS sugg
  FROM p)
SELECT DISTINCT seed, unnest(sugg) AS "Keyword" FROM s"""


# TF-IDF and naming over part names (doc = part row).
_TFIDF = """
docs AS (SELECT p_partkey AS doc_id, p_name AS kw, p_size FROM part),
toks AS (SELECT doc_id, regexp_extract_all(lower(kw), '\\b\\w\\w+\\b') AS t FROM docs),
terms AS (SELECT doc_id, unnest(t) AS term FROM toks
          UNION ALL
          SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nd AS (SELECT count(*) AS n FROM docs),
raw AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN dfq USING (term) CROSS JOIN nd),
wt AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""

_NAMES = f"""{_TFIDF},
asg AS (SELECT p_partkey AS doc_id, CAST(p_size % 5 AS INTEGER) AS "Cluster_ID" FROM part),
sizes AS (SELECT "Cluster_ID", count(*) AS n FROM asg GROUP BY 1),
cent AS (SELECT "Cluster_ID", term, round(sum(weight) / max(n), 9) AS c
         FROM wt JOIN asg USING (doc_id) JOIN sizes USING ("Cluster_ID") GROUP BY "Cluster_ID", term),
top AS (SELECT *, row_number() OVER (PARTITION BY "Cluster_ID" ORDER BY c DESC, term DESC) AS r
        FROM cent WHERE c > 0),
names AS (SELECT "Cluster_ID", upper(string_agg(term, ' - ' ORDER BY r)) AS "Tema_Semantico"
          FROM top WHERE r <= 2 GROUP BY 1)"""

ORACLE["keyword_tfidf"] = f"WITH {_TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM wt"
ORACLE["cluster_themes"] = f"WITH {_NAMES} SELECT * FROM names"
ORACLE["theme_preview"] = f"""WITH {_NAMES},
cl AS (SELECT d.kw AS "Keyword", n."Tema_Semantico" FROM docs d JOIN asg USING (doc_id)
       LEFT JOIN names n USING ("Cluster_ID")),
rk AS (SELECT *, row_number() OVER (PARTITION BY "Tema_Semantico" ORDER BY "Keyword") AS r FROM cl)
SELECT "Tema_Semantico", count(*) AS n_keywords,
       string_agg("Keyword", ', ' ORDER BY r) FILTER (WHERE r <= 4) AS preview,
       count(*) > 4 AS more
FROM rk GROUP BY 1"""


ORACLE["cluster_order"] = f"""WITH {_NAMES},
cl AS (SELECT d.kw AS "Keyword", n."Tema_Semantico" FROM docs d JOIN asg USING (doc_id) LEFT JOIN names n USING ("Cluster_ID"))
SELECT *, row_number() OVER (ORDER BY "Tema_Semantico" NULLS FIRST, "Keyword") - 1 AS position FROM cl"""


# K-Means: the same definition (draws by digests, whole-number weights and means)
# as two recursions over all pairs of documents and clusters.
def _kmeans_sql(keywords: str, k: int, seed: int = 42, starts: int = 10, max_iter: int = 300) -> str:
    return f"""
WITH RECURSIVE kw AS ({keywords}),
docs AS (SELECT row_number() OVER (ORDER BY "Keyword") AS doc, "Keyword", count(*) AS n FROM kw WHERE "Keyword" IS NOT NULL GROUP BY "Keyword"),
nd AS (SELECT sum(n) AS total, greatest(2, least({k}, sum(n) // 3)) AS k FROM docs),
toks AS (SELECT doc, n, regexp_extract_all(lower("Keyword"), '\\b\\w\\w+\\b') AS t FROM docs),
terms AS (SELECT doc, n, unnest(t) AS term FROM toks
          UNION ALL SELECT doc, n, unnest([t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) FROM toks),
tf AS (SELECT doc, n, term, count(*) AS tf FROM terms GROUP BY ALL),
dfq AS (SELECT term, sum(n) AS df FROM tf GROUP BY term),
raw AS (SELECT doc, term, tf * (ln((1 + nd.total) / (1 + df)) + 1) AS w FROM tf JOIN dfq USING (term), nd),
wt AS (SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS weight FROM raw),
x AS MATERIALIZED (SELECT doc, term, CAST(round(weight * 1048576) AS BIGINT) AS w FROM wt),
base AS MATERIALIZED (SELECT doc, "Keyword", n, coalesce(x2, 0) AS x2 FROM docs LEFT JOIN (SELECT doc, CAST(sum(w * w) AS BIGINT) AS x2 FROM x GROUP BY doc) USING (doc)),
pairs AS MATERIALIZED (SELECT a.doc AS a, b.doc AS b, CAST(sum(a.w * b.w) AS BIGINT) AS dot FROM x a JOIN x b USING (term) GROUP BY ALL),
draws(turn, start, doc, d, pick) AS (
  SELECT 0, s, doc, CAST(1 AS BIGINT), CAST(NULL AS BIGINT) FROM base, range({starts}) r(s)
  UNION ALL
  SELECT * FROM (
    WITH picks AS (
      SELECT turn, start, arg_min(doc, (-ln((CAST('0x' || substr(md5('{seed}|' || start || '|' || turn || '|' || "Keyword"), 1, 13) AS BIGINT) + 0.5)
                                        / 4503599627370496.0) / (n * CAST(d AS DOUBLE)), "Keyword")) AS pick
      FROM draws JOIN base USING (doc), nd WHERE d > 0 AND turn < nd.k GROUP BY turn, start)
    SELECT draws.turn + 1, draws.start, draws.doc,
           greatest(0, CASE WHEN draws.turn = 0 THEN me.x2 + it.x2 - 2 * coalesce(dot, 0) ELSE least(draws.d, me.x2 + it.x2 - 2 * coalesce(dot, 0)) END),
           picks.pick
    FROM draws JOIN picks USING (start) JOIN base me ON me.doc = draws.doc JOIN base it ON it.doc = picks.pick
      LEFT JOIN pairs ON pairs.a = draws.doc AND pairs.b = picks.pick)
), chosen AS (SELECT DISTINCT start, turn - 1 AS cluster, pick AS doc FROM draws WHERE turn > 0),
lloyd(iter, start, cluster, term, m) AS (
  SELECT 0, start, cluster, term, w FROM chosen JOIN x USING (doc)
  UNION ALL SELECT 0, start, cluster, '', 0 FROM chosen
  UNION ALL
  SELECT * FROM (
    WITH prev AS (SELECT * FROM lloyd),
    norms AS (SELECT iter, start, cluster, sum(m * m) AS v FROM prev GROUP BY ALL),
    dots AS (SELECT start, cluster, doc, sum(w * m) AS dot FROM prev JOIN x USING (term) GROUP BY ALL),
    labels AS (SELECT start, base.doc, any_value(n) AS n, arg_min(cluster, (v - 2 * coalesce(dot, 0), cluster)) AS cluster
               FROM norms CROSS JOIN base LEFT JOIN dots USING (start, cluster, doc) GROUP BY start, base.doc),
    sizes AS (SELECT start, cluster, sum(n) AS size FROM labels GROUP BY ALL),
    means AS (SELECT start, cluster, term, CAST((2 * sum(w * n) + any_value(size)) // (2 * any_value(size)) AS BIGINT) AS m
              FROM labels JOIN x USING (doc) JOIN sizes USING (start, cluster) GROUP BY start, cluster, term),
    new AS (SELECT * FROM means WHERE m > 0
            UNION ALL SELECT start, cluster, '', 0 FROM sizes
            UNION ALL SELECT start, cluster, term, m FROM prev ANTI JOIN sizes USING (start, cluster))
    SELECT (SELECT max(iter) FROM prev) + 1, * FROM new
    WHERE (SELECT max(iter) FROM prev) < {max_iter}
      AND EXISTS ((SELECT * FROM new) EXCEPT (SELECT start, cluster, term, m FROM prev)))
), final AS (SELECT start, cluster, term, m FROM lloyd WHERE iter = (SELECT max(iter) FROM lloyd)),
norms AS (SELECT start, cluster, sum(m * m) AS v FROM final GROUP BY ALL),
dots AS (SELECT start, cluster, doc, sum(w * m) AS dot FROM final JOIN x USING (term) GROUP BY ALL),
near AS (SELECT start, base.doc, any_value(n) AS n, min(v - 2 * coalesce(dot, 0) + x2) AS cost, arg_min(cluster, (v - 2 * coalesce(dot, 0), cluster)) AS cluster
         FROM norms CROSS JOIN base LEFT JOIN dots USING (start, cluster, doc) GROUP BY start, base.doc),
costs AS (SELECT start, sum(cost * n) AS cost FROM near GROUP BY start),
best AS (SELECT doc, n, cluster FROM near WHERE start = (SELECT arg_min(start, (cost, start)) FROM costs)),
ids AS (SELECT cluster, CAST(row_number() OVER (ORDER BY min("Keyword")) - 1 AS INTEGER) AS "Cluster_ID" FROM best JOIN docs USING (doc) GROUP BY cluster),
asg AS (SELECT doc, "Keyword", docs.n, "Cluster_ID" FROM best JOIN docs USING (doc) JOIN ids USING (cluster)),
sizes AS (SELECT "Cluster_ID", sum(n) AS size FROM asg GROUP BY ALL),
cent AS (SELECT "Cluster_ID", term, round(sum(weight * n) / any_value(size), 9) AS c FROM wt JOIN asg USING (doc) JOIN sizes USING ("Cluster_ID") GROUP BY ALL),
names AS (SELECT "Cluster_ID", upper(string_agg(term, ' - ' ORDER BY r)) AS "Tema_Semantico"
          FROM (SELECT *, row_number() OVER (PARTITION BY "Cluster_ID" ORDER BY c DESC, term DESC) AS r FROM cent WHERE c > 0) t WHERE r <= 2 GROUP BY 1)
SELECT kw."Keyword", asg."Cluster_ID", names."Tema_Semantico"
FROM kw JOIN asg ON asg."Keyword" = kw."Keyword" LEFT JOIN names USING ("Cluster_ID")"""


ORACLE["keyword_cluster"] = _kmeans_sql(f'SELECT "Keyword" FROM ({ORACLE["keyword_expand"]}) e', 7)
# 25 brands ask for 20 clusters: the number is clamped
ORACLE["keyword_cluster_clamped"] = _kmeans_sql("SELECT DISTINCT CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS \"Keyword\" FROM part", 20)


# Vitals: arg_max / arg_min with FILTER over the same derived entries.
_TARGETS = " UNION ALL ".join(f"SELECT '{k}' AS label, '{v}' AS url" for k, v in derive.PAGES_TO_TEST.items())
_VITALS = f"""
e AS (SELECT * FROM (SELECT {', '.join(derive.perf_entry_exprs())} FROM events) x
      JOIN ({_TARGETS}) t USING (label)),
a AS (SELECT view_id, label, url,
  arg_max(start_ms, (ts, seq)) FILTER (WHERE entry_type = 'largest-contentful-paint'
                                       AND start_ms <= load_ms + 2000) AS lcp_ms,
  sum(value) FILTER (WHERE entry_type = 'layout-shift' AND start_ms <= load_ms + 2000
                     AND NOT coalesce(had_recent_input, false)) AS cls_sum,
  arg_min(response_start_ms, (ts, seq)) FILTER (WHERE entry_type = 'navigation') AS ttfb_ms,
  bool_or(entry_type = 'navigation') AS has_nav,
  arg_min(fetch_error, (ts, seq)) FILTER (WHERE entry_type = 'error') AS err
  FROM e GROUP BY ALL),
f AS (SELECT *, CASE WHEN err IS NOT NULL THEN err
                     WHEN NOT has_nav THEN 'TypeError: Cannot read properties of undefined (reading ''responseStart'')' END AS errore,
             CAST(floor(coalesce(lcp_ms, 0) + 0.5) AS BIGINT) AS lms FROM a)
SELECT view_id, label AS "Tipo", url AS "URL",
  CASE WHEN errore IS NULL THEN CAST(CAST(floor(ttfb_ms + 0.5) AS BIGINT) AS VARCHAR) || 'ms' END AS "TTFB",
  CASE WHEN errore IS NULL THEN
    CASE WHEN lms % 1000 = 0 THEN CAST(lms // 1000 AS VARCHAR)
         ELSE CAST(lms // 1000 AS VARCHAR) || '.' || regexp_replace(lpad(CAST(lms % 1000 AS VARCHAR), 3, '0'), '0+$', '') END
    || 's' END AS "LCP",
  CASE WHEN errore IS NULL THEN floor(coalesce(cls_sum, 0) * 1000 + 0.5) / 1000 END AS "CLS",
  CASE WHEN errore IS NULL THEN CASE WHEN lms <= 2500 THEN '✅ BUONO' ELSE '🔴 DA MIGLIORARE' END END AS "Giudizio",
  errore AS "Errore",
  CASE WHEN errore IS NULL THEN lcp_ms IS NOT NULL END AS lcp_observed
FROM f"""
ORACLE["vitals_report"] = f"WITH {_VITALS}"
ORACLE["stream_vitals"] = f"WITH {_VITALS}"
ORACLE["stream_page_audit"] = _audit_sql()
ORACLE["stream_page_audit_once"] = f"SELECT *, page_id + {derive.FIRST_CAPTURE} AS fetched_at FROM ({_audit_sql()}) a"
