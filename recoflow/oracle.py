"""DuckDB SQL for the correctness check.

Each query re-states one operator in plain SQL over the test tables
(``events``, ``documents``, ``customer``, ``region`` ... registered as
views).  The fixture derivations are rendered from the same expression
lists Spark uses (``recoflow.sources.fixtures``), so both engines read
identical inputs; only the operator logic is written twice.
"""

from __future__ import annotations

import datetime as _dt

from recoflow import constants as C
from recoflow import schemas
from recoflow.sources import fixtures as fx

AS_OF = _dt.date(2024, 1, 31)


def epoch_midnight(days_back: int, as_of: _dt.date = AS_OF) -> int:
    d = as_of - _dt.timedelta(days=days_back)
    return int(_dt.datetime(d.year, d.month, d.day, tzinfo=_dt.timezone.utc).timestamp())


def _select(exprs, source: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{a}"' for e, a in exprs) + f" FROM {source}"


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# -- fixture CTEs -------------------------------------------------------------------
EVENTS_FLAT = f"events_flat AS ({_select(fx.EVENTS_FLAT, 'events')})"
ITEMS_FLAT = f"items_flat AS ({_select(fx.ITEMS_FLAT, 'documents')})"
CONTENT_FLAT = (f"content_flat AS (SELECT *, string_split(keywords_text, '|') AS \"Keywords\" "
                f"FROM ({_select(fx.CONTENT_FLAT, 'items_flat')}))")
CONTENT_META = (
    "content_meta AS (SELECT m.* EXCLUDE (keywords_text), "
    "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN CAST([] AS VARCHAR[]) "
    "WHEN doc_id % 3 = 1 THEN ['Author ' || CAST(doc_id % 7 AS VARCHAR)] "
    "ELSE ['Author A', 'Author B'] END AS \"Byline\", "
    "string_split(keywords_text, '|') AS \"Keywords\" "
    f"FROM ({_select(fx.CONTENT_META + [('keywords_text', 'keywords_text')], 'items_flat')}) m)")
IMAGES = (
    f"images AS (SELECT {fx.IMAGE_CONTENT_ID.format(text='VARCHAR')} AS \"ContentID\", "
    "CASE WHEN doc_id % 7 = 0 THEN NULL "
    "WHEN doc_id % 5 = 0 THEN CAST([] AS STRUCT(url220 VARCHAR)[]) "
    "WHEN doc_id % 13 = 0 THEN [{'url220': CAST(NULL AS VARCHAR)}] "
    "ELSE [{'url220': 'https://img.example/a1/' || CAST(doc_id AS VARCHAR) || '.jpg'}] END "
    "AS \"AuthorRel\", "
    "CASE WHEN doc_id % 4 = 0 THEN CAST([] AS STRUCT(url220 VARCHAR)[]) "
    "ELSE [{'url220': 'https://img.example/p1/' || CAST(doc_id AS VARCHAR) || '.jpg'}, "
    "{'url220': 'https://img.example/p2/' || CAST(doc_id AS VARCHAR) || '.jpg'}] END "
    "AS \"PictureRel\" FROM documents)")
REQUESTS_FLAT = f"requests_flat AS ({_select(fx.REQUESTS_FLAT, 'customer')})"
SETTINGS = f"settings AS ({_select(fx.SETTINGS_FLAT, 'region')})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# -- shared SQL fragments ---------------------------------------------------------------

def epoch_iso(c: str) -> str:
    """ISO text -> epoch seconds, NULL when unparsable."""
    return f"CAST(epoch(TRY_CAST({c} AS TIMESTAMPTZ)) AS BIGINT)"


def epoch_stream(c: str, ingest: int) -> str:
    head = f"substr({c}, 1, length({c}) - 5)"
    return (f"COALESCE(CAST(epoch(CAST(try_strptime({head}, '%Y-%m-%dT%H:%M:%S') "
            f"AS TIMESTAMP)) AS BIGINT), {ingest})")


ROLLING_MONTH = ("make_date(year, month, day) > DATE '2023-12-31' "
                 "AND make_date(year, month, day) <= DATE '2024-01-31'")

RULE_PAGE_VIEW = (f"sp_app_id = '{C.APP_ID}' AND sp_event_name = 'page_view' "
                  "AND page_type = 'article'")
RULE_CONTENT_ID = "content_contentid IS NOT NULL AND NOT contains(content_contentid, 'http')"
RULE_BOT = "(device_detector_visitorplatform IS NULL OR device_detector_visitorplatform <> 'Bot')"
RULE_PREMIUM = ("(visitor_servicecode IS NULL OR "
                f"NOT contains(visitor_servicecode, '{C.PREMIUM_SERVICE_CODE}'))")
RULE_ISP = f"(sp_ip_isp IS NULL OR sp_ip_isp NOT IN ({_list(C.ISP_DENYLIST)}))"
RULE_HOST = f"(sp_page_urlhost IS NULL OR sp_page_urlhost NOT IN ({_list(C.HOST_DENYLIST)}))"

INTERACTIONS_SELECT = (
    "SELECT COALESCE(sp_user_id, sp_domain_userid) AS USER_ID, content_contentid AS ITEM_ID, "
    f"{epoch_iso('sp_derived_tstamp')} AS TIMESTAMP, sp_event_name AS EVENT_TYPE, visitor_type, "
    "visitor_countrycode, device_detector_visitorplatform, device_detector_brandname, "
    "device_detector_browserfamily FROM events_flat")

INTERACTIONS_CTE = (
    "interactions AS (SELECT * FROM (" + INTERACTIONS_SELECT + " WHERE " + ROLLING_MONTH
    + " AND " + " AND ".join([RULE_PAGE_VIEW, RULE_CONTENT_ID, RULE_BOT, RULE_PREMIUM,
                              RULE_ISP, RULE_HOST])
    + f") WHERE TIMESTAMP > {epoch_midnight(C.INTERACTION_WINDOW_DAYS)} "
    "AND USER_ID IS NOT NULL AND ITEM_ID IS NOT NULL AND TIMESTAMP IS NOT NULL "
    "AND EVENT_TYPE IS NOT NULL)")


AS_OF_EPOCH = epoch_midnight(0)
INGEST = 1706659200
ACTIVE = "settings WHERE status = 'active'"


def _arr(values) -> str:
    if values is None:
        return "CAST(NULL AS VARCHAR[])"
    return "[" + _list(values) + "]"


FILTERS = "filters(context, fname, filter_values, limit_time_range, sections) AS (VALUES " + ", ".join(
    f"('{s['context']}', '{s['name']}', {_arr(s['filter_values'])}, "
    f"{'true' if s['limit_time_range'] else 'false'}, "
    f"{_arr(s['include_time_range_for_sections'])})" for s in C.FILTER_SPECS) + ")"

ENTRIES = (
    "entries AS (SELECT s.name, f.context, s.name || '-' || f.fname AS filter_name, f.fname AS kind, "
    "f.limit_time_range, f.filter_values, f.sections FROM settings s CROSS JOIN filters f "
    "WHERE s.status = 'active' UNION ALL SELECT s.name, 'default', s.name || '-unread', 'unread', "
    "CAST(NULL AS BOOLEAN), CAST(NULL AS VARCHAR[]), CAST(NULL AS VARCHAR[]) FROM settings s "
    "WHERE s.status = 'active' AND NOT EXISTS (SELECT 1 FROM filters WHERE context = 'default'))")

USER_STREAM = ("CASE WHEN regexp_matches(sp_domain_userid, '\\S') THEN sp_domain_userid "
               "WHEN regexp_matches(sp_user_id, '\\S') THEN sp_user_id END")


def blank(c: str) -> str:
    return f"({c} IS NULL OR NOT regexp_matches({c}, '\\S'))"


EVENT_SKIP = (
    "CASE WHEN sp_event_id IS NULL THEN 'NO_EVENT_ID' "
    f"WHEN {blank('sp_derived_tstamp')} THEN 'NO_TIME' "
    f"WHEN sp_app_id IS NULL OR sp_app_id <> '{C.APP_ID}' THEN 'OTHER_APP' "
    f"WHEN {blank('content_contentid')} THEN 'NO_ITEM' "
    "WHEN page_type IS NULL OR page_type <> 'article' THEN 'NOT_AN_ARTICLE' "
    "WHEN COALESCE(device_detector_visitorplatform = 'Bot', false) "
    "THEN 'BOT' "
    f"WHEN COALESCE(sp_page_urlhost IN ({_list(C.HOST_DENYLIST)}), false) "
    "THEN 'DENIED_HOST' "
    "WHEN sp_event_name IS NULL OR sp_event_name <> 'page_view' THEN 'NOT_A_PAGE_VIEW' "
    "WHEN sp_domain_sessionid IS NULL THEN 'NO_SESSION' "
    f"WHEN {blank('sp_user_id')} AND {blank('sp_domain_userid')} THEN 'NO_USER' END")
VALIDATED_EVENTS = f"validated_events AS (SELECT *, {EVENT_SKIP} AS skip_reason FROM events_flat)"

PROPS = ("json_object('visitor_type', visitor_type, 'visitor_countryCode', visitor_countrycode, "
         "'device_detector_visitorPlatform', device_detector_visitorplatform, "
         "'device_detector_brandName', device_detector_brandname, "
         "'device_detector_browserFamily', device_detector_browserfamily)::VARCHAR")

CONTENT_SKIP = (
    "CASE WHEN \"ContentId\" IS NULL OR \"Category\" IS NULL THEN 'NO_ID_OR_CATEGORY' "
    "WHEN NOT COALESCE(\"Published\" = true, false) THEN 'NOT_PUBLISHED' "
    "WHEN \"ContentText\" IS NULL THEN 'NO_TEXT' END")
EXCLUDE_STREAM = (
    "CASE WHEN COALESCE(\"Sponsored\", false) OR COALESCE(\"Section\" = 'life/horoscopes', false) "
    "OR COALESCE(list_contains(\"Keywords\", 'omit'), false) "
    "OR COALESCE(list_contains(\"Keywords\", 'zerocanada'), false) THEN 1 ELSE 0 END")
ITEM_PROPS = (
    "json_object('ContentText', substr(\"ContentText\", 1, 20000), 'Category', \"Category\", "
    "'WordCount', \"WordCount\", 'Published', \"Published\", 'ContentType', \"ContentType\", "
    f"'Exclude', {EXCLUDE_STREAM}, 'CREATION_TIMESTAMP', {epoch_stream(chr(34) + 'UpdatedDate' + chr(34), INGEST)})::VARCHAR")
ITEM_RECORDS = (
    "item_records AS (SELECT CAST(doc_id AS VARCHAR) AS record_id, "
    f"{epoch_stream(chr(34) + 'UpdatedDate' + chr(34), INGEST)} AS updated_ts, "
    f"\"ContentId\" AS \"itemId\", {ITEM_PROPS} AS properties FROM content_flat "
    f"WHERE ({CONTENT_SKIP}) IS NULL)")

EXCLUDE_BATCH = (
    "CASE WHEN sponsored OR COALESCE(section = 'life/horoscopes', false) "
    "OR contains(COALESCE(keywords_text, ''), 'omit') "
    "OR contains(COALESCE(keywords_text, ''), 'zerocanada') THEN 1 ELSE 0 END")
ITEM_ROWS = (
    f"item_rows AS (SELECT contentid AS ITEM_ID, {epoch_iso('publisheddate')} AS CREATION_TIMESTAMP, "
    "contenttext AS ContentText, category AS Category, wordcount AS WordCount, "
    f"{EXCLUDE_BATCH} AS Exclude FROM items_flat)")
ITEMS = (
    f"items AS (SELECT * FROM item_rows WHERE CREATION_TIMESTAMP > {epoch_midnight(14)} "
    "AND ITEM_ID IS NOT NULL AND CREATION_TIMESTAMP IS NOT NULL AND ContentText IS NOT NULL)")


def category_expr(inc: str = "include_sections", sec: str = "section") -> str:
    raw = (f"CASE WHEN length({inc}) > 0 THEN {inc} WHEN length({sec}) > 0 THEN "
           f"(CASE WHEN instr({sec}, '/') > 0 THEN split_part({sec}, '/', 2) ELSE {sec} END) "
           f"ELSE '{C.DEFAULT_CATEGORY}' END")
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.CATEGORY_ALIASES.items())
    return f"(CASE ({raw}) {whens} ELSE ({raw}) END)"


def cap(c: str) -> str:
    return f"CASE WHEN length({c}) > 0 THEN upper(substr({c}, 1, 1)) || lower(substr({c}, 2)) END"


LIMIT = "COALESCE(TRY_CAST(limit_text AS INTEGER), 25)"
PARSED = (
    f"parsed AS (SELECT request_id, visitor_id, widget_id, {LIMIT} AS \"limit\", "
    f"least({LIMIT} + 1, 500) AS num_results, context, platform, visitor_type, section, "
    "include_sections, last_content_ids FROM requests_flat)")
SPANS = (
    "spans AS (SELECT name AS backend, hi - w AS lo, hi, total FROM (SELECT name, w, "
    "sum(w) OVER (ORDER BY backend_order, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi, "
    "sum(w) OVER () AS total FROM (SELECT name, backend_order, "
    "CAST((trafficRatio % 100) + 1 AS BIGINT) AS w FROM settings WHERE status = 'active')))")
ASSIGNED = (
    "assigned AS (SELECT p.*, s.backend FROM parsed p LEFT JOIN spans s "
    "ON ((p.request_id % s.total) + s.total) % s.total >= s.lo "
    "AND ((p.request_id % s.total) + s.total) % s.total < s.hi)")


def _pick(f: str) -> str:
    return f"CASE WHEN e1.name IS NOT NULL THEN e1.{f} ELSE e2.{f} END"


RESOLVED = (
    "resolved0 AS (SELECT a.*, " + ", ".join(f"{_pick(f)} AS {f}" for f in (
        "filter_name", "kind", "limit_time_range", "filter_values", "sections"))
    + " FROM assigned a LEFT JOIN entries e1 ON e1.name = a.backend AND e1.context = a.context "
    "LEFT JOIN entries e2 ON e2.name = a.backend AND e2.context = 'default'),\n"
    "resolved AS (SELECT *, COALESCE(limit_time_range, true) OR "
    "(COALESCE(list_contains(filter_values, 'category'), false) "
    "AND COALESCE(list_contains(sections, category), false)) AS dated FROM ("
    "SELECT *, CASE WHEN COALESCE(list_contains(filter_values, 'category'), false) THEN "
    f"{category_expr()} END AS category, {cap('platform')} AS ctx_platform, "
    f"{cap('visitor_type')} AS ctx_visitor_type FROM resolved0))")
REQ_CTES = [REQUESTS_FLAT, SETTINGS, FILTERS, ENTRIES, PARSED, SPANS, ASSIGNED, RESOLVED]

HCAND = (
    f"hreq AS (SELECT request_id, visitor_id AS user_id, {category_expr()} AS category, "
    "last_content_ids FROM requests_flat),\n"
    "touched AS (SELECT DISTINCT COALESCE(sp_user_id, sp_domain_userid) AS user_id, "
    "content_contentid AS item_id FROM events_flat WHERE content_contentid IS NOT NULL),\n"
    "hcand AS (SELECT r.*, t.item_id FROM hreq r JOIN touched t ON t.user_id = r.user_id)")
VIEWED = ("viewed AS (SELECT DISTINCT USER_ID, ITEM_ID FROM interactions "
          "WHERE EVENT_TYPE = 'page_view')")
NOT_VIEWED = ("NOT EXISTS (SELECT 1 FROM viewed v WHERE v.USER_ID = c.user_id "
              "AND v.ITEM_ID = c.item_id)")
INC_CAT = "COALESCE(i.Category = c.category, false)"
EXC_CAT = "NOT COALESCE(i.Category = c.category, false)"
INC_CREATED = "COALESCE(i.CREATION_TIMESTAMP > 0, false)"
EXC_FLAG = "NOT COALESCE(i.Exclude = 1, false)"
AGE_OK = f"NOT COALESCE(i.CREATION_TIMESTAMP < {epoch_midnight(C.ITEM_AGE_FILTER_DAYS)}, false)"
KIND_PRED = (f"CASE WHEN c.kind = 'category' THEN {INC_CAT} AND {EXC_FLAG} "
             f"WHEN c.kind = 'exclcat' THEN {INC_CREATED} AND {EXC_CAT} AND {EXC_FLAG} "
             f"ELSE {INC_CREATED} AND {EXC_FLAG} END")

SIMS = (
    "v AS (SELECT DISTINCT USER_ID AS u, ITEM_ID AS i FROM interactions),\n"
    "n AS (SELECT i, count(*) AS n_i FROM v GROUP BY i),\n"
    "cij AS (SELECT a.i, b.i AS j, count(*) AS c_ij FROM v a JOIN v b ON a.u = b.u AND a.i <> b.i "
    "GROUP BY a.i, b.i),\n"
    "simall AS (SELECT cij.i, cij.j, CAST(cij.c_ij AS DOUBLE) / sqrt(CAST(n1.n_i AS DOUBLE) * "
    "CAST(n2.n_i AS DOUBLE)) AS sim FROM cij JOIN n n1 ON n1.i = cij.i JOIN n n2 ON n2.i = cij.j),\n"
    "sims AS (SELECT i AS item_id, j AS similar_item_id, sim, CAST(row_number() OVER "
    "(PARTITION BY i ORDER BY sim DESC, j ASC) AS INTEGER) AS rank FROM simall QUALIFY rank <= "
    f"{C.SIMILAR_TOP_K})")
PERS = (
    "hist AS (SELECT USER_ID AS u, ITEM_ID AS i, max(TIMESTAMP) AS last_view FROM interactions "
    "GROUP BY USER_ID, ITEM_ID),\n"
    f"aff AS (SELECT h.u, s.similar_item_id AS j, sum(pow(0.5, CAST({AS_OF_EPOCH} - h.last_view AS DOUBLE) "
    f"/ {float(C.RECENCY_HALF_LIFE_SECONDS)}) * s.sim) AS raw FROM hist h "
    "JOIN sims s ON s.item_id = h.i GROUP BY h.u, s.similar_item_id),\n"
    "topu AS (SELECT u, max(raw) AS mx FROM aff GROUP BY u),\n"
    f"fresh AS (SELECT ITEM_ID AS item_id, CASE WHEN COALESCE({AS_OF_EPOCH} - CREATION_TIMESTAMP "
    f"<= {C.FRESH_AGE_SECONDS}, false) THEN 1 ELSE 0 END AS fresh FROM items),\n"
    "pers AS (SELECT a.u AS user_id, a.j AS item_id, a.raw / t.mx AS affinity, "
    "COALESCE(f.fresh, 0) AS fresh, "
    f"{C.AFFINITY_WEIGHT} * (a.raw / t.mx) + {C.FRESHNESS_WEIGHT} * COALESCE(f.fresh, 0) AS score "
    "FROM aff a JOIN topu t ON t.u = a.u LEFT JOIN fresh f ON f.item_id = a.j)")

NS = "IS NOT DISTINCT FROM"
POP = (
    "iv AS (SELECT device_detector_visitorplatform AS platform, visitor_type, ITEM_ID AS item_id, "
    "USER_ID FROM interactions),\n"
    "pcnt AS (SELECT platform, visitor_type, 0 AS seg_level, item_id, count(DISTINCT USER_ID) AS users "
    "FROM iv GROUP BY platform, visitor_type, item_id UNION ALL "
    "SELECT platform, NULL, 1, item_id, count(DISTINCT USER_ID) FROM iv GROUP BY platform, item_id "
    "UNION ALL SELECT NULL, visitor_type, 2, item_id, count(DISTINCT USER_ID) FROM iv "
    "GROUP BY visitor_type, item_id UNION ALL SELECT NULL, NULL, 3, item_id, count(DISTINCT USER_ID) "
    "FROM iv GROUP BY item_id),\n"
    "pmax AS (SELECT platform, visitor_type, seg_level, max(users) AS mx FROM pcnt "
    "GROUP BY platform, visitor_type, seg_level),\n"
    f"pop AS (SELECT c.*, c.users / m.mx AS popularity FROM pcnt c JOIN pmax m ON c.platform {NS} "
    f"m.platform AND c.visitor_type {NS} m.visitor_type AND c.seg_level = m.seg_level)")

CANDS = (
    "warm AS (SELECT c.request_id, c.item_id, c.score, c.dated, " + AGE_OK + " AS age_ok FROM ("
    "SELECT r.request_id, r.visitor_id AS user_id, r.kind, r.category, r.dated, p.item_id, p.score "
    "FROM resolved r JOIN pers p ON p.user_id = r.visitor_id WHERE r.backend IS NOT NULL) c "
    f"LEFT JOIN items i ON i.ITEM_ID = c.item_id WHERE ({KIND_PRED}) AND {NOT_VIEWED}),\n"
    "cold AS (SELECT r.* FROM resolved r WHERE r.backend IS NOT NULL AND NOT EXISTS (SELECT 1 "
    "FROM interactions x WHERE x.USER_ID = r.visitor_id)),\n"
    "cseg AS (SELECT request_id, kind, category, dated, CASE WHEN lvl IN (0, 1) THEN ctx_platform END "
    "AS platform, CASE WHEN lvl IN (0, 2) THEN ctx_visitor_type END AS visitor_type, lvl AS seg_level "
    "FROM (SELECT *, CASE WHEN ctx_platform IS NOT NULL AND ctx_visitor_type IS NOT NULL THEN 0 "
    "WHEN ctx_platform IS NOT NULL THEN 1 WHEN ctx_visitor_type IS NOT NULL THEN 2 ELSE 3 END AS lvl "
    "FROM cold)),\n"
    "known AS (SELECT DISTINCT platform, visitor_type, seg_level FROM pop),\n"
    "cseg2 AS (SELECT c.request_id, c.kind, c.category, c.dated, "
    "CASE WHEN k.seg_level IS NOT NULL THEN c.platform END AS platform, "
    "CASE WHEN k.seg_level IS NOT NULL THEN c.visitor_type END AS visitor_type, "
    "CASE WHEN k.seg_level IS NOT NULL THEN c.seg_level ELSE 3 END AS seg_level FROM cseg c "
    f"LEFT JOIN known k ON c.platform {NS} k.platform AND c.visitor_type {NS} k.visitor_type "
    "AND c.seg_level = k.seg_level),\n"
    "coldc AS (SELECT c.request_id, c.item_id, c.score, c.dated, " + AGE_OK + " AS age_ok FROM ("
    f"SELECT s.*, p.item_id, {C.AFFINITY_WEIGHT} * p.popularity + {C.FRESHNESS_WEIGHT} * "
    "COALESCE(f.fresh, 0) AS score FROM cseg2 s JOIN pop p ON s.platform "
    f"{NS} p.platform AND s.visitor_type {NS} p.visitor_type AND s.seg_level = p.seg_level "
    "LEFT JOIN fresh f ON f.item_id = p.item_id) c LEFT JOIN items i ON i.ITEM_ID = c.item_id "
    f"WHERE ({KIND_PRED})),\n"
    "cands AS (SELECT * FROM warm UNION ALL SELECT * FROM coldc),\n"
    "ndated AS (SELECT request_id, count(*) FILTER (WHERE age_ok) AS n FROM cands GROUP BY request_id),\n"
    "kept AS (SELECT c.*, c.dated AND d.n = 0 AS backup, c.dated AND d.n > 0 AS filter_dated "
    "FROM cands c JOIN ndated d USING (request_id) WHERE NOT (c.dated AND d.n > 0) OR c.age_ok),\n"
    "ranked AS (SELECT * FROM (SELECT k.*, r.num_results, CAST(row_number() OVER (PARTITION BY "
    "k.request_id ORDER BY k.score DESC, k.item_id ASC) AS INTEGER) AS rank FROM kept k "
    "JOIN resolved r USING (request_id)) WHERE rank <= num_results)")

META = (
    "meta AS (SELECT \"ContentId\" AS content_id, \"Title\" AS title, \"Deck\" AS deck, "
    "CASE WHEN \"Byline\" IS NULL THEN NULL ELSE array_to_string(\"Byline\", ' and ') END AS byline, "
    "\"Category\" AS category, \"Section\" AS section_meta_title, \"CanonicalURL\" AS url, "
    "\"CreditLine\" AS credit, \"ContentType\" AS content_type, \"ContentRestriction\" AS "
    "protection_product, \"PublishedDate\" AS published_at, \"UpdatedDate\" AS updated_at, "
    "CAST(\"WordCount\" AS DOUBLE) AS word_count, \"Label\" AS label, \"Keywords\" AS keywords, \"State\" "
    "AS state, \"Ownership\" AS ownership, \"Sponsored\" AS sponsored, \"Caption\" AS caption FROM content_meta)")
IMGS = (
    "imgs AS (SELECT \"ContentID\" AS content_id, CASE WHEN len(\"AuthorRel\") > 0 THEN "
    "COALESCE(\"AuthorRel\"[1].url220, '') END AS author_url220, CASE WHEN len(\"PictureRel\") > 0 "
    "THEN COALESCE(\"PictureRel\"[1].url220, '') END AS picture_url220 FROM images)")
ROWS = (
    "rows0 AS (SELECT r.request_id, r.item_id, r.rank, r.score, r.num_results, m.*, "
    "g.author_url220, g.picture_url220, g.content_id IS NOT NULL AS has_images, q.last_content_ids "
    "FROM ranked r JOIN meta m ON m.content_id = r.item_id LEFT JOIN imgs g ON g.content_id = "
    "m.content_id JOIN resolved q ON q.request_id = r.request_id WHERE NOT COALESCE("
    "q.last_content_ids IS NOT NULL AND length(q.last_content_ids) > 0 AND m.content_id = "
    "q.last_content_ids, false)),\n"
    "rows AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY rank) "
    "AS INTEGER) AS position FROM rows0) WHERE position <= num_results - 1)")


def recommend_ctes() -> str:
    return with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS, CONTENT_META, IMAGES,
                 *REQ_CTES, VIEWED, SIMS, PERS, POP, CANDS, META, IMGS, ROWS)


def lag_block(stream: str, src: str, n: int) -> str:
    """Per-period max lag of one stream on a dense grid, alarm over n periods (periods without data are passed over)."""
    return (
        "SELECT stream, period, max_lag_ms, breaching, upto - COALESCE(max(upto) FILTER (WHERE NOT breaching AND "
        f"max_lag_ms IS NOT NULL) OVER (ORDER BY period), 0) >= {n} AS in_alarm FROM (SELECT '{stream}' AS stream, "
        "period, max_lag_ms, breaching, sum(CAST(breaching AS INTEGER)) OVER (ORDER BY period) AS upto FROM "
        f"(SELECT g.period, l.max_lag_ms, COALESCE(l.max_lag_ms >= {C.LAG_ALARM_MS}, false) AS breaching FROM (SELECT "
        "unnest(generate_series(min(period), max(period), 300)) AS period FROM (SELECT CAST(floor("
        f"arrival_ms / 1000.0 / 300) * 300 AS BIGINT) AS period FROM {src})) g LEFT JOIN (SELECT "
        "CAST(floor(arrival_ms / 1000.0 / 300) * 300 AS BIGINT) AS period, max(arrival_ms - event_ms) "
        f"AS max_lag_ms FROM {src} GROUP BY 1) l USING (period)))")


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    ev = with_(EVENTS_FLAT)
    inter = with_(EVENTS_FLAT, INTERACTIONS_CTE)
    items_w = with_(ITEMS_FLAT, ITEM_ROWS, ITEMS)

    # 2.1
    q["scan_rolling_month"] = ev + (
        "SELECT eventdate, timestamp, year, month, day FROM events_flat WHERE "
        "make_date(year, month, day) > DATE '2023-12-20' AND make_date(year, month, day) <= "
        "DATE '2024-01-20'")
    q["scan_content"] = with_(ITEMS_FLAT) + (
        "SELECT contentid, category, section, contenttext, publisheddate, wordcount, sponsored, "
        "keywords_text AS keywords FROM items_flat")
    q["write_interactions"] = inter + "SELECT * FROM interactions"
    q["write_items"] = items_w + "SELECT * FROM items"
    q["refresh_snapshot"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS) + (
        "SELECT 'interactions' AS dataset, count(*) AS \"rows\" FROM interactions UNION ALL "
        "SELECT 'items', count(*) FROM items")
    q["decode_stream_events"] = ev + "SELECT sp_event_id AS record_id, " + ", ".join(
        f'{k} AS "{fx.STREAM_NAME.get(k, k)}"' for k in fx.STREAM_EVENT_KEYS) + " FROM events_flat"
    q["shard_stream"] = q["decode_stream_events"]
    q["decode_stream_content"] = with_(ITEMS_FLAT, CONTENT_FLAT) + (
        "SELECT CAST(doc_id AS VARCHAR) AS record_id, \"ContentId\", \"Category\", \"Section\", "
        "\"ContentText\", \"ContentType\", \"UpdatedDate\", \"Published\", \"Sponsored\", "
        "keywords_text AS \"Keywords\", \"WordCount\" FROM content_flat")
    q["scan_active_settings"] = with_(SETTINGS) + (
        "SELECT name, status, \"eventTrackerId\", \"datasetArn\", \"campaignArn\", \"trafficRatio\" "
        "FROM settings WHERE status = 'active'")
    q["validate_dataset"] = with_(ITEMS_FLAT, ITEM_ROWS) + (
        "SELECT ITEM_ID, CREATION_TIMESTAMP, ContentText, Category, TRY_CAST(WordCount AS INTEGER) AS "
        "WordCount, Exclude, CASE WHEN ITEM_ID IS NULL THEN 'missing ITEM_ID' WHEN "
        "CREATION_TIMESTAMP IS NULL THEN 'missing CREATION_TIMESTAMP' WHEN WordCount IS NOT NULL AND "
        "TRY_CAST(WordCount AS INTEGER) IS NULL THEN 'bad WordCount' END AS skip_reason FROM item_rows")

    fields = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{f}' AS field, '{'bigint' if t == 'long' else t}' AS type, "
        + (f"'{schemas.FIELD_FLAGS[f]}'" if f in schemas.FIELD_FLAGS else "CAST(NULL AS VARCHAR)") + " AS flag"
        for name, declared in (("interactions", schemas.INTERACTIONS_FIELDS), ("items", schemas.ITEMS_FIELDS)) for f, t, _ in declared)
    q["dataset_flags"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS) + (
        f", fields AS ({fields}), sizes AS (SELECT 'interactions' AS dataset, count(*) AS n FROM interactions UNION ALL SELECT 'items', count(*) "
        "FROM item_rows WHERE ITEM_ID IS NOT NULL AND CREATION_TIMESTAMP IS NOT NULL AND (WordCount IS NULL OR TRY_CAST(WordCount AS "
        "INTEGER) IS NOT NULL)) SELECT dataset, n, field, type, flag FROM fields JOIN sizes USING (dataset)")
    q["validate_interactions"] = ev + (
        f"SELECT *, CASE WHEN USER_ID IS NULL THEN 'missing USER_ID' WHEN ITEM_ID IS NULL THEN 'missing ITEM_ID' WHEN \"TIMESTAMP\" IS NULL "
        f"THEN 'missing TIMESTAMP' WHEN EVENT_TYPE IS NULL THEN 'missing EVENT_TYPE' END AS skip_reason FROM ({INTERACTIONS_SELECT})")

    # 2.2
    q["pivot_attributes"] = ev + "SELECT " + ", ".join(
        fx.BATCH_ATTRIBUTE_KEYS + ["timestamp", "datetime_collector_local", "eventdate",
                                   "datetime_local", "year", "month", "day"]) + " FROM events_flat"
    q["apply_mapping"] = with_(ITEMS_FLAT) + (
        "SELECT keywords_text AS \"Keywords\", category AS \"Category\", section AS \"Section\", "
        "contenttext AS \"ContentText\", wordcount AS \"WordCount\", contentid AS \"ITEM_ID\", "
        "publisheddate AS \"CREATION_TIMESTAMP\", CAST(sponsored AS INTEGER) AS \"Sponsored\" "
        "FROM items_flat")
    q["resolve_user_batch"] = ev + (
        "SELECT sp_event_id, COALESCE(sp_user_id, sp_domain_userid) AS USER_ID FROM events_flat")
    q["resolve_user_stream"] = ev + f"SELECT sp_event_id, {USER_STREAM} AS \"userId\" FROM events_flat"
    q["epoch_batch"] = ev + (f"SELECT sp_event_id, sp_derived_tstamp, {epoch_iso('sp_derived_tstamp')} "
                             "AS TIMESTAMP FROM events_flat")
    q["epoch_stream"] = ev + (f"SELECT sp_event_id, {epoch_stream('sp_derived_tstamp', INGEST)} "
                              "AS \"sentAt\" FROM events_flat")
    q["exclude_flag_batch"] = with_(ITEMS_FLAT) + (
        f"SELECT contentid AS ITEM_ID, {EXCLUDE_BATCH} AS Exclude FROM items_flat")
    q["exclude_flag_stream"] = with_(ITEMS_FLAT, CONTENT_FLAT) + (
        f"SELECT doc_id, {EXCLUDE_STREAM} AS \"Exclude\" FROM content_flat")
    q["truncate_text"] = with_(ITEMS_FLAT, CONTENT_FLAT) + (
        "SELECT doc_id, substr(\"ContentText\", 1, 20000) AS \"ContentText\", "
        "CAST(length(substr(\"ContentText\", 1, 20000)) AS INTEGER) AS n_chars FROM content_flat")
    rec_obj = ("json_object('sessionId', sp_domain_sessionid, 'userId', " + USER_STREAM
               + ", 'eventList', json_array(json_object('eventId', sp_event_id, 'eventType', "
               "sp_event_name, 'itemId', content_contentid, 'sentAt', "
               + epoch_stream("sp_derived_tstamp", INGEST) + ", 'properties', " + PROPS + "{RID})))")
    q["event_record"] = with_(EVENTS_FLAT, VALIDATED_EVENTS) + (
        "SELECT sp_event_id, CASE WHEN page_rid IS NULL THEN "
        + rec_obj.replace("{RID}", "") + " ELSE "
        + rec_obj.replace("{RID}", ", 'recommendationId', page_rid")
        + " END::VARCHAR AS record FROM validated_events WHERE skip_reason IS NULL")
    q["event_properties_json"] = ev + f"SELECT sp_event_id, {PROPS} AS properties FROM events_flat"
    q["item_record"] = with_(ITEMS_FLAT, CONTENT_FLAT, ITEM_RECORDS) + (
        "SELECT record_id, \"itemId\", properties FROM item_records")
    q["parse_request"] = with_(REQUESTS_FLAT, PARSED) + "SELECT * FROM parsed"
    q["resolve_category"] = with_(REQUESTS_FLAT) + (
        f"SELECT request_id, {category_expr()} AS category FROM requests_flat")
    q["user_context"] = with_(REQUESTS_FLAT) + (
        f"SELECT request_id, {cap('platform')} AS ctx_platform, {cap('visitor_type')} AS "
        "ctx_visitor_type FROM requests_flat")
    q["rename_fields"] = with_(ITEMS_FLAT, CONTENT_META) + (
        "SELECT \"ContentId\" AS content_id, \"Title\" AS title, \"Deck\" AS deck, \"Category\" AS "
        "category, \"Section\" AS section_meta_title, \"State\" AS state, \"CanonicalURL\" AS url, "
        "\"CreditLine\" AS credit, \"Ownership\" AS ownership, \"Sponsored\" AS sponsored, "
        "\"ContentType\" AS content_type, \"ContentRestriction\" AS protection_product, "
        "\"PublishedDate\" AS published_at, \"Caption\" AS caption, \"UpdatedDate\" AS updated_at, "
        "\"Label\" AS label FROM content_meta")
    q["join_byline"] = with_(ITEMS_FLAT, CONTENT_META) + (
        "SELECT \"ContentId\" AS content_id, CASE WHEN \"Byline\" IS NULL THEN NULL ELSE "
        "array_to_string(\"Byline\", ' and ') END AS byline FROM content_meta")
    q["image_urls"] = with_(IMAGES, IMGS) + "SELECT * FROM imgs"
    q["decimal_to_number"] = with_(ITEMS_FLAT, CONTENT_META) + (
        "SELECT \"ContentId\", CASE WHEN \"WordCount\" = floor(\"WordCount\") THEN CAST(CAST(\"WordCount\" AS BIGINT) AS "
        "VARCHAR) ELSE CAST(CAST(\"WordCount\" AS DOUBLE) AS VARCHAR) END AS \"WordCount\" FROM content_meta")
    q["dated_filter_name"] = with_(SETTINGS, FILTERS, ENTRIES) + (
        "SELECT name, context, filter_name || '-2024-01-30' AS dated_filter_name FROM entries")

    # 2.3
    q["recent_interactions"] = ev + (
        f"SELECT * FROM (SELECT sp_event_id, {epoch_iso('sp_derived_tstamp')} AS TIMESTAMP FROM "
        f"events_flat) WHERE TIMESTAMP > {epoch_midnight(C.INTERACTION_WINDOW_DAYS)}")
    q["recent_items"] = with_(ITEMS_FLAT, ITEM_ROWS) + (
        "SELECT ITEM_ID, CREATION_TIMESTAMP FROM item_rows WHERE CREATION_TIMESTAMP > "
        f"{epoch_midnight(C.ITEM_WINDOW_DAYS)}")
    q["page_view_filters"] = ev + (
        f"SELECT sp_event_id, sp_app_id, sp_event_name, page_type FROM events_flat WHERE {RULE_PAGE_VIEW}")
    q["content_id_filters"] = ev + (
        f"SELECT sp_event_id, content_contentid FROM events_flat WHERE {RULE_CONTENT_ID}")
    q["bot_filter"] = ev + (
        f"SELECT sp_event_id, device_detector_visitorplatform FROM events_flat WHERE {RULE_BOT}")
    q["premium_filter"] = ev + (
        f"SELECT sp_event_id, visitor_servicecode FROM events_flat WHERE {RULE_PREMIUM}")
    q["isp_denylist"] = ev + f"SELECT sp_event_id, sp_ip_isp FROM events_flat WHERE {RULE_ISP}"
    q["host_denylist"] = ev + f"SELECT sp_event_id, sp_page_urlhost FROM events_flat WHERE {RULE_HOST}"
    q["drop_incomplete_interactions"] = ev + (
        f"SELECT * FROM ({INTERACTIONS_SELECT}) WHERE USER_ID IS NOT NULL AND ITEM_ID IS NOT NULL "
        "AND TIMESTAMP IS NOT NULL AND EVENT_TYPE IS NOT NULL")
    q["drop_incomplete_items"] = with_(ITEMS_FLAT, ITEM_ROWS) + (
        "SELECT * FROM item_rows WHERE ITEM_ID IS NOT NULL AND CREATION_TIMESTAMP IS NOT NULL "
        "AND ContentText IS NOT NULL")
    q["validate_events"] = ev + f"SELECT sp_event_id, {EVENT_SKIP} AS skip_reason FROM events_flat"
    q["validate_content"] = with_(ITEMS_FLAT, CONTENT_FLAT) + (
        f"SELECT CAST(doc_id AS VARCHAR) AS record_id, {CONTENT_SKIP} AS skip_reason FROM content_flat")
    cand_w = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS, REQUESTS_FLAT,
                   HCAND, VIEWED)
    base = "SELECT c.request_id, c.item_id FROM hcand c LEFT JOIN items i ON i.ITEM_ID = c.item_id WHERE "
    q["item_filter_category"] = cand_w + base + f"{INC_CAT} AND {EXC_FLAG} AND {NOT_VIEWED}"
    q["item_filter_unread"] = cand_w + base + f"{INC_CREATED} AND {EXC_FLAG} AND {NOT_VIEWED}"
    q["item_filter_exclcat"] = cand_w + base + (
        f"{INC_CREATED} AND {EXC_CAT} AND {EXC_FLAG} AND {NOT_VIEWED}")
    q["item_filter_age"] = items_w + (
        "SELECT ITEM_ID AS item_id, CREATION_TIMESTAMP AS item_created FROM items i WHERE " + AGE_OK)
    req_w = with_(*REQ_CTES)
    q["time_range_rule"] = req_w + "SELECT request_id, kind, category, dated FROM resolved"
    q["drop_last_content"] = with_(EVENTS_FLAT, REQUESTS_FLAT, HCAND) + (
        "SELECT request_id, item_id FROM hcand WHERE NOT COALESCE(last_content_ids IS NOT NULL "
        "AND length(last_content_ids) > 0 AND item_id = last_content_ids, false)")

    # 2.4
    q["enrich_metadata"] = with_(EVENTS_FLAT, ITEMS_FLAT, CONTENT_META, REQUESTS_FLAT, HCAND, META) + (
        "SELECT c.request_id, c.item_id, m.title, m.byline, m.url, m.section_meta_title, "
        "m.word_count FROM hcand c JOIN meta m ON m.content_id = c.item_id")
    q["enrich_images"] = with_(EVENTS_FLAT, IMAGES, REQUESTS_FLAT, HCAND, IMGS) + (
        "SELECT c.request_id, c.item_id, g.author_url220, g.picture_url220, "
        "g.content_id IS NOT NULL AS has_images FROM hcand c LEFT JOIN imgs g ON g.content_id = c.item_id")
    q["exclude_viewed"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, REQUESTS_FLAT, HCAND, VIEWED) + (
        f"SELECT c.request_id, c.item_id FROM hcand c WHERE {NOT_VIEWED}")
    q["fanout_events"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, SETTINGS) + (
        f"SELECT sp_domain_sessionid AS \"sessionId\", {USER_STREAM} AS \"userId\", sp_event_id AS "
        "\"eventId\", sp_event_name AS \"eventType\", content_contentid AS \"itemId\", "
        f"{epoch_stream('sp_derived_tstamp', INGEST)} AS \"sentAt\", {PROPS} AS properties, "
        "page_rid AS \"recommendationId\", s.\"eventTrackerId\" AS \"trackingId\" "
        "FROM validated_events e CROSS JOIN settings s WHERE e.skip_reason IS NULL "
        "AND s.status = 'active'")
    q["fanout_items"] = with_(ITEMS_FLAT, CONTENT_FLAT, ITEM_RECORDS, SETTINGS) + (
        "SELECT r.*, s.\"datasetArn\" AS \"datasetArn_target\" FROM item_records r CROSS JOIN "
        "settings s WHERE s.status = 'active'")
    q["settings_as_of"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, SETTINGS) + (
        f", e AS (SELECT sp_event_id, {epoch_iso('sp_derived_tstamp')} AS happened FROM validated_events WHERE skip_reason IS NULL)\n"
        "SELECT sp_event_id, happened, \"eventTrackerId\" AS \"trackingId\" FROM e JOIN settings ON \"eventTrackerId\" IS NOT NULL AND happened >= 0 AND "
        "CASE WHEN happened < epoch(DATE '2024-01-11') THEN status = 'active' WHEN happened < epoch(DATE '2024-01-21') THEN status = 'active' AND "
        "\"eventTrackerId\" <> (SELECT min(\"eventTrackerId\") FROM settings WHERE status = 'active') ELSE true END")
    q["context_lookup"] = req_w + "SELECT request_id, backend, filter_name, kind FROM resolved"
    q["assign_backend"] = with_(REQUESTS_FLAT, SETTINGS, PARSED, SPANS, ASSIGNED) + (
        "SELECT request_id, backend FROM assigned")

    # 2.5
    q["distinct_attribute_keys"] = ev + " UNION ".join(
        f"SELECT '{k}' AS key FROM events_flat WHERE {k} IS NOT NULL" for k in fx.BATCH_ATTRIBUTE_KEYS)
    q["ingest_counters"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, ITEMS_FLAT, CONTENT_FLAT, SETTINGS) + (
        "SELECT 'events' AS stream, count(*) FILTER (WHERE skip_reason IS NULL) * "
        "(SELECT count(*) FROM settings WHERE status = 'active') AS success, CAST(0 AS BIGINT) AS fail, "
        "count(*) FILTER (WHERE skip_reason IS NOT NULL) AS skip FROM validated_events UNION ALL "
        f"SELECT 'content', count(*) FILTER (WHERE ({CONTENT_SKIP}) IS NULL) * (SELECT count(*) FROM "
        "settings WHERE status = 'active'), CAST(0 AS BIGINT), count(*) FILTER (WHERE "
        f"({CONTENT_SKIP}) IS NOT NULL) FROM content_flat")
    rec = recommend_ctes()
    q["coverage_metrics"] = rec + (
        "SELECT q.request_id, CAST(COALESCE(g.returned, 0) AS BIGINT) AS returned, "
        "CAST(q.num_results - COALESCE(g.returned, 0) AS BIGINT) AS missing, "
        "CAST(q.num_results - COALESCE(g.n_meta, 0) AS BIGINT) AS missing_metadata, "
        "CAST(q.num_results - COALESCE(g.n_img, 0) AS BIGINT) AS missing_images, "
        "CAST(COALESCE(g.backup, 0) AS BIGINT) AS backup FROM resolved q LEFT JOIN ("
        "SELECT r.request_id, count(*) AS returned, sum(CAST(r.backup AS INTEGER)) AS backup, "
        "count(m.content_id) AS n_meta, count(g.content_id) AS n_img FROM ranked r LEFT JOIN meta m "
        "ON m.content_id = r.item_id LEFT JOIN imgs g ON g.content_id = r.item_id "
        "GROUP BY r.request_id) g ON g.request_id = q.request_id")
    metrics = (
        "metrics AS (SELECT epoch_ms(ts) // 1000 AS ts, " + fx.METRIC_NAME + " AS metric, CAST("
        + fx.METRIC_VALUE + " AS DOUBLE) AS value FROM events UNION ALL SELECT epoch_ms(ts) // 1000, "
        f"'RecommendationsUsed', 1.0 FROM events WHERE ({fx.PAGE_RID}) IS NOT NULL)")
    rollup = ("rollup AS (SELECT metric, (ts // 300) * 300 AS period, sum(value) AS sum, max(value) "
              "AS maximum, avg(value) AS average, quantile_cont(value, 0.95) AS p95, count(*) AS samples FROM metrics GROUP BY ALL)")
    q["metric_rollup"] = with_(metrics, rollup) + (
        "SELECT metric, period, round(sum, 6) AS sum, round(maximum, 6) AS maximum, "
        "round(average, 6) AS average, round(p95, 6) AS p95, samples FROM rollup")
    rules = "rules(alarm, metric, stat, threshold, periods, missing) AS (VALUES " + ", ".join(
        f"('{a}', '{m}', '{s}', {t}, {n}, '{x[0] if x else 'missing'}')" for a, m, s, t, n, *x in C.ALARM_RULES) + ")"
    q["alarm_rule"] = with_(metrics, rollup, rules) + (
        ", span AS (SELECT metric, min(period) AS lo, max(period) AS hi FROM rollup GROUP BY metric),\n"
        "grid AS (SELECT metric, unnest(generate_series(lo, hi, 300)) AS period FROM span),\n"
        "dense AS (SELECT g.metric, g.period, r.sum, r.maximum, r.average FROM grid g LEFT JOIN rollup r "
        "USING (metric, period)),\n"
        "st AS (SELECT u.alarm, d.period, u.periods, u.missing, CASE WHEN u.stat = 'sum' THEN d.sum WHEN "
        "u.stat = 'max' THEN d.maximum ELSE d.average END AS value, u.threshold FROM dense d JOIN "
        "rules u USING (metric)),\n"
        "b AS (SELECT *, COALESCE(value >= threshold, false) AS breaching FROM st),\n"
        "pts AS (SELECT *, row_number() OVER (PARTITION BY alarm ORDER BY period) AS seq FROM b "
        "WHERE value IS NOT NULL OR missing = 'notBreaching'),\n"
        "fired AS (SELECT p.alarm, p.period, (SELECT count(*) FROM pts p2 WHERE p2.alarm = p.alarm AND "
        "p2.breaching AND p2.seq BETWEEN p.seq - (p.periods - 1) AND p.seq) >= p.periods AS fires FROM pts p)\n"
        "SELECT b.alarm, b.period, round(b.value, 6) AS value, b.breaching, COALESCE(last_value(f.fires "
        "IGNORE NULLS) OVER (PARTITION BY b.alarm ORDER BY b.period), false) AS in_alarm FROM b "
        "LEFT JOIN fired f ON f.alarm = b.alarm AND f.period = b.period")
    # on the stream: periods that the watermark (10 minutes behind the newest sample) has closed
    last = "(SELECT (max(ts) - 600) // 300 * 300 - 300 FROM metrics)"
    q["stream_alarms"] = q["alarm_rule"].replace(
        "max(period) AS hi FROM rollup GROUP BY", f"{last} AS hi FROM rollup WHERE period <= {last} GROUP BY")
    q["metric_sketch"] = with_(metrics) + (
        "SELECT metric, (ts // 3600) * 3600 AS period, round(sum(value), 6) AS sum, round(max(value), 6) AS maximum, "
        "round(avg(value), 6) AS average, count(*) AS samples, true AS p95_within FROM metrics GROUP BY ALL")
    q["tps"] = with_(metrics) + (
        "SELECT (ts // 300) * 300 AS period, round(sum(value) / 300.0, 6) AS tps FROM metrics "
        "WHERE metric = 'GetRecommendations' GROUP BY 1")
    used = ("used AS (SELECT (CAST(floor(epoch(CAST(\"timestamp\" AS TIMESTAMP))) AS BIGINT) // 300) * 300 AS period, "
            "count(page_rid) AS used FROM validated_events WHERE skip_reason IS NULL GROUP BY 1)")
    q["recommendations_used"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, used) + "SELECT * FROM used"
    q["recommendation_use_rate"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, used, metrics) + (
        ", r AS (SELECT (ts // 3600) * 3600 AS period, sum(value) AS requests FROM metrics WHERE "
        "metric = 'GetRecommendations' GROUP BY 1),\n"
        "u AS (SELECT (period // 3600) * 3600 AS period, sum(used) AS used FROM used GROUP BY 1)\n"
        "SELECT COALESCE(r.period, u.period) AS period, CAST(COALESCE(u.used, 0) AS BIGINT) AS used, "
        "round(COALESCE(r.requests, 0.0), 6) AS requests, round(CASE WHEN r.requests > 0 THEN "
        "COALESCE(u.used, 0) / (r.requests / 2) * 100 END, 6) AS use_rate FROM r FULL OUTER JOIN u "
        "ON r.period = u.period")
    rec_json = (
        "json_object('title', title, 'deck', deck, 'byline', byline, 'category', category, "
        "'section_meta_title', section_meta_title, 'keywords', keywords, 'state', state, 'url', url, "
        "'credit', credit, 'ownership', ownership, 'sponsored', sponsored, 'content_id', content_id, "
        "'content_type', content_type, 'protection_product', protection_product, 'published_at', "
        "published_at, 'word_count', CASE WHEN word_count = floor(word_count) THEN "
        "to_json(CAST(word_count AS BIGINT)) ELSE to_json(word_count) END, 'caption', caption, "
        "'updated_at', updated_at, 'label', label, "
        "'author_rel', CASE WHEN has_images THEN json_array(json_object('url220', author_url220)) END, "
        "'picture_rel', CASE WHEN has_images THEN json_array(json_object('url220', picture_url220)) END, "
        "'promo_image', CASE WHEN has_images THEN json_object('urls', json_object('url220', "
        "picture_url220)) END)")
    q["reply_assembly"] = rec + (
        ", per AS (SELECT request_id, to_json(list(" + rec_json + " ORDER BY position)) AS recs FROM rows "
        "GROUP BY request_id)\n"
        "SELECT q.request_id, json_object('request_id', q.request_id, 'container_position', 0, "
        "'widget_id', q.widget_id, 'recommendationId', CASE WHEN q.backend IS NOT NULL THEN "
        "q.backend || ':' || CAST(q.request_id AS VARCHAR) END, "
        "'recommendations', COALESCE(p.recs, json('[]')))::VARCHAR AS reply "
        "FROM resolved q LEFT JOIN per p ON p.request_id = q.request_id")

    # 2.6
    q["sorted_interactions"] = inter + "SELECT * FROM interactions"
    q["topk_per_request"] = rec + "SELECT request_id, item_id, rank, round(score, 6) AS score FROM ranked"
    q["fallback_filter"] = rec + (
        "SELECT request_id, any_value(filter_dated) AS filter_dated, any_value(backup) AS backup, "
        "count(*) AS \"rows\" FROM ranked GROUP BY request_id")

    # 2.7
    q["build_context_map"] = with_(SETTINGS, FILTERS, ENTRIES) + (
        "SELECT name, context, filter_name, kind, limit_time_range, array_to_string(filter_values, '|') "
        "AS filter_values, array_to_string(sections, '|') AS sections FROM entries")
    q["upsert_items"] = with_(ITEMS_FLAT, CONTENT_FLAT, ITEM_RECORDS) + (
        ", allv AS (SELECT record_id, updated_ts, \"itemId\", properties FROM item_records UNION ALL "
        "SELECT record_id || '-replay', updated_ts - 86400, \"itemId\", '{}' FROM item_records)\n"
        "SELECT \"itemId\", updated_ts, record_id, properties FROM (SELECT *, row_number() OVER "
        "(PARTITION BY \"itemId\" ORDER BY updated_ts DESC, record_id DESC) AS rn FROM allv) "
        "WHERE rn = 1")

    # 2.8
    q["stream_events"] = q["fanout_events"]
    q["deliver_events"] = with_(EVENTS_FLAT, VALIDATED_EVENTS, SETTINGS) + (
        ", pairs AS (SELECT sp_event_id, \"eventTrackerId\" AS target, \"eventTrackerId\" = (SELECT "
        "min(\"eventTrackerId\") FROM settings WHERE status = 'active') AND CAST(regexp_extract("
        "sp_event_id, '[0-9]+') AS BIGINT) % 3 = 0 AS refused FROM validated_events CROSS JOIN settings "
        "WHERE skip_reason IS NULL AND status = 'active' AND \"eventTrackerId\" IS NOT NULL)\n"
        "SELECT target, count(*) FILTER (WHERE NOT refused) AS success, count(*) FILTER (WHERE refused) AS fail, "
        "count(*) FILTER (WHERE NOT refused) AS records, count(DISTINCT sp_event_id) FILTER (WHERE NOT refused) "
        "AS events FROM pairs GROUP BY target")
    q["stream_content"] = with_(ITEMS_FLAT, CONTENT_FLAT, ITEM_RECORDS) + (
        "SELECT \"itemId\", updated_ts, record_id, properties FROM (SELECT *, row_number() OVER "
        "(PARTITION BY \"itemId\" ORDER BY updated_ts DESC, record_id DESC) AS rn FROM item_records) "
        "WHERE rn = 1")
    q["stream_lag"] = with_(ITEMS_FLAT, CONTENT_FLAT) + (
        ", ea AS (SELECT (epoch_ms(ts) // 1000) * 1000 AS event_ms, (epoch_ms(ts) // 1000) * 1000 + "
        "(event_id % 7) * 2000 AS arrival_ms FROM events),\n"
        f"ca AS (SELECT {epoch_iso(chr(34) + 'UpdatedDate' + chr(34))} * 1000 AS event_ms, "
        f"{epoch_iso(chr(34) + 'UpdatedDate' + chr(34))} * 1000 + (doc_id % 13) * 1000 AS arrival_ms "
        "FROM content_flat WHERE " + epoch_iso('"UpdatedDate"') + " IS NOT NULL)\n"
        + lag_block("events", "ea", 10) + " UNION ALL " + lag_block("content", "ca", 1))
    # 2.9
    q["similar_items"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, SIMS) + (
        "SELECT item_id, similar_item_id, round(sim, 6) AS sim, rank FROM sims")
    pers_w = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS, SIMS, PERS)
    since = epoch_midnight(5)
    q["similar_items_incremental"] = with_(
        EVENTS_FLAT, INTERACTIONS_CTE.replace("interactions AS", "every_interaction AS", 1),
        f"interactions AS (SELECT * FROM every_interaction WHERE \"TIMESTAMP\" >= {since})", SIMS) + (
        "SELECT item_id, similar_item_id, round(sim, 6) AS sim, rank FROM sims")
    q["user_personalization"] = pers_w + (
        "SELECT user_id, item_id, round(affinity, 6) AS affinity, fresh, round(score, 6) AS score "
        "FROM pers")
    def u(*parts: str) -> str:
        text = " || '|' || ".join(["'2024-01-31'", *parts])
        return f"((CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"

    ids = ("CAST(request_id AS VARCHAR)", "CAST(p AS VARCHAR)", "CAST(pool AS VARCHAR)")
    q["explore_items"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS, SIMS, PERS, REQUESTS_FLAT) + (
        f", new_items AS (SELECT DISTINCT \"ITEM_ID\" AS item_id FROM items WHERE {epoch_midnight(0)} - \"CREATION_TIMESTAMP\" <= 86400 "
        "AND coalesce(\"Exclude\", 0) <> 1),\n"
        "ranked AS (SELECT * FROM (SELECT request_id, item_id, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, item_id) "
        "AS rank FROM requests_flat JOIN pers ON user_id = visitor_id) WHERE rank <= 25),\n"
        f"reqs AS (SELECT request_id, visitor_id, CAST(floor({u(chr(39) + 'pool' + chr(39), ids[0])} * 64) AS INTEGER) AS pool FROM requests_flat),\n"
        f"places AS (SELECT request_id, p, row_number() OVER (PARTITION BY request_id ORDER BY p) AS nth FROM reqs, "
        f"(SELECT unnest(range(1, 26)) AS p) WHERE {u(chr(39) + 'place' + chr(39), ids[0], ids[1])} < 0.3),\n"
        f"keyed AS (SELECT pool, item_id, -ln(-ln({u(chr(39) + 'item' + chr(39), ids[2], 'item_id')})) AS g FROM new_items, "
        "(SELECT unnest(range(0, 64)) AS pool)),\n"
        "blocked AS (SELECT request_id, item_id FROM ranked UNION SELECT request_id, \"ITEM_ID\" FROM requests_flat JOIN interactions "
        "ON \"USER_ID\" = visitor_id),\n"
        "chosen AS (SELECT request_id, item_id, row_number() OVER (PARTITION BY request_id ORDER BY g DESC, item_id) AS nth "
        "FROM reqs JOIN keyed USING (pool) ANTI JOIN blocked USING (request_id, item_id)),\n"
        "new AS (SELECT request_id, p, item_id FROM chosen JOIN places USING (request_id, nth)),\n"
        "rest AS (SELECT request_id, p, row_number() OVER (PARTITION BY request_id ORDER BY p) AS rank FROM (SELECT request_id, p FROM "
        "reqs, (SELECT unnest(range(1, 26)) AS p)) ANTI JOIN new USING (request_id, p))\n"
        "SELECT request_id, CAST(p AS INTEGER) AS position, item_id, true AS explored FROM new UNION ALL "
        "SELECT request_id, CAST(p AS INTEGER), item_id, false FROM ranked JOIN rest USING (request_id, rank)")
    q["next_items"] = ev + (
        f", v AS (SELECT sp_domain_sessionid AS session, {epoch_iso('sp_derived_tstamp')} AS ts, CAST(sp_event_id AS BIGINT) AS id, "
        "content_contentid AS item FROM events_flat WHERE sp_event_name = 'page_view'),\n"
        "o AS (SELECT *, lag(item) OVER w AS b, lag(item, 2) OVER w AS a, row_number() OVER (PARTITION BY session ORDER BY ts DESC, id DESC) "
        "AS back FROM v WHERE session IS NOT NULL AND ts IS NOT NULL AND id IS NOT NULL AND item IS NOT NULL WINDOW w AS (PARTITION BY "
        "session ORDER BY ts, id)),\n"
        "want AS (SELECT DISTINCT b AS a, item AS b FROM o WHERE back = 1),\n"
        "st AS (SELECT a, b, item AS x FROM o WHERE b IS NULL OR b <> item),\n"
        "n3 AS (SELECT *, sum(n) OVER (PARTITION BY a, b) AS t FROM (SELECT a, b, x, count(*) AS n FROM st WHERE a IS NOT NULL GROUP BY a, b, x)),\n"
        "n2 AS (SELECT *, sum(n) OVER (PARTITION BY b) AS t FROM (SELECT b, x, count(*) AS n FROM st WHERE b IS NOT NULL GROUP BY b, x)),\n"
        "n1 AS (SELECT *, sum(n) OVER () AS t FROM (SELECT x, count(*) AS n FROM st GROUP BY x)),\n"
        "sc AS (SELECT w.a, w.b, n1.x, CASE WHEN n3.n > 0 THEN 2 WHEN n2.n > 0 THEN 1 ELSE 0 END AS ord, CASE WHEN n3.n > 0 THEN "
        "1.0 * n3.n / n3.t WHEN n2.n > 0 THEN CAST(0.4 AS DOUBLE) * n2.n / n2.t ELSE CAST(0.16 AS DOUBLE) * n1.n / n1.t END AS score FROM want w "
        "CROSS JOIN n1 LEFT JOIN n3 ON n3.a = w.a AND n3.b = w.b AND n3.x = n1.x LEFT JOIN n2 ON n2.b = w.b AND n2.x = n1.x)\n"
        "SELECT a, b, x AS item_id, ord AS \"order\", round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY a, b ORDER BY "
        "round(score, 12) DESC, ord DESC, x) AS INTEGER) AS rank FROM sc QUALIFY rank <= 10")
    q["personalized_ranking"] = with_(EVENTS_FLAT, INTERACTIONS_CTE, ITEMS_FLAT, ITEM_ROWS, ITEMS,
                                      SIMS, PERS, REQUESTS_FLAT, HCAND) + (
        "SELECT request_id, item_id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY "
        "request_id ORDER BY score DESC, item_id ASC) AS INTEGER) AS rank FROM (SELECT c.request_id, "
        "c.item_id, COALESCE(p.score, 0.0) AS score FROM hcand c LEFT JOIN pers p ON p.user_id = "
        "c.user_id AND p.item_id = c.item_id)")
    q["recommend_batch"] = rec + (
        "SELECT request_id, position, content_id, title, byline, url, author_url220, picture_url220, "
        "round(score, 6) AS score FROM rows")

    # composite
    q["build_interactions"] = inter + "SELECT * FROM interactions"
    q["build_items"] = items_w + "SELECT * FROM items"
    return q
