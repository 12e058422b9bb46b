"""SQL counterparts of the registered queries, on the given tables only.

They restate the derivations as common table expressions and use plain windows,
which is another way to the same answer than the one the operators take.
"""

BASE = "https://www.ejustice.just.fgov.be"
EPOCH = "date '1996-01-01'"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(needs: list[str], select: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][0]:
            visit(other)
        order.append(name)

    for name in needs:
        visit(name)
    body = ",\n".join(f"{name} as (\n{CTES[name][1].strip()}\n)" for name in order)
    return f"with {body}\n{select.strip()}"


cte("raw_rows", [], """
select cast(c_nationkey as varchar) as search_id, o_orderkey as k, c_custkey as ck,
  cast(o_orderdate as date) as d,
  case when o_orderkey % 13 = 0 then 'NO ZIP HERE' else
    'STREET ' || c_custkey || ' ' || (1000 + c_custkey % 9000) || ' ' || n_name end as address,
  case when o_orderkey % 43 = 0 then '' else case when o_orderkey % 41 = 0 then 'BE0' else '0' end || substr(cast(471000000 + c_custkey as varchar), 1, 3) || '.' ||
    substr(cast(471000000 + c_custkey as varchar), 4, 3) || '.' ||
    substr(cast(471000000 + c_custkey as varchar), 7) end as vat_raw,
  case when o_orderkey % 19 = 0 then 'n/a'
    when o_orderkey % 17 = 0 then strftime(o_orderdate, '%Y') || ' / ' || lpad(cast(o_orderkey as varchar), 7, '0')
    else strftime(o_orderdate, '%Y-%m-%d') || ' / ' || lpad(cast(o_orderkey as varchar), 7, '0') end as pub_raw,
  '/tsv_pdf/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || (10000000 + o_orderkey) || '.pdf' as rel,
  case when o_orderkey % 11 = 0 then 0 when o_orderkey % 23 = 0 then 2 else 1 end as n_pdf,
  case when o_orderkey % 7 = 0 then 6 when o_orderkey % 31 = 0 then 3 else 4 end as arity
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""")

cte("ranked_rows", ["raw_rows"], """
select *, row_number() over (partition by search_id order by d desc, k) as search_pos from raw_rows
""")

cte("listing", ["ranked_rows"], """
select *, cast((search_pos - 1) // 100 + 1 as integer) as page, cast((search_pos - 1) % 100 + 1 as integer) as pos,
  case when cast(search_id as integer) % 2 = 0 then date '1997-07-01' end as start_date
from ranked_rows
""")

cte("unpacked", ["listing"], """
select *, case when arity <> 3 then address end as m_address, case when arity <> 3 then vat_raw end as m_vat,
  case when arity <> 3 then 'ACT' end as m_act, case when arity <> 3 then pub_raw end as m_pub
from listing
""")

cte("typed", ["unpacked"], f"""
select search_id, page, pos, k, ck, d, start_date, n_pdf,
  case when n_pdf = 1 then rel end as rel1,
  n_pdf = 2 as multiple_pdf,
  coalesce(cast(try_cast(replace(m_vat, '.', '') as bigint) as varchar), nullif(replace(m_vat, '.', ''), '')) as vat,
  case when n_pdf = 1 then cast(10000000 + k as varchar) end as pubid,
  m_act as act_description, 'CO ' || k as company_name,
  case when k % 3 = 0 then 'BV' else 'NV' end as company_juridical_form,
  m_address as address,
  nullif(regexp_extract(m_address, '^(.*) ([0-9]{{4}}) (.*)$', 1), '') as street,
  nullif(regexp_extract(m_address, '^(.*) ([0-9]{{4}}) (.*)$', 2), '') as zipcode,
  nullif(regexp_extract(m_address, '^(.*) ([0-9]{{4}}) (.*)$', 3), '') as city,
  case when regexp_matches(m_pub, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} / [0-9]+$') then cast(substr(m_pub, 1, 10) as date)
    when regexp_matches(m_pub, '^[0-9]{{4}} / [0-9]+$') then make_date(cast(substr(m_pub, 1, 4) as integer), 1, 1)
    end as pdate,
  nullif(regexp_extract(m_pub, ' / ([0-9]+)$', 1), '') as publication_number,
  case when n_pdf = 1 then '{BASE}' || rel end as publication_link
from unpacked
""")

cte("lake_files", ["raw_rows"], """
select (471000000 + ck) || '/' || strftime(d, '%Y/%m/%d') || '/' || lpad(cast(k as varchar), 7, '0') || '.json' as path
from raw_rows where k % 5 = 0
""")

cte("index_rows", ["lake_files"], """
select path as blob_key, string_split(path, '/')[1] as vat, replace(string_split(path, '/')[5], '.json', '') as publication_number
from lake_files
""")

cte("results", ["raw_rows"], f"""
select '{BASE}' || rel as url, k % 29 <> 0 as ok, replace(rel, '/tsv_pdf', '') as path from raw_rows where k % 37 <> 0
""")

cte("cut", ["typed"], f"""
select *, coalesce(max(cast(pdate < coalesce(start_date, {EPOCH}) as integer)) over (
    partition by search_id order by page, pos rows between unbounded preceding and current row), 0) = 1 as below_cutoff
from typed
""")

cte("decided", ["cut", "index_rows", "results"], """
select cut.*, ok as downloaded, path as file_path,
  case when below_cutoff then 'below_cutoff' when multiple_pdf then 'multiple_pdf' when rel1 is null then 'no_pdf'
    when exists (select 1 from index_rows i where i.vat = cut.vat and i.publication_number = cut.publication_number)
      then 'already_stored'
    when ok is null then 'not_fetched' when not ok then 'robots' when pdate is null then 'no_date'
    when vat is null or publication_number is null then 'missing_key' end as reject_reason
from cut left join results on results.url = cut.publication_link
""")

# Page layouts

cte("sentences", [], """
select doc_id, list_filter(string_split(replace(text, '. ', '.' || chr(10)), chr(10)), lambda s: s <> '') as ls
from documents
""")

cte("doc_pages", ["sentences"], """
select doc_id, len(ls) as n_lines, cast(ceil(len(ls) / 40.0) as bigint) as n_pages from sentences
""")

cte("ocr_pages", ["doc_pages"], """
select doc_id, unnest(range(n_pages)) as page_idx, n_pages from doc_pages
""")

cte("all_lines", ["sentences"], """
select doc_id, ln // 40 as page_idx, ln % 40 as j, content, ((ln % 40) * 7) % 40 as slot
from (select doc_id, unnest(ls) as content, unnest(range(len(ls))) as ln from sentences)
""")

cte("ocr_lines", ["all_lines"], """
select doc_id, page_idx, j, content,
  cast(case when (slot + doc_id) % 11 = 0 then 0.5 else 1.5 + ((slot * 3 + doc_id) % 8) * 0.5 end as double) as x0,
  cast(case when (slot + doc_id) % 13 = 0 then 8.25 else 3.5 + ((slot * 3 + doc_id) % 8) * 0.5 end as double) as x1,
  cast(0.25 as double) + cast(slot - cast(slot % 5 = 1 as integer) as double) * cast(0.2421875 as double)
    + cast(case when slot % 5 = 1 then 0.0078125 else 0 end as double) as y0,
  cast(case when (slot + doc_id) % 2 = 0 then 0.125 else 0.1875 end as double) as h
from all_lines
""")

cte("zipped", ["ocr_pages"], """
select doc_id, page_idx, cast(8.5 as double) as ocr_width, cast(10 as double) as ocr_height,
  cast(case when (doc_id + page_idx) % 3 = 0 then 612 else 595 end as double) as width,
  cast(case when (doc_id + page_idx) % 3 = 0 then 792 else 842 end as double) as height
from ocr_pages where page_idx < n_pages - cast(doc_id % 16 = 5 as integer)
""")

cte("bodies", ["zipped"], """
select *, width / ocr_width as by_x, height / ocr_height as by_y,
  cast(0.15966 as double) * width as "left",
  cast(case when page_idx = 0 then 0.20485 else 0.04899 end as double) * height as top,
  cast(0.95 as double) * width as "right", cast(0.9195 as double) * height as bottom
from zipped
""")

cte("heights", ["ocr_lines"], """
select doc_id, page_idx, h from (
  select doc_id, page_idx, h,
    row_number() over (partition by doc_id, page_idx order by count(*) desc, min(j)) as r
  from ocr_lines group by doc_id, page_idx, h)
where r = 1
""")

cte("page_heights", ["bodies", "heights"], """
select b.*, h.h * b.by_y as line_height from bodies b left join heights h using (doc_id, page_idx)
""")

cte("placed", ["ocr_lines", "page_heights"], """
select l.doc_id, l.page_idx, l.j, l.content, l.y0 as raw_y0, l.x0 as raw_x0,
  l.x0 * b.by_x as x0, l.y0 * b.by_y as y0, l.x1 * b.by_x as x1, (l.y0 + l.h) * b.by_y as y1,
  b.line_height, b."left", b.top, b."right", b.bottom
from ocr_lines l join page_heights b using (doc_id, page_idx)
""")

cte("cropped", ["placed"], """
select * from placed where "left" <= x0 and x1 <= "right" and top <= y0 and y1 <= bottom
""")

_PREVIOUS = """
select *, lag(content) over w as before, lag(x0) over w as px0, lag(y0) over w as py0,
  lag(x1) over w as px1, lag(y1) over w as py1
from {source} window w as (partition by doc_id, page_idx order by raw_y0, raw_x0, j)
"""
_SAME = """
select *, coalesce(py0 <> 0 and py1 <> 0 and abs(py0 - y0) / y0 <= cast(0.05 as double)
  and abs(py1 - y1) / y1 <= cast(0.05 as double)
  and greatest(y1, py1) - least(y0, py0) <= line_height * cast(1.25 as double), false) as same_line
from {source}
"""
cte("neighbours", ["cropped"], _PREVIOUS.format(source="cropped"))
cte("marked", ["neighbours"], _SAME.format(source="neighbours"))
cte("all_neighbours", ["placed"], _PREVIOUS.format(source="placed"))
cte("all_marked", ["all_neighbours"], _SAME.format(source="all_neighbours"))

cte("pieces", ["marked"], """
select *, case when same_line then chr(9)
  when row_number() over (partition by doc_id order by page_idx, raw_y0, raw_x0, j) = 1 then '' else chr(10) end
  || content as piece
from marked
""")

cte("scan_texts", ["pieces"], """
select cast(d.doc_id as varchar) as doc_id, d.doc_id as doc_no, coalesce(t.text, '') as text
from documents d left join (
  select doc_id, string_agg(piece, '' order by page_idx, raw_y0, raw_x0, j) as text from pieces group by doc_id) t
  using (doc_id)
""")

cte("digital_texts", [], """
select cast(doc_id as varchar) as doc_id, doc_id as doc_no,
  case when doc_id % 3 = 0 then '' else
    regexp_replace(ltrim(text, chr(10)), chr(10) || '+', chr(10), 'g') end as text
from documents
""")

cte("texts", ["scan_texts", "digital_texts"], """
select g.doc_id, g.doc_no, case when g.text <> '' then g.text else s.text end as text, g.text <> '' as is_digital
from digital_texts g join scan_texts s using (doc_id)
""")

_RECORD = """vat, pubid, act_description, company_name, company_juridical_form, address, street, zipcode, city,
  strftime(pdate, '%Y-%m-%d') as publication_date, publication_number, publication_link"""
_KEY = "vat || '/' || strftime(pdate, '%Y/%m/%d') || '/' || publication_number || '.json'"

cte("published", ["decided", "texts"], f"""
select {_KEY} as blob_key, {_RECORD}, text, is_digital, 'unprocessed' as status, cast(1 as bigint) as ingest_seq,
  cast(year(pdate) as integer) as pub_year, cast(month(pdate) as integer) as pub_month
from decided left join texts on texts.doc_no = decided.k // 15
where reject_reason is null
""")

cte("records", ["typed"], f"""
select {_KEY} as blob_key, k, vat, publication_number, pubid, company_name, zipcode,
  strftime(pdate, '%Y-%m-%d') as publication_date, 'text of ' || pubid as text
from typed where vat is not null and pdate is not null and rel1 is not null
""")

cte("fetched_counts", ["all_counts"], """
select search_id, page, n_blocks from (select *, max(page) over (partition by search_id) as last from all_counts)
where cast(search_id as integer) % 2 = 0 or page < last
""")

cte("all_counts", ["listing"], """
select search_id, page, count(*) as n_blocks from listing group by search_id, page
union all
select search_id, cast(max(page) + 1 as integer), 0 from listing where cast(search_id as integer) % 4 = 0 group by search_id
""")

_PDF_LINKS = """case n_pdf when 0 then '' when 1 then '<a href="' || rel || '">pdf</a>'
  else '<a href="' || rel || '">pdf</a><a href="/dup.pdf">pdf</a>' end"""
_META = """case arity when 3 then [vat_raw, 'ACT', pub_raw]
  when 6 then [address, vat_raw, 'ACT', pub_raw, 'e1', 'e2'] else [address, vat_raw, 'ACT', pub_raw] end"""
_BLOCK = f"""'<div class="c">' || case when k % 6 = 0 then '<p>note</p>' else '' end || '<p> <font>CO ' || k || '</font> ' || case when k % 3 = 0 then 'BV' else 'NV' end ||
  ' <br></p><a href="/x.html">' || replace(array_to_string({_META}, ' <br>' || chr(10) || ' '), 'ACT', case when k % 5 = 0 then '&#00000065;&#x0000043;T' else 'ACT' end) || '</a>' || {_PDF_LINKS} || '</div></div>'"""

cte("html_rows", ["listing"], f"select *, {_BLOCK} as block, {_META} as meta from listing")

cte("html_pages", ["html_rows"], """
select search_id, page, '<html><body><main>' ||
  string_agg('<div class="list-item">' || block, chr(10) order by pos) || '</main>' as html
from html_rows group by search_id, page
""")

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], select: str) -> None:
    ORACLES[name] = with_ctes(needs, select) if needs else select.strip()


_AT = "search_id, page, pos"

oracle("scan_pages", ["all_counts", "html_pages"], """
select f.search_id, f.page, 'https://gazette.example/list?s=' || f.search_id || '&p=' ||
    case when n_blocks = 0 then f.page - 1 else f.page end as url,
  case when n_blocks = 0 then 25 else length(html) end as n_chars
from all_counts f left join html_pages h on f.search_id = h.search_id and f.page = h.page
""")
oracle("scan_ocr", ["ocr_pages", "ocr_lines"], """
select cast(p.doc_id as varchar) as doc_id, cast(p.page_idx as integer) as page_idx, cast(8.5 as double) as width,
  cast(10 as double) as height, count(*) as n_lines, string_agg(content, '|' order by j) as contents
from ocr_pages p join ocr_lines l using (doc_id, page_idx) group by all
""")
oracle("scan_digital_layout", ["cropped"], """
select cast(d.doc_id as varchar) as doc_id,
  coalesce(t.text || case when z.last_page > t.last_text then chr(10) else '' end, '') as text
from documents d
left join (select doc_id, max(page_idx) as last_page from zipped group by doc_id) z using (doc_id)
left join (select doc_id, max(page_idx) as last_text, string_agg(content, chr(10) order by page_idx, j) as text
  from cropped group by doc_id) t using (doc_id)
""")
oracle("scan_publications", ["records"], """
select vat, zipcode, publication_number, true as is_digital, text from records
""")
oracle("frontier_vat", [], f"""
select cast(c_custkey as varchar) as search_id, cast(471000000 + c_custkey as varchar) as search_vat,
  '{BASE}/cgi_tsv/rech_res.pl?language=nl&btw=0' || (471000000 + c_custkey) as url
from customer
""")
oracle("frontier_date", [], f"""
with ranges as (
  select o_orderkey as k, cast(o_orderdate as date) as first_day,
    case when o_orderkey % 7 = 6 then cast(cast(o_orderdate as date) + interval 1 month as date)
      else cast(o_orderdate as date) + cast(o_orderkey % 5 - 1 as integer) end as last_day
  from orders),
days as (select k, first_day + cast(unnest(range(last_day - first_day + 1)) as integer) as day from ranges
  where last_day >= first_day)
select k, strftime(day, '%Y-%m-%d') as day, cast(1 as integer) as page,
  '{BASE}/cgi_tsv/list.pl?language=nl&page=1&pdd=' || strftime(day, '%Y-%m-%d') || '&pdf=' || strftime(day, '%Y-%m-%d') as url
from days
""")
oracle("frontier_next_page", ["fetched_counts"], f"""
select search_id, cast(page + 1 as integer) as page,
  '{BASE}/cgi_tsv/list.pl?language=nl&page=' || (page + 1) || '&pdd=' || day || '&pdf=' || day as url
from (select *, row_number() over (partition by search_id order by page desc) as r,
    strftime(date '2024-01-01' + cast(search_id as integer), '%Y-%m-%d') as day from fetched_counts)
where r = 1 and n_blocks = 100
""")
oracle("blocks_per_page", ["all_counts"], "select search_id, page, n_blocks from all_counts")
oracle("scan_pdf_manifest", ["raw_rows"], """
select 'file:///data/pdfs' || replace(rel, '/tsv_pdf', '') as path, strftime(d, '%Y-%m-%d') as day, 1000 + k % 9000 as n_bytes
from raw_rows where k % 37 <> 0 and k % 29 <> 0
""")
oracle("not_downloaded", ["typed"], f"""
select {_AT}, publication_link from typed where publication_link is not null and (k % 37 = 0 or k % 29 = 0)
""")
oracle("gather_pages", ["listing"], f"select {_AT}, search_pos, 'CO ' || k as company_name from listing")
oracle("lake_index", ["index_rows"], "select vat, publication_number from index_rows")

oracle("html_blocks", ["html_rows"], f"select {_AT}, block from html_rows")
oracle("html_links", ["listing"], f"""
select {_AT}, case n_pdf when 0 then '/x.html' when 1 then '/x.html ' || rel else '/x.html ' || rel || ' /dup.pdf' end as links
from listing
""")
oracle("page_links", [], """
select page_id, replace(array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' '), '&amp;', '&') as links from pages
""")
oracle("html_company_name", ["listing"], f"select {_AT}, 'CO ' || k as company_name from listing")
oracle("html_juridical_form", ["listing"], f"""
select {_AT}, case when k % 3 = 0 then 'BV' else 'NV' end as juridical_form from listing
""")
oracle("html_metadata", ["html_rows"], f"select {_AT}, array_to_string(meta, '|') as meta from html_rows")
oracle("metadata_unpack", ["unpacked"], """
select k, m_address as address, m_vat as vat, m_act as act_description, m_pub as date_number from unpacked
""")
oracle("no_results_filter", [], """
select page_id, url from pages where page_id % 2 = 1 or not (page_id % 7 < 3 or contains(html, 'Geen tekst komt overeen met uw zoekopdracht'))
""")

oracle("pdf_link_first", ["raw_rows"], f"select k, case when n_pdf > 0 then '{BASE}' || rel else '' end as url from raw_rows")
oracle("pdf_link_unique", ["raw_rows"], """
select k, case when n_pdf = 1 then rel end as pdf, n_pdf > 1 as multiple_pdf from raw_rows
""")
oracle("pdf_url_absolute", ["raw_rows"], f"select k, case when n_pdf = 1 then '{BASE}' || rel end as url from raw_rows")
oracle("pubid", ["raw_rows"], """
select k, case when n_pdf = 1 then regexp_extract(rel, '([^/]+)[.]pdf$', 1) end as pubid from raw_rows
""")
oracle("vat_clean", ["raw_rows"], "select k, nullif(replace(vat_raw, '.', ''), '') as vat from raw_rows")
oracle("vat_normalize", ["raw_rows"], """
select k, cast(try_cast(replace(vat_raw, '.', '') as bigint) as varchar) as vat,
  cast(try_cast(address as bigint) as varchar) as not_a_number
from raw_rows
""")
oracle("vat_effective", ["raw_rows"], """
select k, case when k % 3 = 0 then '123456789' else nullif(replace(vat_raw, '.', ''), '') end as vat from raw_rows
""")
oracle("address_split", ["raw_rows"], """
select k, nullif(regexp_extract(address, '^(.*) ([0-9]{4}) (.*)$', 1), '') as street,
  nullif(regexp_extract(address, '^(.*) ([0-9]{4}) (.*)$', 2), '') as zipcode,
  nullif(regexp_extract(address, '^(.*) ([0-9]{4}) (.*)$', 3), '') as city
from raw_rows
""")
oracle("pub_date_number", ["raw_rows"], """
select k, case when k % 19 = 0 then null when k % 17 = 0 then strftime(d, '%Y-01-01') else strftime(d, '%Y-%m-%d') end as publication_date,
  nullif(regexp_extract(pub_raw, ' / ([0-9]+)$', 1), '') as publication_number
from raw_rows
""")
oracle("pub_date_year_only", ["raw_rows"], """
select k, case when k % 19 <> 0 then strftime(d, '%Y-01-01') end as publication_date,
  case when k % 19 <> 0 then cast(k as varchar) end as publication_number
from raw_rows
""")
oracle("search_url", ["raw_rows"], f"""
with urls as (
  select *, case when k % 5 between 1 and 3 then '{BASE}/cgi_tsv/list.pl?language=nl&page=' || (k % 5)
    else '{BASE}/cgi_tsv/rech_res.pl?language=nl' end as script from raw_rows)
select k, script || '&btw=' || vat_raw as by_company,
  script || '&pdd=' || strftime(d, '%Y-%m-%d') || '&pdf=' || strftime(d + 1, '%Y-%m-%d') as by_day
from urls
""".replace("with urls as (", ", urls as (", 1))
oracle("missing_pdf_url", ["raw_rows"], f"""
, days as (select *, case when k % 19 = 0 then '' when k % 17 = 0 then strftime(d, '%Y-01-01')
  else strftime(d, '%Y-%m-%d') end as day from raw_rows)
select k, '{BASE}/cgi_tsv/rech_res.pl?btw=' || case when k % 2 = 0 then cast(ck as varchar) else 'None' end
  || '&pdd=' || day || '&pdf=' || day as url
from days
""")
oracle("pdf_store_path", ["raw_rows"], "select k, replace(rel, '/tsv_pdf', '') as path from raw_rows")
oracle("pdf_local_path", ["raw_rows"], "select k, '/data/pdfs' || replace(rel, '/tsv_pdf', '') as path from raw_rows")
oracle("publication_meta", ["typed"], f"select {_AT}, {_RECORD} from typed")
oracle("publication_json", ["typed"], f"""
select {_AT}, to_json(r) as json from (select {_AT}, struct_pack(
  vat := vat, pubid := pubid, act_description := act_description, company_name := company_name,
  company_juridical_form := company_juridical_form, address := address, street := street, zipcode := zipcode,
  city := city, publication_date := strftime(pdate, '%Y-%m-%d'), publication_number := publication_number,
  publication_link := publication_link) as r from typed)
""".replace("to_json(r) as json", "cast(to_json(r) as varchar) as json"))
oracle("lake_key", ["typed"], f"select {_AT}, {_KEY} as blob_key from typed")
oracle("lake_tags", ["typed"], f"""
select {_AT}, vat, strftime(pdate, '%Y-%m-%d') as publication_date, 'unprocessed' as status from typed
""")

oracle("date_cutoff", ["cut"], f"select {_AT}, company_name from cut where not below_cutoff")
oracle("cutoff_remaining", ["cut"], """
select search_id, count(*) - 1 as remaining from cut where below_cutoff group by search_id
""")
oracle("reject_no_pdf", ["typed"], f"""
select {_AT}, multiple_pdf, '{BASE}/cgi_tsv/rech_res.pl?btw=None&pdd=' || coalesce(strftime(pdate, '%Y-%m-%d'), '')
  || '&pdf=' || coalesce(strftime(pdate, '%Y-%m-%d'), '') as detail
from typed where rel1 is null
""")
oracle("skip_stored", ["typed", "index_rows"], f"""
select {_AT}, exists (select 1 from index_rows i where i.vat = t.vat and i.publication_number = t.publication_number) as stored
from typed t
""")
oracle("skip_stored_indexed", ["typed", "index_rows"], f"""
select {_AT}, exists (select 1 from index_rows i where i.vat = t.vat and i.publication_number = t.publication_number) as stored
from typed t
""")
oracle("incremental_anti", ["typed", "index_rows"], f"""
select {_AT}, vat, publication_number from typed t where not exists (
  select 1 from index_rows i where i.vat = t.vat and i.publication_number = t.publication_number)
""")
oracle("incremental_anti_prefix", ["typed", "index_rows"], f"""
, short as (select * replace (case when length(company_name) % 2 = 0 then substr(vat, 1, 6) else vat end as vat) from typed)
select {_AT}, vat, publication_number from short t where not exists (
  select 1 from index_rows i where i.publication_number = t.publication_number and starts_with(i.vat, t.vat))
""")
oracle("join_downloads", ["typed", "results"], f"""
select {_AT}, publication_link, ok as downloaded, path as file_path
from typed left join results on url = publication_link
""")
oracle("reject_download", ["typed", "results"], f"""
select {_AT}, 'robots' as obeying, 'download_failed' as ignoring
from typed join results on url = publication_link where rel1 is not null and not ok
""")
oracle("reject_no_date", ["decided"], f"""
select {_AT}, publication_link as detail from decided where reject_reason = 'no_date'
""")
oracle("reject_missing_key", ["decided"], f"""
select {_AT}, publication_link as detail from decided where reject_reason = 'missing_key'
""")
oracle("reject_scan", ["decided", "digital_texts"], f"""
select {_AT}, 'scan_without_ocr' as reject_reason, publication_link
from decided join digital_texts t on t.doc_no = k // 15 where reject_reason is null and t.text = ''
""")
oracle("reject_report", ["decided", "digital_texts"], """
select coalesce(reject_reason, case when t.text = '' then 'scan_without_ocr' else 'accepted' end) as reject_reason,
  count(*) as n_rows
from decided left join digital_texts t on t.doc_no = k // 15 group by 1
""")

_DOC = "cast(doc_id as varchar) as doc_id, cast(page_idx as integer) as page_idx"
oracle("page_zip", ["zipped", "ocr_lines"], f"""
select cast(z.doc_id as varchar) as doc_id, cast(z.page_idx as integer) as page_idx, ocr_width, ocr_height, width, height,
  count(*) as n_lines
from zipped z join ocr_lines l using (doc_id, page_idx) group by all
""")
oracle("polygon_bbox", ["ocr_lines"], f"""
select {_DOC}, cast(j as integer) as line_idx, x0, y0, x1, y0 + h as y1 from ocr_lines
""")
oracle("line_height_mode", ["page_heights"], f"select {_DOC}, line_height from page_heights")
oracle("crop_rect", ["bodies"], f"""select {_DOC}, "left", top, "right", bottom from bodies""")
oracle("scale_lines", ["placed"], f"select {_DOC}, content, x0, y0, x1, y1 from placed")
oracle("sort_lines", ["placed"], f"""
select {_DOC}, cast(row_number() over (partition by doc_id, page_idx order by raw_y0, raw_x0, j) - 1 as integer) as rank, content
from placed
""")
oracle("lines_in_crop", ["cropped"], f"select {_DOC}, content, x0, y0, x1, y1 from cropped")
oracle("prev_line", ["neighbours"], f"select {_DOC}, content, before, py0, py1 from neighbours")
oracle("same_line", ["marked"], f"select {_DOC}, content, same_line from marked")
oracle("text_assemble", [], """
select doc_id, string_agg(case when i % 2 = 1 then chr(9) when i = 0 then '' else chr(10) end || piece, '' order by i) as text
from (select doc_id, unnest(string_split(text, chr(10))) as piece, unnest(range(len(string_split(text, chr(10))))) as i
  from documents)
group by doc_id
""")
oracle("text_digital", ["digital_texts"], "select doc_id, text from digital_texts")
oracle("text_scan", ["scan_texts"], "select doc_id, text from scan_texts")
oracle("scan_files_by_prefix", ["raw_rows"], "select search_id, k || '|' || pub_raw as line from raw_rows")
oracle("text_scan_pages", ["scan_texts"], "select doc_id, text from scan_texts")
oracle("text_scan_plain", ["cropped"], """
select cast(d.doc_id as varchar) as doc_id, coalesce(t.text, '') as text
from documents d left join (
  select doc_id, string_agg(content, chr(10) order by page_idx, j) as text from cropped group by doc_id) t
  using (doc_id)
""")
oracle("extract_text", ["texts"], "select doc_id, text, is_digital from texts")
oracle("same_line_rects", ["all_marked"], f"""
select {_DOC}, content, least(x0, px0) as x0, least(y0, py0) as y0, greatest(x1, px1) as x1, greatest(y1, py1) as y1
from all_marked where same_line
""")
oracle("word_boxes", ["ocr_lines", "bodies"], """
, words as (
  select doc_id, j, x0, y0, h, unnest(string_split(content, ' ')) as content, unnest(range(len(string_split(content, ' ')))) as i
  from ocr_lines where page_idx = 0)
select cast(doc_id as varchar) as doc_id, cast(row_number() over (partition by doc_id order by j, i) - 1 as integer) as word_idx,
  content, (x0 + i * cast(0.125 as double)) * by_x as x0, y0 * by_y as y0,
  (x0 + i * cast(0.125 as double) + cast(0.0625 as double)) * by_x as x1, (y0 + h) * by_y as y1
from words join (select doc_id, by_x, by_y from bodies where page_idx = 0) using (doc_id)
""")

oracle("latest_by_key", ["records"], """
, writes as (select blob_key, text, cast(1 as bigint) as ingest_seq from records
  union all select blob_key, text || ', again', 2 from records where k % 4 = 0)
select blob_key, text, ingest_seq from (
  select *, row_number() over (partition by blob_key order by ingest_seq desc) as r from writes) where r = 1
""")
oracle("select_by_tag", ["records"], """
select blob_key, vat, publication_date, 'unprocessed' as status from records where cast(pubid as bigint) % 3 <> 0
""")
oracle("lake_counts", ["records"], "select count(distinct vat) as companies, count(distinct blob_key) as publications from records")
oracle("lake_counts_kept", ["records"], "select count(distinct vat) as companies, count(distinct blob_key) as publications from records")
oracle("compact_months", ["records"], """
, marked as (select *, substr(publication_date, 1, 7) as month, substr(publication_date, 6, 2) = '03' and cast(pubid as bigint) % 5 = 0 as again from records)
select blob_key, case when again then 'summarized' else 'unprocessed' end as status, text,
  cast(case when max(cast(again as integer)) over (partition by month) = 1 then 2 else 1 end as bigint) as ingest_seq
from marked
""")
oracle("new_companies", ["records", "index_rows"], """
select distinct vat from records where vat not in (select vat from index_rows)
""")
oracle("run_report", ["records", "index_rows"], """
, added as (select distinct vat from records where vat not in (select vat from index_rows)),
totals as (select 'run-1' as run_id, (select count(*) from added) as new_companies, (
  select count(distinct blob_key) from records where blob_key not in (select blob_key from index_rows)) as new_publications)
select run_id, new_companies, new_publications, vat as company from totals left join added on true
""")
oracle("publications", ["published"], "select * from published")
def _ingested(ingest_seq: str) -> str:
    """The lake after all runs; a search whose last page is full still waits for the next one."""
    return f"""
select {_KEY} as blob_key, pubid, company_juridical_form, zipcode, text, is_digital, cast({ingest_seq} as bigint) as ingest_seq,
  cast(year(pdate) as integer) as pub_year, cast(month(pdate) as integer) as pub_month
from cut join results on url = publication_link left join texts on texts.doc_no = k // 15
where not below_cutoff and ok and pdate is not null and vat is not null
  and search_id in (select search_id from all_counts group by search_id having arg_max(n_blocks, page) <> 100)
"""


oracle("unfinished_searches", ["fetched_counts"], """
select search_id, cast(max(page) as integer) as last_page, count(*) as n_pages from fetched_counts group by search_id
having arg_max(n_blocks, page) = 100 or count(*) <> max(page)
""")
_INGEST = ["cut", "results", "texts", "all_counts"]
oracle("stream_ingest", _INGEST, _ingested("0"))
oracle("ingest_late_text", _INGEST, _ingested("(k // 15) % 2"))
oracle("ingest_unfinished_search", _INGEST, _ingested("case when cast(search_id as integer) % 2 = 1 then 2 else 0 end"))

_PUBLISHED_JSON = """cast(to_json(struct_pack(
  vat := vat, pubid := pubid, act_description := act_description, company_name := company_name,
  company_juridical_form := company_juridical_form, address := address, street := street, zipcode := zipcode,
  city := city, publication_date := publication_date, publication_number := publication_number,
  publication_link := publication_link, text := text, is_digital := is_digital)) as varchar)"""
_QUESTION = f"'Summarize me the following publication: ' || {_PUBLISHED_JSON}"


def _prompt_oracles() -> None:
    from gazette_lake.fixed import SUMMARY_INSTRUCTIONS

    quoted = SUMMARY_INSTRUCTIONS.replace("'", "''")
    oracle("prompt_table", ["published"], f"""
select blob_key, 'system,user' as roles, '{quoted}' as instructions, {_QUESTION} as question from published
""")


_prompt_oracles()
oracle("complete_with", ["published"], f"""
select blob_key, '2 messages, ' || length({_QUESTION}) || ' characters' as summary from published
""")
oracle("summaries", ["published"], f"""
select blob_key, company_name, '2 messages, ' || length({_QUESTION}) || ' characters' as summary from published
""")
oracle("summarize", ["published"], f"""
select blob_key, 'summarized' as status, '2 messages, ' || length({_QUESTION}) || ' characters' as summary from published
""")
