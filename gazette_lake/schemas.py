"""Read schemas.  Codes with leading zeros are strings; Spark never infers them."""

PUBLICATION_FIELDS = [
    "vat",
    "pubid",
    "act_description",
    "company_name",
    "company_juridical_form",
    "address",
    "street",
    "zipcode",
    "city",
    "publication_date",
    "publication_number",
    "publication_link",
]

RECORD = ", ".join(f"{name} string" for name in PUBLICATION_FIELDS)
PUBLICATION = f"{RECORD}, text string, is_digital boolean"

SEEDS = "search_id string, vat string, start_date date, end_date date"
PAGES = "search_id string, page int, search_vat string, start_date date, url string, html string"
BLOCKS = "search_id string, page int, pos int, block string"
TYPED = (
    "search_id string, search_vat string, start_date date, page int, pos int, rel string, multiple_pdf boolean, vat string, "
    "pubid string, act_description string, company_name string, company_juridical_form string, address string, street string, "
    "zipcode string, city string, publication_date date, publication_number string, publication_link string"
)
PENDING = f"{TYPED}, tries int"
CUT_PAGES = "search_id string, page int, search_vat string, start_date date, url string, blocks array<string>, n_blocks bigint"
HELD = f"{CUT_PAGES}, held_since bigint"
FETCH_RESULTS = "url string, ok boolean, path string"

_PIECE = "struct<content:string, polygon:array<struct<x:double, y:double>>>"
OCR_PIECES = f"array<{_PIECE}>"
OCR_PAGES = f"array<struct<width:double, height:double, lines:{OCR_PIECES}, words:{OCR_PIECES}>>"
GEOMETRY = "array<struct<width:double, height:double>>"
OCR = f"doc_id string, pages {OCR_PAGES}"
DIGITAL_LAYOUT = f"doc_id string, pages {OCR_PAGES}, geometry {GEOMETRY}"
PAGE_GEOMETRY = f"doc_id string, geometry {GEOMETRY}"
DIGITAL_PAGES = "doc_id string, page_texts array<string>"

LAKE = (
    f"blob_key string, {PUBLICATION}, status string, "
    "ingest_seq bigint, pub_year int, pub_month int"
)
REJECTS = "search_id string, page int, pos int, detail string, ingest_seq bigint, reject_reason string"
REPORTS = "run_id string, new_companies bigint, new_publications bigint, company string, ingest_seq bigint"
PDF_MANIFEST = "path string, modified timestamp, n_bytes bigint"
PROMPTS = "blob_key string, messages array<struct<role:string, content:string>>"
ANSWERS = "blob_key string, summary string, error string"
COMPLETIONS = "blob_key string, summary string"
DOCUMENTS = f"publication_link string, doc_id string, pages {OCR_PAGES}, geometry {GEOMETRY}, page_texts array<string>"
