"""Fixed values.  They decide results, so they are stated here once, as they are."""

from datetime import date

# Site the listings come from, and the two search scripts.
BASE_URL = "https://www.ejustice.just.fgov.be"
PAGED_SEARCH = "/cgi_tsv/list.pl?language=nl&page="
FIRST_SEARCH = "/cgi_tsv/rech_res.pl?language=nl"
MISSING_PDF_SEARCH = "/cgi_tsv/rech_res.pl?btw="
PDF_FOLDER = "/tsv_pdf"

# Listing rules.
NO_RESULTS_TEXT = "Geen tekst komt overeen met uw zoekopdracht"
FULL_PAGE = 100
DEFAULT_THRESHOLD = date(2010, 1, 1)
PDF_SUFFIX = ".pdf"
UNPROCESSED = "unprocessed"

# White space and digits as the source data's producer understands them: Unicode white
# space plus the separators U+001C to U+001F, and decimal digits of every script.  Named
# one by one, they match several times faster than with the Unicode flag of the patterns.
SPACES = "".join(filter(str.isspace, map(chr, range(0x3001))))
SPACE = "[" + "".join(f"\\u{ord(space):04x}" for space in SPACES) + "]"
DIGIT = r"\p{Nd}"

# Field formats.  (?d) makes only \n end a line.  There is no year 0.
ADDRESS_FORMAT = rf"(?d)^(.*){SPACE}({DIGIT}{{4}}){SPACE}(.*)$"
FULL_DATE_FORMAT = rf"(?d)^((?!0000){DIGIT}{{4}}-{DIGIT}{{2}}-{DIGIT}{{2}}){SPACE}/{SPACE}{DIGIT}*-?{DIGIT}+$"
YEAR_FORMAT = rf"(?d)^({DIGIT}{{4}})({SPACE}/{SPACE}{DIGIT}*-?{DIGIT}+)$"
NUMBER_FORMAT = rf"(?d)^{DIGIT}{{4}}(?:-{DIGIT}{{2}}-{DIGIT}{{2}})?{SPACE}/{SPACE}({DIGIT}*-?{DIGIT}+)$"

# Body of a printed page, as fractions (left, top, right, bottom) of its size.
FIRST_PAGE_BODY = (0.15966, 0.20485, 0.95, 0.9195)
LATER_PAGE_BODY = (0.15966, 0.04899, 0.95, 0.9195)
NARROW_RIGHT_EDGE = 0.93277

# Two lines share a height when top and bottom move at most 5 % and both fit in
# 1.25 usual line heights.
HEIGHT_DRIFT = 0.05
HEIGHT_SLACK = 1.25

# Instructions and question of the summary prompt.
SUMMARY_INSTRUCTIONS = """
You are a helpful assistant that helps summarize documents.
Start with a short intro which must include:
- company name
- vat number
- juridical form
- address
- publication date, publication number, publication link

Then follow follow with a section where you summarize the publication text. Pay attention to the following topics:
- changes in capital (increase/decrease in shares or change of owner of shares)
- appointment and resignation of legal representatives (persons and organizations that can represent the legal entity towards third parties)
- definition of signing rules (how many legal representatives are required to represent the legal entity towards third parties)
- terminations, mergers & acquisitions and restructurings
- change in general assembly date


Start with listing the topics which are mentioned within the publications (do not include those not mentioned) plus any topics you deem important.
Conclude with listing the topics which were not mentioned within the publications.

Answer in English and use Markdown formatting.
"""
SUMMARY_QUESTION = "Summarize me the following publication: "
