"""Typed schemas of the engine's tables, as Spark DDL."""

AUTHOR = "struct<name:string,affiliation:string>"
JOURNAL = "struct<raw_ref:string,raw_title:string,volume:string,first_page:int,last_page:int,number:string,issn:string,short_title:string,full_title:string,year:int>"

#: A cited work, keyed by the citing publication and the position in its bibliography.
REFERENCE = f"""
    pub_id string, pos int, raw string, arxiv_id string, doi string, authors array<{AUTHOR}>, title string, journal string,
    issue string, first_page int, last_page int, volume string, year int, issn string, pmid string, ssid string,
    urls array<string>, is_reference boolean, validated boolean"""

#: A harvested publication; its bibliography is a child table of references.
PUBLICATION = f"""
    identifier string, datestamp string, id string, abstract string, created string, updated string, title string,
    authors array<{AUTHOR}>, categories array<string>, journal string, comments string, report_no string,
    msc_class string, acm_class string, doi string, license string, pdf_url string"""

#: A known publication that citations are resolved against.
CATALOGUE = """
    id bigint, authors array<struct<name:string>>, pmid string, doi string, ssid string, journal string, pages string,
    volume string, title string, year int, first_page int, last_page int, issue string, pdf_urls array<string>"""

#: A positioned text line; indent -1 marks the start of a page and -2 its end.
LINE = "doc_id string, line_no int, indent int, last_pos int, str string, page_no int"

#: One XML record of an OAI-PMH page.
OAI_RECORD = """
    header struct<identifier:string,datestamp:string,setSpec:array<string>>,
    metadata struct<arXiv:struct<id:string,created:string,updated:string,title:string,categories:string,comments:string,
        `report-no`:string,`journal-ref`:string,`msc-class`:string,`acm-class`:string,doi:string,license:string,
        abstract:string,authors:struct<author:array<struct<keyname:string,forenames:string,suffix:string,affiliation:string>>>>>"""

#: One XML entry of an Atom feed.
ATOM_ENTRY = """
    id string, updated string, published string, title string, summary string,
    author array<struct<name:string,`arxiv:affiliation`:string>>, `arxiv:doi` string, `arxiv:journal_ref` string,
    link array<struct<_title:string,_href:string,_rel:string,_type:string>>,
    category array<struct<_term:string,_scheme:string>>"""

#: One line of a bibliographic dump, and one page of hits of a search API.
DUMP_RECORD = """
    DOI string, author array<struct<family:string,given:string,sequence:string>>, `container-title` array<string>,
    issue string, issued struct<`date-parts`:array<array<int>>>, link array<struct<URL:string>>, page string,
    `short-container-title` array<string>, title array<string>, volume string"""
SEARCH_ITEM = """struct<DOI:string,title:array<string>,author:array<struct<family:string,given:string>>,
    `container-title`:array<string>,`short-container-title`:array<string>,volume:string,page:string,issue:string,
    ISSN:array<string>,issued:struct<`date-parts`:array<array<int>>>,link:array<struct<URL:string>>,score:double>"""
SEARCH_PAGE = f"message struct<items:array<{SEARCH_ITEM}>>"

MANIFEST_FILE = "filename string, md5sum string"
EXTRACTION_RUN = "file string, extractor string, n_references int, n_validated int, time_ms int"
