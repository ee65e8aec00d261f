"""Schemas of the engine's tables."""

RECORDS = """slug string, ordinal bigint, bibcode string, title string, authors array<string>, year string, pubdate string,
 abstract string, arxiv_id string, doi string, doctype string, bibstem string, citation_count bigint, keyword array<string>,
 topics array<string>, relevant boolean, why_excluded string, via string"""
EDGES = "src string, dst string"
DECISIONS = "slug string, bibcode string, decision string, reason string, decided_on date"
SEARCH_LOG = """slug string, run_date date, query string, rows_limit bigint, n_found bigint, n_total bigint, n_core bigint,
 n_candidates bigint, n_dropped bigint, truncated boolean,
 lens struct<topics:map<string,string>,require:array<string>,min_topics:int,noise_doctypes:array<string>>"""
LINKS = "stem string, pos int, target string"
DOCUMENTS = "slug string, stem string, text string"
HOSTS = "slug string, spectral_type string, teff_K double, mass_msun double, st_rotp_days double, dist_pc double, Vmag double, ra_deg double, dec_deg double"
PLANETS = """slug string, letter string, P_days double, K_ms double, e double, msini double, bmass double, bmass_prov string,
 mass double, mass_source string, msini_check double, mass_flag string, method string, disc_year int, disc_refname string, status string"""
UPDATES = "doi string, pos int, type string, notice_doi string, date_parts array<int>, source string"
CLAIM_PAIRS = "id string, label string, note string, line int, claim string, bibcode string, doc_path string, verdict string"
FINDINGS = "category string, severity string, key string, detail string"
#: The typed head of a note; what it doesn't name stays in the raw text.
FRONTMATTER = """struct<tags:array<string>,title:string,year:string,doi:string,methods:array<string>,thesis_links:array<string>,
 bearing:string,relevance:string,stars:array<string>,citations:bigint,area:string,status:string,fulltext:string,pdf:string,
 retracted:boolean,retraction:struct<type:string,date:string,notice_doi:string>,
 corrections:array<struct<type:string,date:string,notice_doi:string>>,pending_source:string,source_url:string,accessed:string,
 P_rot_days:double,activity_indicators_expected:array<string>,
 planets:array<struct<letter:string,K_ms:double,P_days:double,e:double,mass_earth:double,mass_flag:string,disputes:array<struct<ref:string>>>>>"""
NOTES = f"path string, dir string, stem string, text string, fm_status string, fm {FRONTMATTER}, body string, tags array<string>"
