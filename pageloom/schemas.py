"""Vocabularies and schemas of annotated books."""

#: The vocabularies of the data format.
PAGE_TYPES = [
    "frontJacket", "cover", "frontCover", "backCover", "frontEndSheet", "backEndSheet", "frontEndPaper", "backEndPaper", "titlePage", "preface", "introduction", "normalPage", "blank", "illustration", "map", "table", "advertisement", "impressum", "colophon",
    "frontispiece", "imprimatur", "dedication", "errata", "sheetMusic", "appendix", "bibliography", "afterword", "conclusion", "tableOfContents", "index", "listOfIllustrations", "listOfMaps", "listOfTables", "edge", "spine", "jacket", "flyleaf",
]
BIBLIO_FIELDS = ["title", "subtitle", "part_name", "part_number", "series_name", "series_number", "edition", "publisher", "publication_place", "publication_date", "manufacture_publisher", "manufacture_place", "author", "editor", "translator", "illustrator", "photographer"]
SCAN_SIDES = ["left", "right", "both"]
LEAVES = ["book_block", "plate", "binding", "loose"]
NUMERAL_SYSTEMS = ["arabic", "roman", "other"]
NUMBER_POSITIONS = ["top_left", "top_center", "top_right", "bottom_left", "bottom_center", "bottom_right", "other"]
ORIGINS = ["observed", "inferred", "catalogued"]
STAGES = ["observe", "reconcile", "escalate", "revisit"]
GOLD_STATUSES = ["verified", "absent", "not_applicable", "ambiguous", "not_reviewed"]
SCHEMA_VERSION = "0.3"

NUMBER = "struct<side:string,raw:string,normalized:string,numeric_value:int,numeral_system:string,position:string,confidence:double,notes:string>"
SUBPAGE = "struct<side:string,page_type:string,confidence:double,leaf:string>"
HEADING = "struct<text:string,level:int,side:string,confidence:double>"
TOC_ENTRY = "struct<title:string,printed_page_reference:string,level:int,confidence:double>"
CANDIDATE = "struct<field:string,value:string,confidence:double,notes:string>"
OBSERVATION = (
    "struct<page_type:string,page_type_confidence:double,page_type_reason:string,side:string,side_confidence:double,side_reason:string,leaf:string,leaf_reason:string,"
    f"subpages:array<{SUBPAGE}>,printed_numbers:array<{NUMBER}>,headings:array<{HEADING}>,toc_entries:array<{TOC_ENTRY}>,bibliographic_candidates:array<{CANDIDATE}>,notes:string>"
)
OCR = "struct<status:string,filename:string,format:string,sha256:string,size_bytes:bigint,chars:int,sent_chars:int,truncated:boolean,error:string>"
SCAN = f"struct<scan_id:string,scan_index:int,filename:string,image_sha256:string,width:int,height:int,ocr:{OCR},observation:{OBSERVATION},observation_call_id:string>"
CALL = "struct<call_id:string,stage:string,scan_id:string,provider:string,model:string,attempt:int,status:string,started_at:timestamp,latency_s:double,prompt_tokens:bigint,completion_tokens:bigint,cost_usd:double,response_id:string,served_model:string,upstream_provider:string,error:string>"
BOOK = f"struct<schema_version:string,book_id:string,source:struct<input_directory:string,order_file:string,ocr_directory:string,scan_count:int>,scans:array<{SCAN}>,run:struct<calls:array<{CALL}>,warnings:array<string>>>"
