"""Explicit schemas of the engine's tables, as Spark DDL. Order is always an explicit column."""

RESOURCES = "pos bigint, uri string, source string, media_type string, metadata map<string,string>"
ARTIFACTS = "uri string, source string, filename string, media_type string, content binary"
BLOCKS = "uri string, pos int, text string, kind string, page int, section string"
UNITS = "document string, page int, section string, chunk_index int, text string"
ELEMENTS = "doc_id string, idx int, text string, element_type string, attributes map<string,string>, section string, page int, row_type string"
CHUNK = "chunk_index int, text string, token_count int, document string, section string, section_path array<string>, section_level int, page int, start_page int, end_page int, block_types array<string>, oversized boolean, table_split boolean"
PART = "chunk_index int, text string, token_count int, chunk_type string, section string, page int"
MANIFEST = "schema_version int, provider string, count int, resources array<struct<uri:string,source:string,media_type:string,metadata:map<string,string>>>"
