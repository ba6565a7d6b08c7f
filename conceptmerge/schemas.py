"""Record layouts.  Every record kind has a fixed schema; nothing is inferred at run time."""

from __future__ import annotations

CONTENT = "struct<src:string,content:string>"
METADATA = (
    "struct<gsd_id:string,gtc_id:array<string>,exact_synonyms:array<string>,classification:string,definition:string,"
    "description:string,evidence:array<string>,publication:array<string>,db_xref:array<string>,iupac_condensed:string,"
    f"function:array<{CONTENT}>,disease_association:array<{CONTENT}>,raw_term:string>"
)
TERM = f"term string, xref string, term_uuid string, src_uuid string, metadata {METADATA}"
EDGE = "subj string, pred string, obj string, xref string, comment string"
MASTER_EDGE = "subj string, pred string, obj string, comment string"
NODE = "lbl string, term_uuid string, gtc_id array<string>, gsd_id string, sources array<struct<src_lbl:string,src:string,src_uuid:string>>"
DECISION = "source_term string, mapped_to_uuid string, action string"
CHUNK = "content string, metadata struct<chapter:string,id:string>"
MENTION = "term string, start_pos long, end_pos long, similarity double, term_in_sentence string, metadata struct<chapter:string,uuid:string,source_line:long>"
VECTOR_DOC = "id string, page_content string, term string, embedding array<float>"

MANDATORY_TERM_KEYS = ("term", "xref", "term_uuid", "src_uuid")
MANDATORY_EDGE_KEYS = ("subj", "pred", "obj", "xref", "comment")
DISCARD, ERROR, PLACEHOLDER = "[DISCARD]", "[ERROR]", "[PLACEHOLDER]"
CONCEPT_PREFIX, SOURCE_PREFIX = "GSD:", "SRC:"
RELATED = "has_related_synonym"
