"""Schemas of the data model as DDL, which every reader takes; readers never infer them."""

RELATIONSHIP = "type string, source string, target string, context string, position string"
DOCUMENT = "doc_id bigint, source string, type string, format string, content string, metadata struct<has_images:boolean,original_images:array<string>,relationships:array<struct<type:string,source:string,target:string,context:string,position:string>>>, loaded_at timestamp"
CHUNK = "doc_id bigint, chunk_ix int, content string, score double"
TRIPLET = "question string, answer string, instruction string, context string, validation_scores map<string,double>, validation_issues array<string>, source string"
ANNOTATION = "ocr_text string, caption string, context struct<objects:array<struct<label:string,confidence:double,box:array<double>>>,scene_description:string,visual_qa:array<struct<question:string,answer:string,confidence:double>>>"
CANDIDATE = "text string, type string, subtype string, score double, source string, context string, reasoning string, question string, seq int"
STATE = "path string, success boolean, ts timestamp, error string"
USAGE = "model string, task string, ts timestamp, duration double, input_tokens bigint, output_tokens bigint, success boolean, error string"
VERDICT = "valid boolean, scores map<string,double>, issues array<string>, improvements array<string>"
