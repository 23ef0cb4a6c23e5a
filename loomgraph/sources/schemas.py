"""Record schemas.  Readers use them as they are; nothing is inferred."""

from __future__ import annotations

CHUNK = "id string, doc string, seq int, heading_path array<string>, text string, n_words int, token_est int, entities array<string>"
EMBEDDING = "id string, vector array<double>"
ENTITY = "iri string, types array<string>, label string, aliases array<string>, summary string, tags array<string>, attestedIn array<string>, definedIn array<string>"
TRIPLE = "s string, p string, o string, o_is_iri boolean, lang string, dtype string"
PACK = "struct<title:string,path:string,requires:array<string>>"
SOURCE = "struct<title:string,path:string,corpus_repo:string,status:string,license:string,sha256:string,bytes:bigint,chunks:int>"
MENTION = "name string, type string, aliases array<string>, description string, evidence array<string>"
BATCH = "id string, heading_path array<string>, text string"
CONFIG = "provider string, model string, dim int, metric string, normalized boolean, input string, built_at timestamp, note string"

#: Required fields of each record, and the metrics a configuration may name.
REQUIRED = {"chunk": ["id", "doc", "text"], "embedding": ["id", "vector"], "entity": ["iri", "types", "label"]}
METRICS = ["cosine", "dot", "euclidean"]
