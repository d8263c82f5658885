"""Tables of the data model."""

from __future__ import annotations

FORMATS = ("pdf", "html", "md", "json", "csv", "xlsx", "image", "pbf", "txt")
TOPICS = (1, 2, 3)

SECTION = "titulo string, texto string, orden int, splittable boolean"
DOCUMENT = f"doc_id string, fuente string, formato string, fenomeno int, secciones array<struct<{SECTION.replace(' ', ':').replace(',:', ',')}>>, idioma string, titulo string, fecha string, metadata map<string,string>"
MANDATORY = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")
CHUNK = "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string, idioma string, titulo_documento string, fecha_publicacion string, chunking_strategy string, seccion string, overlap_con string, hash_texto string, created_at timestamp, validation_warnings array<string>"
EMBEDDING = "chunk_id string, doc_id string, fenomeno int, formato string, encoder_name string, model_id string, embedding_dim int, vector array<float>, vector_dtype string, normalized boolean, hash_texto string, created_at timestamp, updated_at timestamp"
HIT = "query_id string, channel string, chunk_id string, doc_id string, rank int, score double"
ENTITY = "id string, nombre string, tipo string, variantes array<string>"
TRIPLE = "sujeto string, relacion string, objeto string, doc_id string, chunk_id string, evidencia string, confianza double"
QUERY = "query_id string, query_text string"
ENTITY_TYPES = ("ORGANIZACION", "PAIS", "REGION", "PROGRAMA", "TECNOLOGIA", "TRATADO", "PERSONA", "CONFLICTO", "EVENTO", "SECTOR", "OTRO")
