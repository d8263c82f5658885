"""Chunking strategies: documents with sections in, chunks out.  A document is handled whole by one call, so chunking
needs no shuffle: documents stay in their partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.config import ChunkingConfig
from fathomline.functions import segment, text
from fathomline.registry import Registry
from fathomline.session import small_batches

Piece = tuple[str, str | None, int]  # text, section title, number of its window within the document
Strategy = Callable[[list[segment.Section], ChunkingConfig], Iterator[Piece]]
#: Documents that are Python objects at a time; their chunks go on before the next ones are read.
SLICE = 64
STRATEGIES: Registry[Strategy] = Registry("chunking strategy")


def _windows(units: list[str], joint: str, title: str | None, c: ChunkingConfig, first: int, tail: bool = False) -> Iterator[Piece]:
    costs = [len(u.split()) for u in units]
    found = segment.windows(costs, c.chunk_size, c.overlap)
    if tail:
        found = segment.tail_absorbed(found, costs, c.min_tokens, c.max_tokens)
    for w, (a, b) in enumerate(found):
        for piece in segment.split_words(joint.join(units[a : b + 1]), c.max_tokens):
            yield piece, title, first + w


def _alone(s: segment.Section, c: ChunkingConfig, n: int) -> Iterator[Piece]:
    for piece in segment.split_words(s[1], c.max_tokens):
        yield piece, s[0], n


def _blocks(t: str) -> list[str]:
    import re

    return [p for p in (x.strip() for x in re.split(r"\n\s*\n", t.replace("\r\n", "\n").replace("\r", "\n"))) if p]


@STRATEGIES.register("structural")
def structural(sections: list[segment.Section], c: ChunkingConfig) -> Iterator[Piece]:
    """A chunk a section."""
    for n, s in enumerate(sections):
        yield from _alone(s, c, n << 20)


@STRATEGIES.register("paragraph")
def paragraph(sections: list[segment.Section], c: ChunkingConfig) -> Iterator[Piece]:
    """A chunk a paragraph; atomic sections whole."""
    for n, s in enumerate(sections):
        for i, p in enumerate(_blocks(s[1]) if s[3] else [s[1]]):
            yield from _alone((s[0], p, s[2], s[3]), c, (n << 20) + i)


@STRATEGIES.register("semantic")
def semantic(sections: list[segment.Section], c: ChunkingConfig) -> Iterator[Piece]:
    """Overlapping windows over the sentences of the whole document."""
    yield from _windows(segment.sentences("\n\n".join(s[1] for s in sections)), " ", None, c, 0)


@STRATEGIES.register("paragraph_overlap")
def paragraph_overlap(sections: list[segment.Section], c: ChunkingConfig) -> Iterator[Piece]:
    """Sections that fit stay whole; others become overlapping windows over their paragraphs."""
    for n, s in enumerate(sections):
        if not s[3] or len(s[1].split()) <= c.chunk_size:
            yield from _alone(s, c, n << 20)
        else:
            yield from _windows(_blocks(s[1]), "\n\n", s[0], c, n << 20)


@STRATEGIES.register("hybrid")
def hybrid(sections: list[segment.Section], c: ChunkingConfig) -> Iterator[Piece]:
    """Small sections are merged; what still exceeds a chunk becomes windows over sentences, short tails absorbed."""
    for n, s in enumerate(segment.merge_small(sections, c.min_tokens, c.max_tokens)):
        if not s[3] or len(s[1].split()) <= c.chunk_size:
            yield from _alone(s, c, n << 20)
        else:
            yield from _windows(segment.sentences(s[1]), " ", s[0], c, n << 20, tail=True)


def chunk(documents: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """(doc_id, chunk_id, posicion, num_tokens, texto, seccion, overlap_con, chunking_strategy) of documents with
    doc_id and secciones.  Sections go by orden, blank ones are skipped; positions count within the document; in a
    strategy with windows, overlap_con names the last chunk of the window before, within the section."""
    strategy = STRATEGIES.get(config.strategy)
    overlapping = config.strategy.strip().lower() in ("semantic", "paragraph_overlap", "hybrid")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, max(b.num_rows, 1), SLICE)):
            rows = []
            for doc_id, sections in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ready = sorted(((s["titulo"], s["texto"], s["orden"], bool(s["splittable"])) for s in sections or () if (s["texto"] or "").strip()), key=lambda s: s[2])
                last = (-1, "")
                before = None
                for position, (piece, title, window) in enumerate(strategy(ready, config)):
                    own = f"{doc_id}__chunk_{position:05d}"
                    if window != last[0]:
                        before = last[1] if overlapping and window == last[0] + 1 and last[0] >= 0 else None
                    rows.append((doc_id, own, position, len(piece.split()), piece, title, before))
                    last = (window, own)
            columns = [*zip(*rows)] or [()] * 7
            kinds = (batch.schema[0].type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["doc_id", "chunk_id", "posicion", "num_tokens", "texto", "seccion", "overlap_con"])

    df = small_batches(documents.select("doc_id", "secciones"))
    out = df.mapInArrow(cut, f"doc_id {df.schema[0].dataType.simpleString()}, chunk_id string, posicion int, num_tokens int, texto string, seccion string, overlap_con string")
    return out.withColumn("chunking_strategy", F.lit(config.strategy))


def chunk_sections(sections: DataFrame, max_tokens: int = 512) -> DataFrame:
    """`structural` in expressions only, for sections as rows (doc_id, orden, texto): no Python on the way."""
    pieces = sections.filter(F.length(F.trim("texto")) > 0).select("doc_id", "orden", F.posexplode(text.hard_split(F.col("texto"), max_tokens)).alias("piece", "texto"))
    from pyspark.sql.window import Window

    numbered = pieces.withColumn("posicion", (F.row_number().over(Window.partitionBy("doc_id").orderBy("orden", "piece")) - 1).cast("int"))
    return numbered.select("doc_id", text.chunk_id(F.col("doc_id"), F.col("posicion")).alias("chunk_id"), "posicion", text.word_count(F.col("texto")).alias("num_tokens"), "texto")


def enrich(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Document columns, text hash, creation time (kept where present) and ids made anew from positions."""
    columns = [c for c in ("fuente", "formato", "fenomeno", "idioma") if c in documents.columns]
    out = chunks.drop(*columns).join(documents.select("doc_id", *columns), "doc_id")
    now = F.coalesce("created_at", F.current_timestamp()) if "created_at" in chunks.columns else F.current_timestamp()
    return out.withColumns({"hash_texto": text.text_hash(F.col("texto")), "created_at": now, "chunk_id": text.chunk_id(F.col("doc_id"), F.col("posicion"))})
