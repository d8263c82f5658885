"""Settings of ingestion, chunking, encoding and indexing; invalid ones raise ValueError."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkingConfig:
    """Token budgets of chunks."""

    chunk_size: int = 400
    overlap: int = 80
    min_tokens: int = 50
    max_tokens: int = 512
    strategy: str = "paragraph_overlap"

    def __post_init__(self):
        if min(self.chunk_size, self.max_tokens) <= 0 or min(self.overlap, self.min_tokens) < 0:
            raise ValueError("token budgets must be positive")
        if self.overlap >= self.chunk_size:
            raise ValueError("overlap must be smaller than chunk_size")
        if self.chunk_size > self.max_tokens:
            raise ValueError("chunk_size must not exceed max_tokens")


@dataclass(frozen=True)
class IndexConfig:
    """kind: flat_ip, ivf_flat, hnsw or auto; auto takes ivf_flat above the threshold."""

    kind: str = "auto"
    auto_threshold: int = 50_000
    nlist: int = 100
    nprobe: int = 10
    hnsw_m: int = 32

    def chosen(self, n_vectors: int) -> str:
        if self.kind != "auto":
            return self.kind
        return "ivf_flat" if n_vectors > self.auto_threshold else "flat_ip"


def batch_sizes(text: str) -> dict[str, int]:
    """`encoder=8,other=16` as a dict; entries without a positive number raise ValueError."""
    out: dict[str, int] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, eq, number = part.partition("=")
        if not eq or not number.strip().isdigit() or int(number) == 0:
            raise ValueError(f"not name=number: {part!r}")
        out[name.strip()] = int(number)
    return out
