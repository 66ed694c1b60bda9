"""Settings and fixed thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

# Sizes in tokens.
ABSOLUTE_MIN_CHUNK = 80
SOFT_MAX_CHUNK = 700
HARD_MAX_CHUNK = 900
MERGE_MAX_CHUNK = 800
CROSS_SECTION_ALLOWANCE = 100
SENTENCE_SPLIT_ABOVE = 1500
APPROACH_SHARE = 0.9
CODE_SHARE = 0.8
EXPLANATION_CHARS = 20

EMBED_MIN = 50
EMBED_MAX = 1600
OVERSIZED = 1200
NEAR_MIN = 70
FORCE_PREFIXES = ("api-reference/payments/umap",)

SPEC_FILE_LIMIT = 6000
SPEC_FILE_HARD_LIMIT = 6600
MIN_CHUNKS_PRODUCTION = 4000
MIN_CHUNKS_SMOKE = 200
VECTOR_SIZE = 1024
STAGE_SIZE = 100
FAILURE_SHARE = 0.02
BREAKER = 3


@dataclass(frozen=True)
class ChunkingConfig:
    target_chunk_size: int = 700
    min_chunk_size: int = 500
    max_chunk_size: int = 700
    overlap_size: int = 80
    min_overlap_size: int = 60
    max_overlap_size: int = 100

    def __post_init__(self) -> None:
        rules = (
            (self.min_chunk_size > 0, "min_chunk_size must be positive"),
            (self.max_chunk_size > self.min_chunk_size, "max_chunk_size must be above min_chunk_size"),
            (self.min_chunk_size <= self.target_chunk_size <= self.max_chunk_size, "target_chunk_size must lie between them"),
            (self.min_overlap_size >= 0, "min_overlap_size must not be negative"),
            (self.max_overlap_size >= self.min_overlap_size, "max_overlap_size must not be below min_overlap_size"),
            (self.max_overlap_size < self.min_chunk_size, "overlap must be smaller than a chunk"),
        )
        for holds, message in rules:
            if not holds:
                raise ValueError(message)


@dataclass(frozen=True)
class ScanConfig:
    root: str
    extensions: tuple[str, ...] = (".md", ".mdx")
    # Directories and files that are never read.
    exclude_dirs: tuple[str, ...] = (".git", "node_modules", "dist", "build", ".next", "coverage", ".cache")
    exclude_files: tuple[str, ...] = (r"\.DS_Store$", r"Thumbs\.db$", r"\.gitkeep$", r"^\.")

    def __post_init__(self) -> None:
        if not self.root:
            raise ValueError("root is required")
        if not self.extensions or any(not e.startswith(".") for e in self.extensions):
            raise ValueError("extensions must begin with a dot")


@dataclass(frozen=True)
class PipelineConfig:
    scan: ScanConfig
    chunking: ChunkingConfig = field(default_factory=ChunkingConfig)
    base_url: str = "https://docs.example.com"
    output: str | None = None
    previous: str | None = None
