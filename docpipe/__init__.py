"""A PySpark-native engine for document ingestion and vector-index synchronisation.

What a caller needs is exported here; it is loaded when it is first used, so
importing the package needs no Spark session.
"""

from importlib import import_module

_PLACES = {
    "config": ("ChunkingConfig", "PipelineConfig", "ScanConfig"),
    "functions.text": ("chunk_id", "clean_content", "content_hash", "page_context", "public_url", "rag_metadata", "token_count"),
    "functions.tokens": ("BpeCounter", "RegexCounter", "count_udf"),
    "operators.apispec": ("endpoint_table", "spec_files"),
    "operators.chunking": ("chunk_documents", "chunk_pages", "chunk_sections"),
    "operators.filters": ("drop_bad_files", "embed_label", "embed_stats", "should_embed", "valid_for_embedding"),
    "operators.incremental": ("carry_over", "classify", "compare_runs", "files_to_process", "merge_chunks", "validate_unchanged"),
    "operators.sections": ("sections", "sections_tree", "split_front_matter"),
    "operators.sync": ("embed", "sync", "sync_plan", "upload", "upload_plan"),
    "plans.pipeline": ("ingest", "ingest_specs", "load_previous", "run", "run_stats"),
    "sources.files": ("read_navigation", "read_outputs", "read_pages", "read_redirects", "read_specs"),
    "sources.stores": ("HashEmbedder", "ParquetContentStore", "ParquetVectorStore", "PatientEmbedder"),
    "streaming.incremental": ("change_stream", "ingest_folder", "latest_chunks"),
}
_HOME = {name: place for place, names in _PLACES.items() for name in names}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f".{_HOME[name]}", __name__), name)
