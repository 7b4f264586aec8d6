"""Text indexing and ranked retrieval with Spark DataFrames."""

from inkdex.operators.bounds import posting_bounds
from inkdex.operators.index import (
    document_frequencies,
    document_lengths,
    flatten_blocks,
    normalize_tf,
    posting_blocks,
    term_frequencies,
    tfidf_index,
    vocabulary,
    vocabulary_size,
)
from inkdex.operators.matches import match_counts, match_navigation, match_offsets, match_offsets_batch, nest_offsets
from inkdex.operators.positions import phrase_counts, phrase_starts, term_positions
from inkdex.operators.postings import Index
from inkdex.operators.search import phrase_search, phrase_search_batch, search, search_batch
from inkdex.operators.titles import (
    as_displayed,
    extract_titles,
    found_titles,
    heads,
    lookup_titles,
    remember_titles,
    resolve_titles,
)
from inkdex.plans.build import (
    build_bitmaps,
    build_bounds,
    build_index,
    build_positions,
    build_snapshot,
    current_snapshot,
    import_index,
    load_index,
    publish_snapshot,
)
from inkdex.sources.corpus import (
    PRESETS,
    corpus_manifest,
    count_documents,
    fetch_documents,
    first_documents,
    join_lines,
    read_lines,
    read_table,
    read_whole,
)
from inkdex.sources.stage_text import (
    read_postings_text,
    read_tf_text,
    read_tokens_text,
    write_postings_text,
    write_tf_text,
    write_tokens_text,
)
from inkdex.sources.store import DocumentStore, build_store, load_store
from inkdex.sources.titles import read_titles, write_titles

__all__ = [name for name in dir() if not name.startswith("_")]
