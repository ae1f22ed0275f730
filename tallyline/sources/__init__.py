"""Readers and writers."""

from .documents import document_lines, number_lines, read_documents, read_labeled, read_lines
from .graphs import parse_adjacency, read_adjacency, read_sources
from .index_store import drop_versions, read_index, write_index
from .models import parse_model, read_model, read_models, read_predictions, write_model
from .tables import SCHEMAS, load_tables, read_table, write_table

__all__ = [
    "SCHEMAS", "document_lines", "drop_versions", "load_tables", "number_lines",
    "parse_adjacency", "parse_model", "read_adjacency", "read_documents", "read_index",
    "read_labeled", "read_lines", "read_model", "read_models", "read_predictions",
    "read_sources", "read_table", "write_index", "write_model", "write_table",
]
