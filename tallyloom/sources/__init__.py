"""Readers and writers: every text table is read as strings and typed by validated projections."""

from .readers import array_payload, count_tables, files, header_check, json_documents, slide_summaries, text_table, tiff_layout  # noqa: F401
from .writers import csv_single, current, current_set, json_document, json_lines, shared_folder, significant, staged, staged_set  # noqa: F401
