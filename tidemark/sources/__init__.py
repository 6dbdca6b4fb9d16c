from tidemark.sources.csv_files import parse_files, with_file_identity
from tidemark.sources.tables import Run, Tables, merge_into

__all__ = ["Run", "Tables", "merge_into", "parse_files", "with_file_identity"]
