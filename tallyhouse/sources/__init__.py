from .lake import LAYERS, Lake
from .readers import compare_tables, convert_to_parquet, dataset_card, read_source, source_files, write_json_report
from .retail_view import read_table, retail_lines

__all__ = [
    "LAYERS",
    "Lake",
    "compare_tables",
    "convert_to_parquet",
    "dataset_card",
    "read_source",
    "read_table",
    "retail_lines",
    "source_files",
    "write_json_report",
]
