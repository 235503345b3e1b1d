from ledgerlift.sources.readers import read_bronze, read_csv, read_silver
from ledgerlift.sources.replace import delete_folder, replace_folder, write_beside
from ledgerlift.sources.scratch import clear_scratch, scratch_folder, scratch_path
from ledgerlift.sources.writers import write_report, write_table

__all__ = [
    "clear_scratch",
    "delete_folder",
    "read_bronze",
    "read_csv",
    "read_silver",
    "replace_folder",
    "scratch_folder",
    "scratch_path",
    "write_beside",
    "write_report",
    "write_table",
]
