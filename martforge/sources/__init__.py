"""Readers and scan windows."""

from martforge.sources.readers import (clean_column_names, file_index, flatten_items, in_window,
                                       latest_file, newest_file, read_delimited, read_dim_csv,
                                       read_id_lists, read_newest_ids, read_table, since)

__all__ = [n for n in dir() if not n.startswith("_")]
