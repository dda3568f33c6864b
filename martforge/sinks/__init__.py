"""Load policies."""

from martforge.sinks.policies import (align_schema, append_retain, export, insert_unseen, overwrite,
                                      refresh, replace_window, skip_if_empty, upsert_latest)

__all__ = [n for n in dir() if not n.startswith("_")]
