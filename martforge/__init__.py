"""martforge: operational data marts as plain Spark DataFrame plans.

Every mart is a pure function of its input DataFrames and an ``as_of`` date.
Column functions live in :mod:`martforge.functions`, DataFrame -> DataFrame
operators in :mod:`martforge.operators`, readers in :mod:`martforge.sources`,
load policies in :mod:`martforge.sinks`, end-to-end marts in
:mod:`martforge.plans` and the file-arrival jobs in :mod:`martforge.streaming`.
"""

from martforge.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
