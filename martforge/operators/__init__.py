"""DataFrame -> DataFrame operators: filters, joins, aggregates, windows, set ops."""

from martforge.operators import aggregates, filters, joins, setops, windows

__all__ = ["aggregates", "filters", "joins", "setops", "windows"]
