"""Scalar column expressions (built-in Catalyst functions only)."""

from vidlens.functions.columns import (crawl_date_as_date, crawl_date_of, delimited, length_range,
                                       length_range_order, log10_positive, month_start, parse_range,
                                       strip_ws, to_number, upload_date)

__all__ = [n for n in dir() if not n.startswith("_")]
