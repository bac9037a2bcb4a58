"""DataFrame operators: ``f(df, ...) -> DataFrame``, all lazy."""

from vidlens.operators.clean import (coerce_numeric, dedup_first, drop_incomplete, drop_null_keys,
                                     drop_related, fill_defaults, related_as_text, to_dates)
from vidlens.operators.distribution import (LengthDirectory, length_range_density, length_range_summary,
                                            length_range_table, log_density, log_histogram)
from vidlens.operators.filters import (count_matches, filter_videos, length_window, quantile_band,
                                       quantile_bounds, range_filter, valid_age)
from vidlens.operators.quantiles import exact_quantiles, quantile_scalar
from vidlens.operators.stats import (arg_max_row, category_stats, correlation_matrix, correlation_pairs,
                                     correlation_wide, most_watched, summary_statistics, top_rated)
from vidlens.operators.topn import (next_page, page, page_count, prev_page, preview, sort_by, top_comments,
                                    top_n, top_rating, top_views, validate_n)
from vidlens.operators.trends import daily_trend, monthly_trend, reaggregate_trend

__all__ = [n for n in dir() if not n.startswith("_")]
