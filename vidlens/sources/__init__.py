"""Sources: crawl trees and tables."""

from vidlens.sources.crawl import (attach_crawl_dates, crawl_accounting, crawl_dates, load_crawls,
                                   parse_crawl_lines, read_crawl_lines, read_crawl_logs, video_table)
from vidlens.sources.tables import (read_csv_result, read_csv_tolerant, read_json_videos, read_parquet,
                                    read_table, read_videos)

__all__ = [n for n in dir() if not n.startswith("_")]
