"""vidlens: video-crawl analytics as lazy Spark DataFrame operators.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from the
DataFrame API, so Catalyst prunes columns, pushes filters into the scan and
plans partial aggregation; nothing is collected to the driver except one-row
scalars where a later step needs a bound.
"""

from vidlens import schema
from vidlens.session import get_spark, scratch_path

__all__ = ["schema", "get_spark", "scratch_path"]
