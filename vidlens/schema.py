"""Video table schema, defaults and the fixed values results depend on."""

from pyspark.sql import types as T

VIDEO = T.StructType([
    T.StructField("video_id", T.StringType(), False),
    T.StructField("uploader", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("length", T.IntegerType(), True),
    T.StructField("views", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("ratings_count", T.LongType(), True),
    T.StructField("comments_count", T.LongType(), True),
    T.StructField("related_ids", T.ArrayType(T.StringType()), True),
    T.StructField("crawl_date", T.StringType(), True),
])

KEY = "video_id"

# The nine fixed fields of a crawl line, in file order; the rest of the line
# holds related video ids.
CRAWL_FIELDS = ["video_id", "uploader", "age", "category", "length",
                "views", "rating", "ratings_count", "comments_count"]
INT_FIELDS = {"age": "int", "length": "int", "views": "bigint",
              "ratings_count": "bigint", "comments_count": "bigint"}
FLOAT_FIELDS = {"rating": "double"}

# ---------------------------------------------------------------------------
# These must equal the reference's for results to match.
# ---------------------------------------------------------------------------
# Columns the analysis reads from the store.
ANALYSIS_COLUMNS = ["video_id", "views", "rating", "comments_count",
                    "category", "length", "age"]
# Missing-value defaults.
DEFAULTS = {"views": 0, "rating": 0, "comments_count": 0, "length": 0, "age": -1}
# Columns truncated to integers after coercion (rating stays fractional).
INTEGER_METRICS = ["views", "comments_count", "length", "age"]
# Metrics used by the correlation table.
CORRELATION_COLUMNS = ["views", "rating", "comments_count", "length"]
# Upload date anchor: upload_date = anchor - age days.
DATE_ANCHOR = "2008-01-01"
# Length bins in seconds (right-closed) and their labels.
LENGTH_EDGES = [0, 60, 300, 600, 1200, 1800, 3600]
LENGTH_LABELS = ["0-1 min", "1-5 min", "5-10 min", "10-20 min", "20-30 min", "30-60 min"]
# Strict length window applied before the views band, and the band quantiles.
LENGTH_WINDOW = (0, 3600)
BAND_QUANTILES = (0.01, 0.99)
# Views histogram: bins on the log10 axis; density grid points.
HISTOGRAM_BINS = 50
DENSITY_GRID = 200
# Largest error of a density, as a share of the kernel's peak.
DENSITY_TOLERANCE = 1e-8
# Violin curves per length range: grid points and extension in bandwidths.
VIOLIN_GRID = 100
VIOLIN_CUT = 2
# Top-N: default N and the accepted range.
TOP_N_DEFAULT = 10
TOP_N_MAX = 100
# Page size of the table view.
PAGE_SIZE = 100
# Preview row count.
PREVIEW_ROWS = 5
# Counted example predicates (column, operator, value).
EXAMPLE_PREDICATES = [("category", "=", "Comedy"), ("views", ">", 1000),
                      ("uploader", "=", "PIEGUYRULZ"), ("rating", "=", 5.0)]
# Crawl log: the start line carries the crawl date as six digits (YYMMDD).
CRAWL_DATE_PATTERN = r"start:\s+(\d{6})"
LOG_FILE = "log.txt"
# Correlation table column names.
CORRELATION_NAMES = ("Feature 1", "Feature 2", "Correlation", "Absolute Correlation")
# Statistics table: metric names in output order.
STATISTICS_NAMES = ["Total Videos", "Average Views", "Median Views",
                    "Top Rated Video", "Most Watched Video"]
