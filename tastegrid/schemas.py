"""Fixed schemas; no job infers types from files."""

from pyspark.sql import types as T

ITEMS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("plot", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("director", T.StringType()),
        T.StructField("cast", T.StringType()),
        T.StructField("budget", T.DoubleType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("runtime", T.DoubleType()),
        T.StructField("popularity", T.DoubleType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("director", T.StringType()),
        T.StructField("cast", T.StringType()),
        T.StructField("plot", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

EVAL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("reference", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

VIOLATION = "struct<guardrail_type:string,severity:string,message:string,details:map<string,string>>"

EXTRACTED_ITEM = (
    "title string, year int, director string, genres array<string>, `cast` array<string>, runtime_minutes int"
)

METRIC = "name string, value double, unit string, dimensions map<string,string>, ts timestamp"

LOG_LINE = "log_group string, log_stream string, message string, ts timestamp"
