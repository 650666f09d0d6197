"""Column layouts of the ratings star schema."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])
MOVIES = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
TAGS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

#: Columns every input table must have.
REQUIRED = {
    "ratings": ["userId", "movieId", "rating", "timestamp"],
    "movies": ["movieId", "title", "genres"],
    "tags": ["userId", "movieId", "tag", "timestamp"],
}
NO_GENRES = "(no genres listed)"
