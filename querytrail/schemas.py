"""Message schemas.  Fixed, explicit and all-nullable."""

from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

# Search log message: free-text term, epoch milliseconds, region.
LOG = StructType(
    [
        StructField("search", StringType(), True),
        StructField("timestamp", LongType(), True),
        StructField("region", StringType(), True),
    ]
)

# Search event message: user id, term, region, ISO-8601 time text.
EVENT = StructType(
    [
        StructField("user_id", IntegerType(), True),
        StructField("search", StringType(), True),
        StructField("region", StringType(), True),
        StructField("timestamp", StringType(), True),
    ]
)

# Shape of a raw topic record as far as the decoders need it.
MESSAGE = StructType([StructField("value", BinaryType(), True)])
