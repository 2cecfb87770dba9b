"""Fixed schemas of the landed files and of the tables derived from them."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


ARTICLE = StructType(_strings("feed", "title", "url", "published", "summary", "full_text", "scraped_at"))
ARTICLE_COLUMNS = ARTICLE.fieldNames()

# The two archive layouts differ in the name of the link and in what they carry.
ARCHIVE = StructType(_strings("date", "time", "title", "url", "full_text"))
ARCHIVE_LISTING = StructType(_strings("date", "time", "title", "summary", "link"))

# The 19 positional columns of a place-name dump.
GAZETTEER = StructType(
    [
        StructField("geonameid", LongType()),
        *_strings("name", "ascii_name", "alternate_names"),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        *_strings(
            "feature_class", "feature_code", "country_code", "cc2",
            "admin1_code", "admin2_code", "admin3_code", "admin4_code",
        ),
        StructField("population", LongType()),
        StructField("elevation", IntegerType()),
        StructField("dem", IntegerType()),
        StructField("timezone", StringType()),
        StructField("modification_date", DateType()),
    ]
)

COORDINATES = MapType(
    StringType(),
    StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())]),
)

KEYWORDS = ArrayType(StructType([StructField("word", StringType()), StructField("score", DoubleType())]))

EVIDENCE = ArrayType(StructType([StructField("loc", StringType()), StructField("cc", StringType())]))

FEED_LINKS = ArrayType(StructType(_strings("_href", "_rel", "_type")))

# RSS items and Atom entries in one layout; absent elements are null.
FEED_ENTRY = StructType(
    [
        *_strings("title", "guid", "id", "pubDate", "published", "updated", "description", "summary"),
        StructField("link", ArrayType(StructType(_strings("_VALUE", "_href", "_rel", "_type")))),
        StructField("enclosure", ArrayType(StructType(_strings("_url", "_type")))),
    ]
)

FILTER_SPEC = StructType(
    [
        StructField("text_filter", StringType()),
        StructField("selected_feeds", ArrayType(StringType())),
        StructField("location_search", StringType()),
        StructField("date_range", ArrayType(StringType())),
    ]
)
