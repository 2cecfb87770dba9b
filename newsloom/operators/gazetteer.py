"""Place-name tables: row and name filters, merged lookup, region names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.strings import strip
from newsloom.operators.rows import explode_rows

# Name patterns, kept feature classes, and countries in the
# order their lookups are merged (a later one overrides an earlier one).
LATIN_ONLY = r"^[0-9A-Za-zÀ-ÿ\s\-']+$"
HAS_VOWEL = r"(?i)[aeiouyà-ÿ]"
FEATURE_CLASSES = ("P", "A")
COUNTRIES = ("NL", "BE", "DE")
MIN_ALTERNATE_LENGTH = 3
REGION_ADMIN1 = 5


def keep_places(
    gazetteer: DataFrame,
    countries: tuple[str, ...] = COUNTRIES,
    classes: tuple[str, ...] = FEATURE_CLASSES,
) -> DataFrame:
    """Rows of wanted countries and classes; short rows have no country and go."""
    return gazetteer.where(F.col("country_code").isin(*countries) & F.col("feature_class").isin(*classes))


def valid_main_name(name: Column) -> Column:
    return F.coalesce(name.rlike(LATIN_ONLY), F.lit(False))


def valid_alternate(name: Column) -> Column:
    """Alternates must also be three long and hold a vowel."""
    return valid_main_name(name) & (F.length(name) >= MIN_ALTERNATE_LENGTH) & name.rlike(HAS_VOWEL)


def place_names(gazetteer: DataFrame, alternates: bool = True) -> DataFrame:
    """(name_lower, cc): every acceptable name of every place."""
    main = F.lower(strip("name"))
    names = F.filter(F.array(main), valid_main_name)
    if alternates:
        others = F.transform(F.split(F.coalesce("alternate_names", F.lit("")), ",", -1), lambda a: F.lower(strip(a)))
        names = F.concat(names, F.filter(others, valid_alternate))
    return explode_rows(gazetteer, F.array_distinct(names), "name_lower", [F.col("country_code").alias("cc")])


def merge_names(names: DataFrame, countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """One country per name; where countries share a name the last listed wins."""
    rank = F.array_position(F.array(*[F.lit(c) for c in countries]), F.col("cc"))
    return names.where(F.col("cc").isin(*countries)).groupBy("name_lower").agg(F.max_by("cc", rank).alias("cc"))


def build_lookup(gazetteer: DataFrame, countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    return merge_names(place_names(keep_places(gazetteer, countries)), countries)


def region_names(gazetteer: DataFrame, admin1: int = REGION_ADMIN1) -> DataFrame:
    """Lower-cased names inside one first-level region; codes compare as numbers."""
    inside = gazetteer.where(F.col("admin1_code").try_cast("int") == admin1)
    return inside.select(F.lower("name").alias("name_lower")).where("name_lower is not null").distinct()
