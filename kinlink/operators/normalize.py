"""Normalized records: the four source columns and eleven derived ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.config import NormalizationConfig
from kinlink.functions import text as T

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]


def normalize(records: DataFrame, config: NormalizationConfig | None = None) -> DataFrame:
    """Normalized records; missing values count as empty, the four source columns stay as they are."""
    cfg = config or NormalizationConfig()
    raw = records.select(*records.columns)
    name, addr = F.coalesce("business_name", F.lit("")), F.trim(F.coalesce("business_address", F.lit("")))
    # both texts go to Python in one trip
    staged = raw.withColumns({"_name": T.fold(name), "_addr": T.fold(addr)}).withColumns({"name_normalized": T.clean_basic(F.col("_name"), True), "_clean": T.clean_basic(F.col("_addr"), True), "country_normalized": T.normalize_country(F.col("country"))})
    core, suffix = T.legal_suffix(F.col("name_normalized"), cfg.legal_suffixes)
    blank = addr == ""
    country = F.coalesce("country_normalized", F.lit(""))
    staged = staged.withColumns(
        {
            "name_core": core,
            "name_legal_suffix": suffix,
            "address_normalized": F.when(blank, "").otherwise(T.expand_address(F.col("_clean"), cfg.address_words, cfg.expand_street)),
            "address_postal_code": F.when(blank, "").otherwise(T.postal_code(addr, country)),
            "address_house_number": F.when(blank, "").otherwise(T.house_number(addr)),
            "address_is_empty": blank.cast("int"),
        }
    )
    return staged.withColumns({"name_tokens": T.tokens(F.col("name_normalized")), "address_numeric_tokens": T.numeric_tokens(F.col("address_normalized")), "address_tokens": T.tokens(F.col("address_normalized"))}).select(
        *records.columns, "country_normalized", "name_normalized", "name_core", "name_legal_suffix", "name_tokens", "address_normalized", "address_postal_code", "address_house_number", "address_numeric_tokens", "address_is_empty", "address_tokens"
    )


def with_source(records: DataFrame) -> DataFrame:
    """source (S1, S2, S3) from the id. Order within a source is that of entity_id, so no global numbering is needed."""
    return records.withColumn("source", F.substring("entity_id", 1, 2))
