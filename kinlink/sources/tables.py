"""Tab-separated sources and sinks, and samples of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlink.operators.normalize import SOURCE_COLUMNS


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All cells as strings; an empty cell is the empty string. A path that isn't there raises an AnalysisException."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path).na.fill("")


def read_source(spark: SparkSession, path: str, n_rows: int | None = None) -> DataFrame:
    """A source file; ValueError if columns are missing."""
    df = read_tsv(spark, path)
    if lacking := [c for c in SOURCE_COLUMNS if c not in df.columns]:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    return df if n_rows is None else df.limit(n_rows)


def exploded_truth(df: DataFrame) -> DataFrame:
    """s1_id, cand_id of a frame of comma lists; blanks and repeats dropped. Records without matches have no row."""
    ids = F.array_distinct(F.array_remove(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x)), ""))
    return df.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("cand_id")).distinct()


def read_truth(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, universe): matches as rows, and all S1 ids, those without matches included."""
    df = read_tsv(spark, path)
    return exploded_truth(df), df.select(F.col("source1_entity_id").alias("s1_id")).distinct()


def in_country(df: DataFrame, country: str, most: int | None = None) -> DataFrame:
    """Records of a country, the first so many by id."""
    found = df.filter(F.col("country") == country)
    return found if most is None else found.orderBy("entity_id").limit(most)


def pool(sources: DataFrame, targets: DataFrame | None, countries: list[str], per_country: int | None) -> DataFrame:
    """Records of the countries that are targets, and of the others the first so many of each country. Without targets all."""
    here = sources.filter(F.col("country").isin(countries))
    if targets is None:
        wanted, others = here.limit(0), here
    else:
        ids = targets.select("entity_id").distinct()
        wanted, others = here.join(ids, "entity_id", "left_semi"), here.join(ids, "entity_id", "left_anti")
    if per_country is not None:
        w = Window.partitionBy("country").orderBy("entity_id")
        others = others.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= per_country).drop("_place")
    return wanted.unionByName(others).dropDuplicates(["entity_id"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct values of the first column."""
    df = read_tsv(spark, path)
    return df.select(F.trim(F.col(df.columns[0])).alias("entity_id")).distinct()


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id a line; blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("entity_id")).filter("entity_id <> ''")


def empty_by_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows and empty cells of each column of each file that matches a pattern."""
    df = spark.read.option("sep", "\t").option("header", True).csv(pattern)
    named = df.withColumn("file", F.col("_metadata.file_name"))
    return named.groupBy("file").agg(F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(c) for c in df.columns))


def write_tsv(df: DataFrame, path: str) -> None:
    """Empty strings stay empty cells."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(path)


def with_position(df: DataFrame) -> DataFrame:
    """A scan with row_ord, by which its rows sort as they stand in their files."""
    return df.withColumn("row_ord", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))


def write_results(s1_ids: DataFrame, matching: DataFrame, blocked: DataFrame, folder: str, order: Column | None = None) -> None:
    """Both result files, in the order of the S1 records' file if they carry row_ord, else in that of their ids."""
    for name, df in (("matching_results", matching), ("candidate_pairs", blocked)):
        if order is None and "row_ord" in s1_ids.columns:
            places = s1_ids.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.min("row_ord").alias("row_ord"))
            df = df.join(places, "source1_entity_id", "left").orderBy("row_ord").select(*df.columns)
        else:
            df = df.orderBy(order if order is not None else F.col("source1_entity_id"))
        write_tsv(df, f"{folder}/{name}.tsv")


def write_report(rows: list[tuple[str, DataFrame]], path: str, spark: SparkSession) -> None:
    """A Markdown report of a few small frames."""
    text = []
    for title, df in rows:
        text += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        text += ["| " + " | ".join(str(v) for v in r) + " |" for r in df.limit(1000).collect()] + [""]
    spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.mode("overwrite").text(path)
