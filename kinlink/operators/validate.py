"""Checks of result files: which are errors, which are warnings, and examples."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHOWN = 5


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    info: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.errors


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, place (order within the file) of the lines that aren't blank."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("place")).filter(F.trim("value") != "")


def without_header(every: DataFrame, header: str) -> DataFrame:
    """The lines but for the header that a file begins with; a header that comes again is a line like any other."""
    same = F.col("value") == F.lit(header)
    files = every.groupBy("file").agg(F.min_by("value", "place").alias("value"), F.count_if(same).alias("n"))
    again = files.agg(F.sum("n") - F.count_if(same)).first()[0]
    return every.filter(~same).select("value").unionByName(every.sparkSession.range(again).select(F.lit(header).alias("value")))


def parsed(rows: DataFrame) -> DataFrame:
    """line, well_formed, s1_id, ids of result lines without their header."""
    cut = F.split("value", "\t", 2)
    ids = F.array_remove(F.transform(F.split(F.coalesce(F.get(cut, 1), F.lit("")), ","), lambda x: F.trim(x)), "")
    return rows.select(F.col("value").alias("line"), (F.instr("value", "\t") > 0).alias("well_formed"), F.trim(F.get(cut, 0)).alias("s1_id"), ids.alias("ids"))


def faults(rows: DataFrame) -> DataFrame:
    """fault, example: one row for each fault of a parsed row, duplicated rows included."""
    good = rows.filter("well_formed")
    repeated = good.groupBy("s1_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_row").alias("fault"), F.col("s1_id").alias("example"))
    each = F.array(
        F.when(~F.col("well_formed"), F.struct(F.lit("malformed_row").alias("fault"), F.col("line").alias("example"))),
        F.when(F.col("well_formed") & (F.size("ids") != F.size(F.array_distinct("ids"))), F.struct(F.lit("duplicate_id").alias("fault"), F.col("s1_id").alias("example"))),
        F.when(F.col("well_formed") & F.exists("ids", lambda x: x.startswith("S1-")), F.struct(F.lit("self_match").alias("fault"), F.col("s1_id").alias("example"))),
        F.when(F.col("well_formed") & F.exists("ids", lambda x: ~x.rlike("^S[123]-")), F.struct(F.lit("wrong_prefix").alias("fault"), F.col("s1_id").alias("example"))),
    )
    return rows.select(F.inline(F.filter(each, lambda x: x.isNotNull()))).unionByName(repeated)


def universe_faults(rows: DataFrame, required: DataFrame) -> DataFrame:
    """Missing and unexpected S1 ids."""
    seen, need = rows.filter("well_formed").select("s1_id").distinct(), required.select(F.col("entity_id").alias("s1_id")).distinct()
    return need.join(seen, "s1_id", "left_anti").select(F.lit("missing_s1").alias("fault"), F.col("s1_id").alias("example")).unionByName(seen.join(need, "s1_id", "left_anti").select(F.lit("unexpected_s1").alias("fault"), F.col("s1_id").alias("example")))


def pairs(rows: DataFrame) -> DataFrame:
    return rows.filter("well_formed").select("s1_id", F.explode("ids").alias("cand_id"))


def unknown_ids(rows: DataFrame, known: DataFrame) -> DataFrame:
    named = pairs(rows).filter(F.col("cand_id").rlike("^S[23]-"))
    return named.join(known.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_anti").select(F.lit("unknown_id").alias("fault"), F.col("cand_id").alias("example"))


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    return pairs(matched).join(pairs(candidates), ["s1_id", "cand_id"], "left_anti")


def counts(rows: DataFrame) -> DataFrame:
    good = rows.filter("well_formed")
    return good.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.count_if(F.size("ids") > 0).alias("n_non_empty"))


def check_file(spark: SparkSession, path: str, header: tuple[str, str], required: DataFrame | None = None, known: DataFrame | None = None, report: Report | None = None) -> tuple[Report, DataFrame | None]:
    """All checks of one file; the driver gets counts and a few examples of each fault."""
    out = report or Report()
    try:
        every = lines(spark, path)
        top = every.select(F.when(F.is_valid_utf8("value"), F.col("value")).otherwise("").alias("value")).first()
    except AnalysisException as e:
        out.errors.append(f"{path} can't be read: {e.getCondition()}")
        return out, None
    if top is None:
        out.errors.append(f"{path} is empty")
        return out, None
    if not every.filter(~F.is_valid_utf8("value")).isEmpty():
        out.errors.append(f"{path} is not UTF-8")
        return out, None
    said = [x.strip().lower() for x in top[0].split("\t")]
    if said != list(header):
        out.errors.append(f"{path}: the header is separated by commas" if "," in top[0] and "\t" not in top[0] else f"{path}: the header should be {header}")
        return out, None
    rows = parsed(without_header(every, top[0]))
    found = faults(rows)
    if required is not None:
        found = found.unionByName(universe_faults(rows, required))
    if known is not None:
        found = found.unionByName(unknown_ids(rows, known))
    else:
        out.warnings.append(f"{path}: ids are not checked against the sources")
    place = F.row_number().over(Window.partitionBy("fault").orderBy("example"))
    shown = found.withColumn("place", place).filter(F.col("place") <= SHOWN).groupBy("fault").agg(F.array_sort(F.collect_list(F.substring("example", 1, 80))).alias("shown"))
    for r in found.groupBy("fault").agg(F.count("*").alias("n")).join(shown, "fault").orderBy("fault").collect():
        out.errors.append(f"{path}: {r['fault']}: {r['n']}, as {', '.join(r['shown'])}")
    out.info |= counts(rows).first().asDict()
    return out, rows


def validate(spark: SparkSession, matching: str, candidates: str | None, test_s1: DataFrame | None, known: DataFrame | None = None) -> Report:
    """Both result files against the S1 records; matches outside the candidates are a warning."""
    out = Report()
    if test_s1 is None:
        out.errors.append("the S1 records are missing")
    out, matched = check_file(spark, matching, ("source1_entity_id", "matched_entity_ids"), test_s1, known, out)
    if candidates is None:
        out.warnings.append("there is no candidate file")
        return out
    out, blocked = check_file(spark, candidates, ("source1_entity_id", "candidate_entity_ids"), test_s1, known, out)
    if matched is not None and blocked is not None and (n := outside_candidates(matched, blocked).count()):
        out.warnings.append(f"{n} matches are no candidates")
    return out
