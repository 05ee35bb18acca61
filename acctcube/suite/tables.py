"""Tables of the library's input shapes, derived from the given tables.

Each function reads whole tables with the DataFrame API; ``suite.sql`` states the
same views as SQL for the comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acctcube.fixed_values import HIGHEST_LAYOUT, RETAKE_LAYOUT, SCORES
from acctcube.sources import read_landed
from acctcube.sources.readers import Field


SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_landed(spark, f"{sf}/{name}.parquet", SCHEMAS[name])


def _mod(col: str, n: int) -> Column:
    return F.col(col) % n


def _month_year(col: str) -> Column:
    return F.month(col) * 100 + F.year(col) % 100


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Score attempts, many per student."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    untested = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    composite = 1 + (F.col("l_quantity").cast("int") * 7 + part) % 36
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("student_id"),
        (1 + part % 36).cast("int").alias("english"),
        (1 + supp % 36).cast("int").alias("math"),
        (1 + (part + supp) % 36).cast("int").alias("reading"),
        (1 + (part * 7 + supp) % 36).cast("int").alias("science"),
        F.when(~untested, composite.cast("int")).alias("composite"),
        _month_year("l_shipdate").alias("test_date"),
        F.concat("l_returnflag", "l_linestatus").alias("file"),
        F.when(F.col("l_tax") == 0.08, "M").when(F.col("l_tax") != 0.0, "S").alias("test_location"),
    )


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    """The graduating cohort, one row per student."""
    rows = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    race = {"AUTOMOBILE": "A", "BUILDING": "B", "FURNITURE": "H", "HOUSEHOLD": "I"}
    segment = F.when(_mod("o_orderkey", 89) == 0, None)
    for name, code in race.items():
        segment = segment.when(F.col("c_mktsegment") == name, code)
    priority = F.col("o_orderpriority")
    return rows.select(
        F.col("o_orderkey").alias("student_key"),
        (F.col("c_nationkey") + 1).cast("int").alias("system"),
        (1 + _mod("o_custkey", 7)).cast("int").alias("school"),
        F.when(_mod("o_orderkey", 101) == 0, None)
        .when(_mod("o_orderkey", 2) == 0, "F")
        .otherwise("M")
        .alias("gender"),
        segment.otherwise("W").alias("race_ethnicity"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("econ_dis"),
        F.when(priority == "5-LOW", "Y").otherwise("N").alias("el"),
        F.when(priority == "1-URGENT", "Y").when(_mod("o_orderkey", 97) != 0, "N").alias("swd"),
        F.when((F.col("o_orderstatus") == "P") & (priority == "2-HIGH"), "N")
        .otherwise("Y")
        .alias("included_in_cohort"),
        F.when(_mod("o_orderkey", 13) == 0, 2).otherwise(1).alias("completion_type"),
    )


def appeal_tracker(spark: SparkSession, sf: str) -> DataFrame:
    """Appeals with their status; only approved ones with an id count."""
    cust = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderkey"))
        .when(_mod("o_orderkey", 11) == 0, F.col("o_orderkey"))
        .alias("student_id"),
        F.when(_mod("o_orderkey", 11) == 0, "Approved").otherwise("Denied").alias("status"),
        (1 + cust % 35).cast("int").alias("act_english_highest"),
        (1 + cust % 34).cast("int").alias("act_math_highest"),
        F.when(_mod("o_orderkey", 4) != 0, (1 + cust % 33).cast("int")).alias("act_reading_highest"),
        (1 + cust % 32).cast("int").alias("act_science_highest"),
        F.when(_mod("o_orderkey", 5) != 0, (1 + cust % 36).cast("int")).alias("act_composite_highest"),
        F.when(_mod("o_orderkey", 3) == 0, (400 + (cust * 13) % 1201).cast("int")).alias("sat_total"),
    )


def with_gaps(df: DataFrame, key: str, n: int, rest: int) -> DataFrame:
    """The key is missing where its remainder by ``n`` is ``rest``."""
    return df.withColumn(key, F.when(_mod(key, n) != rest, F.col(key)))


def with_hot_key(df: DataFrame, key: str) -> DataFrame:
    """A third of the rows have the key 7."""
    return df.withColumn(key, F.when(_mod(key, 3) == 1, 7).otherwise(F.col(key)))


def text_tracker(spark: SparkSession, sf: str) -> DataFrame:
    """The tracker with ids as text; one approved one is unreadable."""
    key = F.col("student_id")
    return appeal_tracker(spark, sf).withColumn("student_id", F.when(key == 33, "see file").otherwise(key.cast("string")))


def system_names(spark: SparkSession, sf: str) -> DataFrame:
    """District names, some missing."""
    return (
        table(spark, sf, "nation")
        .where(_mod("n_nationkey", 6) != 0)
        .select((F.col("n_nationkey") + 1).cast("int").alias("system"), F.col("n_name").alias("system_name"))
    )


def school_names(spark: SparkSession, sf: str) -> DataFrame:
    """District and school names per school; districts and schools are missing in places."""
    schools = (
        table(spark, sf, "customer")
        .select("c_nationkey", (1 + _mod("c_custkey", 7)).cast("int").alias("school"))
        .distinct()
    )
    return schools.join(system_names(spark, sf), F.col("c_nationkey") + 1 == F.col("system")).select(
        "system",
        "school",
        "system_name",
        F.when(F.col("school") != 5, F.concat(F.lit("School "), F.col("school").cast("string"))).alias(
            "school_name"
        ),
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select(
        (F.col("n_nationkey") + 1).cast("int").alias("system"),
        F.col("n_name").alias("system_name"),
        F.when(F.col("r_name") == "ASIA", "").otherwise(F.col("r_name")).alias("region"),
    )


def sites(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    district = (key + 1).cast("string")
    return table(spark, sf, "nation").select(
        F.when(key != 3, key.cast("string")).alias("org_code"),
        F.when(key == 4, district)
        .otherwise(F.concat(district, F.lit(" "), (key % 7 + 1).cast("string")))
        .alias("local_site_code"),
    )


def junior_day(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return rows.select(
        F.col("c_nationkey").alias("acthscode"),
        F.when(_mod("o_orderkey", 10) != 0, F.col("o_orderkey")).alias("state_stud_id"),
    )


def matched(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts with two ids that do not always agree."""
    rows = table(spark, sf, "lineitem")
    line = F.col("l_linenumber")
    return rows.select(
        F.col("l_orderkey").alias("usid"),
        F.when(line == 1, None)
        .when(line == 2, F.col("l_orderkey") + 1)
        .otherwise(F.col("l_orderkey"))
        .alias("unique_student_id"),
        _month_year("l_shipdate").alias("act_testdate"),
        (1 + F.col("l_partkey") % 36).cast("int").alias("act_english_highest"),
        (1 + F.col("l_suppkey") % 36).cast("int").alias("act_math_highest"),
        (1 + (F.col("l_partkey") * 3 + F.col("l_suppkey")) % 36).cast("int").alias("act_reading_highest"),
        (1 + (F.col("l_partkey") * 5 + F.col("l_suppkey")) % 36).cast("int").alias("act_science_highest"),
        (1 + F.col("l_extendedprice").cast("bigint") % 36).cast("int").alias("act_composite_highest"),
    )


def score_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Ids with scores of another maker; every score is missing in places."""
    rows = attempts(spark, sf)
    return rows.select(
        "student_id",
        F.when(F.col("reading") > 12, F.col("english")).alias("english"),
        F.when(F.col("science") > 12, F.col("math")).alias("math"),
        F.when(F.col("file") != "RF", F.col("reading")).alias("reading"),
        F.when(F.col("english") > 3, F.col("science")).alias("science"),
        F.when(F.col("math") > 18, F.col("composite")).alias("composite"),
    )


def highest_file(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts under the highest-score file's names."""
    names = {"test_date": "act_testdate", **{c: f"act_{c}_highest" for c in SCORES}}
    return (
        attempts(spark, sf)
        .withColumnsRenamed({"student_id": "unique_student_id", **names})
        .drop("file", "test_location")
    )


def state_day_file(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts with other scores under the state-day file's names."""
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("state_stud_id"),
        _month_year("l_shipdate").alias("testdate"),
        (1 + (F.col("l_partkey") + line) % 36).cast("int").alias("act_eng"),
        (1 + (F.col("l_suppkey") + line) % 36).cast("int").alias("act_math"),
        (1 + (F.col("l_partkey") * 2 + line) % 36).cast("int").alias("act_read"),
        (1 + (F.col("l_suppkey") * 2 + line) % 36).cast("int").alias("act_sci"),
        F.when(line != 5, (1 + F.col("l_quantity").cast("int") % 36).cast("int")).alias("act_composite"),
        F.when(F.col("l_tax") == 0.08, "M").when(F.col("l_tax") != 0.0, "S").alias("test_location"),
    )


SHORT_LAYOUT = [("id", 1, 13, "bigint"), ("english", 14, 15, "int"), ("math", 16, 17, "int"), ("date", 18, 25, "text")]


def short_records(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width records in a 25-byte layout; some scores are not numbers."""
    bad = F.col("l_partkey") % 17 == 0
    ymd = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.day("l_shipdate")
    english = F.when(bad, "xx").otherwise((1 + F.col("l_partkey") % 36).cast("string"))
    return table(spark, sf, "lineitem").select(
        F.concat(
            F.lpad(F.col("l_orderkey").cast("string"), 13, "0"),
            F.lpad(english, 2, " "),
            F.lpad((1 + F.col("l_suppkey") % 36).cast("string"), 2, " "),
            ymd.cast("string"),
        ).alias("value")
    )


def highest_records(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width records in the highest-score layout, with blank and unreadable ids."""
    rows = table(spark, sf, "lineitem")
    order = F.col("l_orderkey").cast("string")
    ymd = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + 27 + F.col("l_linenumber")
    cells = {
        "first": F.concat(F.lit("First"), F.col("l_partkey").cast("string")),
        "last": F.concat(F.lit("Läst"), F.col("l_suppkey").cast("string")),
        "mi": F.substring("l_returnflag", 1, 1),
        "dob": ymd.cast("string"),
        "id": F.when(F.col("l_tax") == 0.08, "")
        .when(F.col("l_tax") == 0.07, F.concat(order, F.lit("x")))
        .otherwise(order),
        "test_date": F.date_format("l_shipdate", "MMyyyy"),
        "id2": order,
        "english": (1 + F.col("l_partkey") % 36).cast("string"),
        "math": (1 + F.col("l_suppkey") % 36).cast("string"),
        "reading": F.when(F.col("l_linenumber") != 3, (1 + F.col("l_linenumber")).cast("string")).otherwise("--"),
        "science": F.lit(""),
        "composite": F.col("l_quantity").cast("int").cast("string"),
    }
    return _lines(rows, HIGHEST_LAYOUT, cells)


def retake_records(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width records in the retake layout."""
    rows = table(spark, sf, "lineitem")
    text = lambda c: F.col(c).cast("string")
    two = lambda c: (1 + F.col(c) % 36).cast("string")
    cells = {
        "year": F.date_format("l_shipdate", "yy"),
        "last": F.concat(F.lit("Läst"), text("l_suppkey")),
        "first": F.concat(F.lit("First"), text("l_partkey")),
        "middle": F.when(F.col("l_linenumber") != 2, F.col("l_returnflag")).otherwise(""),
        "address": F.concat(text("l_partkey"), F.lit(" Main Street")),
        "gender": F.when(F.col("l_linenumber") % 2 == 0, "F").otherwise("M"),
        "grade": F.when(F.col("l_linenumber") > 3, "12").otherwise("xx"),
        "act_id": text("l_partkey"),
        "dob": F.date_format("l_shipdate", "yyMMdd"),
        "city": F.lit("Somewhere"),
        "zip": F.lpad(text("l_suppkey"), 5, "0"),
        "state_id": text("l_orderkey"),
        "act_hs_code": text("l_suppkey"),
        "test_date": _month_year("l_shipdate").cast("string"),
        "english": two("l_partkey"),
        "math": two("l_suppkey"),
        "reading": two("l_orderkey"),
        "science": F.lit("--"),
        "composite": F.when(F.col("l_linestatus") == "F", two("l_linenumber")).otherwise(""),
    }
    return _lines(rows, RETAKE_LAYOUT, cells)


def _lines(rows: DataFrame, layout: Sequence[Field], cells: dict[str, Column]) -> DataFrame:
    """Cells laid out at their byte positions (``rpad`` would count characters)."""
    line, used = [], 0
    for name, first, last, _ in layout:
        if first > used + 1:
            line.append(F.lit(" " * (first - used - 1)))
        pad = F.lit(last - first + 1) - F.octet_length(cells[name])
        line.append(F.concat(cells[name], F.repeat(F.lit(" "), pad)))
        used = last
    return rows.select(F.concat(*line).alias("value"))


def named_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Score attempts with the student's names, which some records lack."""
    return attempts(spark, sf).withColumns(
        {
            "last_name": F.when(F.col("science") > 9, F.concat(F.lit("Last"), F.col("math").cast("string"))),
            "first_name": F.when(F.col("reading") > 12, F.concat(F.lit("First"), F.col("english").cast("string"))),
        }
    )


LATIN_LAYOUT: list[Field] = [("last", 1, 10, "text"), ("first", 11, 20, "text"), ("score", 21, 22, "int"), ("code", 23, 26, "text")]


def latin_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of 26 bytes in Latin-1; some are cut off, too long or blank."""
    supp, part, line = (F.col(f"l_{c}") for c in ("suppkey", "partkey", "linenumber"))
    whole = F.concat(
        F.rpad(F.concat(F.lit("Läst"), supp.cast("string")), 10, " "),
        F.rpad(F.concat(F.lit("Né"), (part % 1000).cast("string")), 10, " "),
        F.lpad((1 + part % 36).cast("string"), 2, " "),
        F.lpad((supp % 97).cast("string"), 4, "ö"),
    )
    text = (
        F.when(line == 2, F.substring(whole, 1, 21))
        .when(line == 3, F.substring(whole, 1, 15))
        .when(line == 4, F.concat(whole, F.lit("é2")))
        .when(line == 5, F.rpad(F.lit(""), 26, " "))
        .when(line == 6, "")
        .otherwise(whole)
    )
    return table(spark, sf, "lineitem").select(F.encode(text, "ISO-8859-1").cast("string").alias("value"))


def scores_with_bad_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Scores as text, some of them not numbers."""
    bad_math = F.when(F.col("math") > 33, F.concat(F.col("math").cast("string"), F.lit("*"))).otherwise(F.col("math").cast("string"))
    bad_english = F.when(F.col("english") == 7, "n/a").when(F.col("english") != 8, F.col("english").cast("string"))
    rows = attempts(spark, sf)
    return rows.select("student_id", bad_english.alias("english"), bad_math.alias("math"), "file")


def keyed_scores(spark: SparkSession, sf: str, changed: bool = False) -> DataFrame:
    """Scores under a few keys, a third of them under the missing one; some changed, one key left out."""
    rows = attempts(spark, sf)
    score = F.when((F.col("math") % 7 == 0) & F.lit(changed), F.col("english") + 100).otherwise(F.col("english"))
    kept = rows.where(~F.lit(changed) | (F.col("student_id") % 40 != 5))
    key = F.when(F.col("student_id") % 3 != 0, F.col("student_id") % 40)
    return kept.select(key.alias("k"), score.alias("english"))
