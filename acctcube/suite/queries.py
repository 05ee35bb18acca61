"""Registered queries: name -> (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from acctcube.fixed_values import (
    BENCHMARKS,
    HIGHEST_LAYOUT,
    RACE_LABELS,
    RETAKE_LAYOUT,
    SCHOOL_NAMES_FORCED,
    SCHOOL_NAMES_IF_MISSING,
    SCORES,
    SUBJECTS,
)
from acctcube.functions import (
    apply_to,
    between,
    contains,
    ends_with,
    flag,
    if_else,
    in_set,
    month_year_code,
    nan_to_null,
    pct,
    pick,
    rename_prefix,
    round_even,
    round_up,
    starts_with,
    to_front,
    to_number,
    ymd_text,
)
from acctcube.operators import appeals as ap, best, cohort as co, cube as cb, joins as jn
from acctcube.operators import labels as lb, measures as ms, reconcile as rc, release as rl, reports as rp
from acctcube.operators.carry import carry_forward
from acctcube.plans import files
from acctcube.plans.publish import publish, published as published_run
from acctcube.session import scratch_path
from acctcube.sources import (
    read_csv,
    read_csv_checked,
    read_fixed_width,
    read_in_order,
    read_landed,
    save_table,
    write_csv,
    write_named,
    write_records,
    write_split,
)
from acctcube.suite import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# school names of the suite, besides the fixed ones
IF_MISSING = {**SCHOOL_NAMES_IF_MISSING, (4, 5): "North Academy", (13, 5): "River School"}
FORCED = {**SCHOOL_NAMES_FORCED, (3, 2): "Hill School", (9, 5): "Lake School"}
WHAT_IF_SYSTEM = 7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- shared inputs ---------------------------------------------------------


def decoded(spark, sf):
    return co.decode_attempts(t.attempts(spark, sf), "student_id")


def best_attempts(spark, sf):
    return best.best_record(decoded(spark, sf), "student_id").drop("test_location")


def best_with_gaps(spark, sf):
    attempts = t.with_gaps(decoded(spark, sf), "student_id", 10, 3)
    return best.best_record(attempts, "student_id").drop("test_location")


def students(spark, sf):
    return co.student_level(t.cohort(spark, sf), decoded(spark, sf).drop("test_location"))


def students_2016(spark, sf):
    return co.student_level_fill(t.cohort(spark, sf), t.score_crosswalk(spark, sf), t.attempts(spark, sf))


def approved(spark, sf):
    return ap.approved_appeals(t.appeal_tracker(spark, sf))


def appealed(spark, sf):
    return files.post_appeals_students(students(spark, sf), approved(spark, sf))


def ours(spark, sf, level):
    """Our post-appeals rows of one level in the external vocabulary."""
    cube = files.post_appeals_cube(appealed(spark, sf)).where(F.col("level") == level)
    return lb.relabel_subgroups(cube.drop("level"))


def theirs(own: DataFrame) -> DataFrame:
    """The other maker's table: rows left out and one mean off in places."""
    external = lb.external_layout(own).where(F.col("system") % 5 != 0)
    shifted = F.when(F.col("system") % 3 == 0, F.col("act_composite_avg") + 0.2)
    return external.withColumn("act_composite_avg", shifted.otherwise(F.col("act_composite_avg")))


def compared(spark, sf, level):
    """Our rows and theirs under our column names."""
    own = ours(spark, sf, level)
    back = {"act_composite_avg": "avg_composite", "pct_21_orhigher": "pct_21_or_higher"}
    return own, theirs(own).withColumnsRenamed(back)


def published(spark, sf, level):
    return lb.external_layout(ours(spark, sf, level))


# ---- sources and sinks -----------------------------------------------------


@query
def src_csv(spark, sf):
    df, path = t.cohort(spark, sf), scratch_path(spark, "cohort-csv")
    # the file has its columns in another order and one more
    write_csv(df.select(*reversed(df.columns), F.lit("zz").alias("extra")), path)
    return read_csv(spark, path, df.schema)


@query
def src_fixed_width(spark, sf):
    path = scratch_path(spark, "records")
    write_records(t.short_records(spark, sf), path)
    return read_fixed_width(spark, path, t.SHORT_LAYOUT)


@query
def src_fixed_width_retake(spark, sf):
    path = scratch_path(spark, "retake-records")
    write_records(t.retake_records(spark, sf), path)
    return read_fixed_width(spark, path, RETAKE_LAYOUT)


@query
def src_parquet(spark, sf):
    return save_table(t.cohort(spark, sf), scratch_path(spark, "cohort"))


@query
def sink_csv(spark, sf):
    df, path = t.attempts(spark, sf), scratch_path(spark, "attempts-csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@query
def sink_spreadsheet_csv(spark, sf):
    df, path = t.appeal_tracker(spark, sf), scratch_path(spark, "appeals-csv")
    write_csv(df, path, bom=True)
    return read_csv(spark, path, df.schema)


@query
def sink_split_by_key(spark, sf):
    df, path = t.cohort(spark, sf), scratch_path(spark, "cohort-split")
    write_split(df, path, "system")
    # the folder and the key kept in the file must agree
    wanted = StructType([*df.schema.fields, StructField("system_is", df.schema["system"].dataType)])
    return read_csv(spark, path, wanted).where(F.col("system_is") == F.col("system")).drop("system_is")


@query
def src_fixed_width_latin(spark, sf):
    path = scratch_path(spark, "latin-records")
    write_records(t.latin_records(spark, sf), path)
    return read_fixed_width(spark, path, t.LATIN_LAYOUT, charset="ISO-8859-1", status="record_status")


@query
def src_csv_rejects(spark, sf):
    path = scratch_path(spark, "scores-csv")
    write_csv(t.scores_with_bad_cells(spark, sf), path)
    rows, rejects = read_csv_checked(spark, path, "student_id bigint, english int, math int, file string")
    kept = rows.select(F.lit("kept").alias("column_name"), F.concat_ws("/", "student_id", "english", "math", "file").alias("raw"))
    return rejects.where("record > 0").select("column_name", "raw").unionByName(kept)


@query
def save_replace(spark, sf):
    path = scratch_path(spark, "students")
    save_table(t.cohort(spark, sf), path)
    # each save replaces the table it reads
    save_table(co.graduates(read_landed(spark, path)).withColumn("school", F.col("school") * 10), path)
    save_table(read_landed(spark, path).withColumn("saved", F.lit(2)), path)
    return read_landed(spark, path)


@query
def sink_named_files(spark, sf):
    df, path = t.cohort(spark, sf), scratch_path(spark, "cohort-named")
    write_named(df, path, "system", "cohort_{key}.csv")
    # the parts of a key too large for one task are numbered
    file = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    one = F.regexp_replace(file, r"^(cohort_\d+)(_\d+)?\.csv$", "$1.csv")
    return read_csv(spark, path, df.schema).withColumn("file", one)


@query
def sink_ordered_csv(spark, sf):
    rows, path = ms.score_summary().by(students(spark, sf), "system", "school"), scratch_path(spark, "ordered-csv")
    write_csv(rows, path, order=["-avg_composite", "system", "school"])
    return read_in_order(spark.read.option("header", True).schema(rows.schema).csv(path), "position")


def _published(spark, sf):
    out = scratch_path(spark, "published")
    names = t.school_names(spark, sf), t.system_names(spark, sf)
    publish(t.cohort(spark, sf), decoded(spark, sf).drop("test_location"), approved(spark, sf), *names, out, stamp="2017jul11")
    return published_run(spark, out)


@query
def publish_outputs(spark, sf):
    def rows(name, path):
        csv = spark.read.option("header", True).csv
        found = spark.read.parquet(path) if name in ("students", "cube") else csv(path)
        return found.agg(F.lit(path.rsplit("/", 1)[1]).alias("output"), F.count(F.lit(1)).alias("n"))

    return reduce(DataFrame.unionByName, [rows(n, p) for n, p in _published(spark, sf).items()])


@query
def publish_release_district(spark, sf):
    wanted = release_district(spark, sf).schema
    return read_csv(spark, _published(spark, sf)["release_district"], wanted)


# ---- filters and projections -----------------------------------------------


@query
def cohort_filter(spark, sf):
    return co.graduates(t.cohort(spark, sf))


@query
def exclude_location_r(spark, sf):
    return co.exclude_location(t.attempts(spark, sf))


@query
def exclude_location_stata(spark, sf):
    return co.exclude_location(t.attempts(spark, sf), keep_missing=True)


@query
def in_set_null_false(spark, sf):
    member = in_set(F.col("race_ethnicity"), ["B", "H", "I"])
    return t.cohort(spark, sf).select("student_key", flag(member).alias("bhn"), flag(~member).alias("not_bhn"))


@query
def id_mismatch_filter(spark, sf):
    return co.id_mismatch(t.matched(spark, sf), "unique_student_id", "usid")


@query
def ifelse_null_condition(spark, sf):
    high = F.col("composite") >= 21
    return t.attempts(spark, sf).select(
        "student_id", "composite", "math", if_else(high, F.col("math"), F.lit(0)).alias("math_if_high")
    )


@query
def race_label_map(spark, sf):
    label = cb.label_codes(F.col("race_ethnicity"), {k: v for k, v in RACE_LABELS.items() if k != "W"})
    return t.cohort(spark, sf).select("student_key", "race_ethnicity", label.alias("race_label"))


@query
def project_release_columns(spark, sf):
    keys = {"District": F.col("system"), "School": F.col("school"), "Subgroup": F.col("subgroup")}
    return rl.release_columns(published(spark, sf, "school"), keys, numbers=True)


@query
def select_helpers(spark, sf):
    df = t.attempts(spark, sf)
    names = pick(ends_with(df, "_id"), contains(df, "pos"), between(df, "english", "reading"), starts_with(df, "test_"))
    halves = apply_to(df, ["english", "math"], lambda c: c / 2)
    return to_front(rename_prefix(halves.select(*names), "test_", "sitting_"), "composite")


# ---- joins -----------------------------------------------------------------


@query
def join_left_cohort(spark, sf):
    return jn.attach_unique(
        co.graduates(t.cohort(spark, sf)), best_attempts(spark, sf), "student_key", "student_id"
    )


@query
def join_left_cohort_missing_keys(spark, sf):
    kept = t.with_gaps(co.graduates(t.cohort(spark, sf)), "student_key", 3, 0)
    return jn.attach_unique(kept, best_with_gaps(spark, sf), "student_key", "student_id")


@query
def join_left_cohort_hot_key(spark, sf):
    kept = t.with_hot_key(co.graduates(t.cohort(spark, sf)), "student_key")
    return jn.attach_unique(kept, best_attempts(spark, sf), "student_key", "student_id")


@query
def appeals_merge_missing_keys(spark, sf):
    cohort = t.with_gaps(t.cohort(spark, sf), "student_key", 3, 0)
    attempts = t.with_gaps(decoded(spark, sf).drop("test_location"), "student_id", 10, 3)
    return ap.merge_appeals(co.student_level(cohort, attempts), ap.approved_appeals(t.text_tracker(spark, sf)))


@query
def appeals_merge(spark, sf):
    return ap.merge_appeals(students(spark, sf), approved(spark, sf))


@query
def appeals_merge_no_refill(spark, sf):
    return ap.merge_appeals(students(spark, sf), approved(spark, sf), refill=False)


@query
def join_left_names(spark, sf):
    counts = students(spark, sf).groupBy("system").agg(F.count("composite").alias("tested"))
    return jn.left_join(counts, t.system_names(spark, sf), "system")


@query
def join_full_counts_avgs(spark, sf):
    rows = students(spark, sf)
    counts = rows.groupBy("system", "gender").agg(F.count(F.lit(1)).alias("n"))
    means = (
        rows.where(F.col("composite").isNotNull())
        .groupBy("system", "gender")
        .agg(round_even(F.avg("composite"), 1).alias("avg_high"), F.count(F.lit(1)).alias("n"))
    )
    return jn.full_join(counts, means, ["system", "gender"])


@query
def merge_keep_using(spark, sf):
    crosswalk = best.best_record(
        t.attempts(spark, sf).select("student_id", *SCORES), "student_id", best.SUBJECT_FIRST
    )
    kept = co.graduates(t.cohort(spark, sf)).select("student_key", "system", "school")
    return jn.attach_unique(kept, crosswalk, "student_key", "student_id")


@query
def merge_status_missing_keys(spark, sf):
    kept = t.with_gaps(co.graduates(t.cohort(spark, sf)), "student_key", 3, 0).select("student_key", "system")
    return jn.merge_status(kept, best_with_gaps(spark, sf).select("student_id", "composite"), "student_key", "student_id", "id")


@query
def merge_status(spark, sf):
    taken = best_attempts(spark, sf).select("student_id", "composite")
    kept = co.graduates(t.cohort(spark, sf)).select("student_key", "system")
    return jn.merge_status(taken, kept, "student_id", "student_key", "student_key")


# ---- aggregation -----------------------------------------------------------


@query
def agg_district(spark, sf):
    return ms.score_summary().by(students(spark, sf), "system")


@query
def agg_sum_empty_zero(spark, sf):
    rows = t.attempts(spark, sf)
    return ms.Summary([ms.Measure("points", F.col("composite"))], []).by(rows, "file", "test_location")


@query
def agg_conditional_counts(spark, sf):
    return ms.Summary(ms.score_measures(gender_tests=False), []).by(students(spark, sf), "system", "school")


@query
def agg_strict_count(spark, sf):
    strict = [m for m in ms.score_measures() if m.strict]
    return ms.Summary(strict, []).by(students(spark, sf), "system", "school")


@query
def averages_tested_only(spark, sf):
    return ms.Summary([], ms.averages()).by(appealed(spark, sf), "system", "school")


@query
def best_attempt(spark, sf):
    return best_attempts(spark, sf)


@query
def best_attempt_alt_order(spark, sf):
    rows = t.attempts(spark, sf).select("student_id", *SCORES)
    return best.best_record(rows, "student_id", best.SUBJECT_FIRST)


@query
def first_nonnull_per_column(spark, sf):
    rows = co.exclude_location(t.attempts(spark, sf), keep_missing=True)
    return best.first_nonmissing(rows, "student_id", best.SUBJECT_FIRST, SCORES)


MIXED = ["-file", "test_date", "-composite", "math"]
BY_FILE = ["file", "-composite", "test_date"]
NAMES = ["first_name", "last_name"]


@query
def first_nonnull_mixed_order(spark, sf):
    rows = co.exclude_location(t.named_attempts(spark, sf), keep_missing=True)
    return best.first_nonmissing(rows, "student_id", MIXED, [*NAMES, *SCORES])


@query
def first_rows(spark, sf):
    return best.first_rows(t.attempts(spark, sf), 20, ["-composite", "test_date"])


@query
def distinct_values(spark, sf):
    return t.cohort(spark, sf).where(F.col("race_ethnicity").isNotNull()).select("race_ethnicity").distinct()


@query
def rollup_levels(spark, sf):
    everyone = cb.Subgroups(cb.fixed_subgroups()[:1], [])
    return cb.subgroup_cube(students(spark, sf), ms.score_summary(), everyone)


@query
def subgroup_cube(spark, sf):
    return files.highest_score_cube(students(spark, sf))


@query
def subgroup_cube_post_appeals(spark, sf):
    return files.post_appeals_cube(appealed(spark, sf))


@query
def subgroup_cube_loose_super(spark, sf):
    return files.post_appeals_cube(appealed(spark, sf), loose_super=True)


@query
def subgroup_race(spark, sf):
    return cb.subgroup_cube(students(spark, sf), ms.score_summary(), cb.race_subgroups())


@query
def rates_state(spark, sf):
    return ms.rates(ms.score_summary().by(students(spark, sf)))


@query
def pct_suppressed_30(spark, sf):
    return files.subgroups_2016(students_2016(spark, sf))


@query
def rates_gender_missing(spark, sf):
    return files.totals_2016(students_2016(spark, sf), "system")


@query
def rates_gender_missing_school(spark, sf):
    return files.totals_2016(students_2016(spark, sf), "system", "school")


@query
def rates_gender_missing_state(spark, sf):
    return files.totals_2016(students_2016(spark, sf))


@query
def region_rollup(spark, sf):
    return rp.region_rollup(students_2016(spark, sf), t.regions(spark, sf))


# ---- ordering --------------------------------------------------------------


@query
def locf_names(spark, sf):
    rows = t.cohort(spark, sf).select("system", "school", F.col("race_ethnicity").alias("subgroup")).distinct()
    named = jn.left_join(rows, t.system_names(spark, sf), "system")
    return carry_forward(named, ["system", "school", "subgroup"], ["system_name"], {"system_name": "filled_name"})


@query
def sort_release(spark, sf):
    rows = ms.score_summary().by(students(spark, sf), "system", "school")
    return rows.orderBy(F.desc_nulls_last("avg_composite"), "system", "school")


# ---- stacking --------------------------------------------------------------


@query
def union_attempts(spark, sf):
    names = {"test_date": "test_date", **{c: c for c in SCORES}}
    day = co.exclude_location(t.attempts(spark, sf))
    other = co.id_mismatch(t.matched(spark, sf), "unique_student_id", "usid")
    renamed = {"test_date": "act_testdate", **{c: f"act_{c}_highest" for c in ("english", "math", "composite")}}
    stacked = co.stack_attempts(
        [
            (t.attempts(spark, sf), {"unique_student_id": "student_id", **names}, "highest"),
            (day, {"unique_student_id": "student_id", **names}, "state day"),
            (other, {"unique_student_id": "usid", **renamed}, "matched"),
        ]
    )
    return co.decode_attempts(stacked, "unique_student_id")


@query
def what_if_correction(spark, sf):
    official = students(spark, sf)
    swapped = {"english": "math", "math": "english", "reading": "science", "science": "reading", "composite": "reading"}
    own = t.attempts(spark, sf).select("student_id", *[F.col(o).alias(n) for n, o in swapped.items()])
    reported = lb.external_layout(
        ms.rates(ms.score_summary().by(official, "system")).withColumn("subgroup", F.lit("All Students"))
    )
    return rp.what_if_correction(official, own, reported, WHAT_IF_SYSTEM)


# ---- scalar functions ------------------------------------------------------


def _ratio_rows(spark, sf):
    rows = t.attempts(spark, sf)
    return rows.select("student_id", (F.lit(100.0) * F.col("english") / (F.col("math") * 20)).alias("x"))


@query
def round_half_even(spark, sf):
    x = F.col("x")
    return _ratio_rows(spark, sf).select("student_id", round_even(x, 1).alias("one"), round_even(x).alias("whole"))


@query
def round_half_up(spark, sf):
    x = F.col("x")
    return _ratio_rows(spark, sf).select("student_id", round_up(x, 1).alias("one"), round_up(x).alias("whole"))


@query
def pct_zero_denominator(spark, sf):
    whole = F.col("math") - 1
    return t.attempts(spark, sf).select("student_id", "english", pct(F.col("english"), whole).alias("p"))


@query
def decode_month_year(spark, sf):
    # month 13 and later in some rows
    code = F.col("act_testdate") + F.when(F.col("act_math_highest") > 30, 900).otherwise(0)
    rows = t.matched(spark, sf).withColumn("code", code)
    return rows.select("usid", "code", month_year_code(F.col("code")).alias("test_date"))


@query
def decode_ymd(spark, sf):
    # days 28 to 34 of any month
    day = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + 27 + F.col("l_linenumber")
    rows = t.table(spark, sf, "lineitem").select("l_orderkey", day.cast("string").alias("dob"))
    return rows.select("l_orderkey", "dob", ymd_text(F.col("dob")).alias("born"))


@query
def try_cast_ids(spark, sf):
    tail = F.when(F.col("o_orderstatus") == "P", "x").when(F.col("o_orderstatus") == "F", ".7").otherwise(" ")
    text = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), tail)
    rows = t.table(spark, sf, "orders").select(text.alias("raw"))
    return rows.select(
        "raw", to_number(F.col("raw"), "bigint").alias("id"), to_number(F.col("raw")).alias("number")
    )


@query
def split_site_code(spark, sf):
    code = F.col("local_site_code")
    return t.sites(spark, sf).select(
        "org_code", rp.split_code(code, 0).alias("system"), rp.split_code(code, 1).alias("school")
    )


@query
def nan_to_null_scores(spark, sf):
    noisy = F.coalesce(F.col("composite").cast("double"), F.lit(float("nan")))
    return t.attempts(spark, sf).select("student_id", "english", nan_to_null(noisy).alias("composite"))


QUERIES["nan_to_null"] = QUERIES.pop("nan_to_null_scores")


@query
def coalesce_scores(spark, sf):
    kept = co.graduates(t.cohort(spark, sf)).select("student_key")
    first = best.best_record(t.score_crosswalk(spark, sf), "student_id", best.SUBJECT_FIRST)
    any_ = best.first_nonmissing(t.attempts(spark, sf), "student_id", best.SUBJECT_FIRST, SCORES)
    any_ = any_.withColumnsRenamed({c: f"day_{c}" for c in SCORES})
    both = jn.attach_unique(jn.attach_unique(kept, first, "student_key", "student_id"), any_, "student_key", "student_id")
    return both.select("student_key", *[F.coalesce(c, f"day_{c}").alias(c) for c in SCORES])


# ---- student level ---------------------------------------------------------


@query
def benchmark_flags_gated(spark, sf):
    return co.benchmark_flags(t.attempts(spark, sf), mode="gated")


@query
def benchmark_flags_ungated(spark, sf):
    rows = t.matched(spark, sf).select(
        "usid",
        F.col("act_english_highest").alias("english"),
        F.when(F.col("act_composite_highest") > 9, F.col("act_math_highest")).alias("math"),
        F.col("act_reading_highest").alias("reading"),
        F.col("act_science_highest").alias("science"),
    )
    return co.benchmark_flags(rows, mode="ungated")


@query
def benchmark_flags_zero(spark, sf):
    blanked = apply_to(t.attempts(spark, sf), SUBJECTS, lambda c: F.when(F.col("composite").isNotNull(), c))
    return co.benchmark_flags(blanked, mode="zero")


@query
def student_level(spark, sf):
    return students(spark, sf)


@query
def student_level_all_files(spark, sf):
    attempts = files.all_attempts(
        t.highest_file(spark, sf), {"State day": t.state_day_file(spark, sf)}, t.matched(spark, sf)
    )
    return co.student_level(t.cohort(spark, sf), attempts)


@query
def student_level_fill(spark, sf):
    return students_2016(spark, sf)


@query
def student_level_fill_names(spark, sf):
    day = t.named_attempts(spark, sf)
    return co.student_level_fill(t.cohort(spark, sf), t.score_crosswalk(spark, sf), day, order=BY_FILE, names=NAMES)


@query
def appeal_indicators(spark, sf):
    return appealed(spark, sf)


@query
def student_file(spark, sf):
    return files.student_file(appealed(spark, sf))


# ---- labels ----------------------------------------------------------------


@query
def label_names(spark, sf):
    # landed, as the run that publishes it does: three branches of the plan read it
    cube = save_table(files.post_appeals_cube(appealed(spark, sf)), scratch_path(spark, "cube"))
    return lb.label_names(cube, t.school_names(spark, sf), IF_MISSING)


@query
def label_names_2016(spark, sf):
    return files.base_file_2016(students_2016(spark, sf), t.school_names(spark, sf))


@query
def label_names_forced(spark, sf):
    rows = ms.Summary(ms.score_measures(), []).by(students(spark, sf), "system", "school")
    return lb.label_names_forced(rows, t.school_names(spark, sf), FORCED)


@query
def relabel_subgroups(spark, sf):
    cube = cb.subgroup_cube(students(spark, sf), ms.score_summary())
    return lb.relabel_subgroups(cube).select("level", "system", "school", "subgroup", "enrolled")


# ---- comparison ------------------------------------------------------------

DISTRICT_KEYS = ["system", "subgroup"]
SCHOOL_KEYS = ["system", "school", "subgroup"]
COMPARED = ["avg_composite", "participation_rate", "pct_21_or_higher"]


@query
def reconcile_tolerance(spark, sf):
    own, other = compared(spark, sf, "school")
    return rc.reconcile_tolerance(own, other, SCHOOL_KEYS, COMPARED)


@query
def reconcile_tolerance_district(spark, sf):
    own, other = compared(spark, sf, "district")
    return rc.reconcile_tolerance(own, other, DISTRICT_KEYS, COMPARED)


@query
def reconcile_anti(spark, sf):
    own = ours(spark, sf, "district")
    counts = {"avg_composite": "act_composite_avg", "n_21_or_higher": "n_21_orhigher", "n_below_19": "n_below19"}
    return rc.reconcile_exact(own, theirs(own), DISTRICT_KEYS, counts)


@query
def reconcile_side_by_side(spark, sf):
    own = ours(spark, sf, "state")
    # the state row has key 0 in both tables
    other = lb.external_layout(own).where(F.col("valid_tests") > 0)
    pairs = {f"n_cr_{s}": f"met_CRB_{s}" for s in SUBJECTS} | {"n_cr_all": "met_All4_CRB"}
    return rc.reconcile_side_by_side(own, other, SCHOOL_KEYS, pairs)


@query
def mismatch_counts(spark, sf):
    own, other = compared(spark, sf, "school")
    return rc.mismatch_counts(own, other, SCHOOL_KEYS, [*COMPARED, "enrolled", "valid_tests"])


@query
def mismatch_hot_key(spark, sf):
    return rc.mismatch_counts(t.keyed_scores(spark, sf), t.keyed_scores(spark, sf, changed=True), ["k"], ["english"])


# ---- release ---------------------------------------------------------------


@query
def suppress_release(spark, sf):
    keys = {"District": F.col("system"), "School": F.col("school"), "Subgroup": F.col("subgroup")}
    rows = rl.release_columns(published(spark, sf, "school"), keys)
    return rl.suppress(rows, rl.Suppression(low=5, high=95, minimum=30, rate=True))


@query
def suppress_counts(spark, sf):
    rows = published(spark, sf, "school")
    n = F.col("valid_tests")
    return rows.select(
        *SCHOOL_KEYS,
        "valid_tests",
        rl.suppress_count(F.col("n_21_orhigher"), n, 0.05, 0.95, 10).alias("n_21_orhigher"),
        rl.suppress_count(F.col("n_below19"), n, 0.05, 0.95, 10).alias("n_below19"),
    )


@query
def release_state(spark, sf):
    return rl.release_state(published(spark, sf, "state"))


@query
def release_state_highest(spark, sf):
    cube = files.highest_score_cube(students(spark, sf)).where(F.col("level") == "state")
    return rl.release_state(lb.external_layout(cube), rl.Suppression(rate=True))


@query
def release_district(spark, sf):
    return rl.release_district(published(spark, sf, "district"), t.system_names(spark, sf))


@query
def release_school(spark, sf):
    return rl.release_school(published(spark, sf, "school"), t.school_names(spark, sf), overrides=FORCED)


# ---- side reports ----------------------------------------------------------


@query
def missing_id_report(spark, sf):
    return rp.missing_id_report(t.sites(spark, sf), t.junior_day(spark, sf))


@query
def unmatched_ids(spark, sf):
    path = scratch_path(spark, "highest-records")
    write_records(t.highest_records(spark, sf), path)
    return rp.unmatched_ids(read_fixed_width(spark, path, HIGHEST_LAYOUT))
