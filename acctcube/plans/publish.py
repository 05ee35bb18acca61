"""Everything the post-appeals run gives out, from one pass over the attempts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from acctcube.operators.cohort import student_level
from acctcube.operators.labels import external_layout, label_names
from acctcube.operators.release import release_district, release_school, release_state
from acctcube.plans.files import post_appeals_cube, post_appeals_students, student_file
from acctcube.sources import write_csv
from acctcube.sources.store import Commits

#: The outputs of a run and their row order; tables are Parquet, the others CSV.
TABLES = ("students", "cube")
ORDERS = {
    "student_file": ("system", "school", "state_stud_id"),
    "base_file": ("system", "school", "subgroup"),
    "release_state": ("Subgroup",),
    "release_district": ("District", "Subgroup"),
    "release_school": ("District", "School", "Subgroup"),
}


def published(spark: SparkSession, out: str, run: int | None = None) -> Mapping[str, str]:
    """The paths of the outputs of the last run below ``out``, or of run number ``run``."""
    commits = Commits(spark, out)
    number = commits.last() if run is None else run
    if not number:
        raise FileNotFoundError(f"no run was published below {out}")
    return {name: commits.store.at(folder) for name, folder in commits.load(number)["outputs"].items()}


def publish(
    cohort: DataFrame,
    attempts: DataFrame,
    appeals: DataFrame,
    school_names: DataFrame,
    system_names: DataFrame,
    out: str,
    mode: str = "overwrite",
    stamp: str = "",
    keep: int = 2,
) -> Mapping[str, str]:
    """Write the student file, the base file and the three releases below ``out``.

    All outputs of a run go to a new folder and count together from the moment its commit appears
    (``sources.store``): ``published`` gives the outputs of one run, never of two, and a run that
    fails at any output leaves the last one as it was. The last ``keep`` runs stay;
    ``mode="error"`` refuses a second run before anything is written. CSV files are
    sorted by the keys of ORDERS over all their parts. ``stamp`` is put after the names of the
    outputs, for the day of the run; nothing here reads a clock.

    The student table and the cube are landed as tables before they are read again:
    the attempts are shuffled once for all outputs, and a lost executor costs a
    re-read, not a recomputation of the joins.
    """
    commits = Commits(cohort.sparkSession, out)
    before, folder = commits.last(), commits.new_folder()
    if mode == "error" and before:
        raise FileExistsError(f"{out} holds run {before}")
    outputs = {n: f"{folder}/{n}_{stamp}" if stamp else f"{folder}/{n}" for n in (*TABLES, *ORDERS)}
    paths = {n: commits.store.at(f) for n, f in outputs.items()}

    def table(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(paths[name])
        return df.sparkSession.read.schema(df.schema).parquet(paths[name])

    def file(df: DataFrame, name: str) -> None:
        write_csv(df, paths[name], order=ORDERS[name])

    students = table(post_appeals_students(student_level(cohort, attempts), appeals), "students")
    file(student_file(students), "student_file")

    cube = table(post_appeals_cube(students), "cube")
    file(label_names(cube.drop("level"), school_names), "base_file")

    def level(name: str) -> DataFrame:
        return external_layout(cube.where(F.col("level") == name))

    file(release_state(level("state")), "release_state")
    file(release_district(level("district"), system_names), "release_district")
    file(release_school(level("school"), school_names), "release_school")

    commits.commit(before, {"folders": [folder], "outputs": outputs, "stamp": stamp})
    commits.keep(keep)
    return paths
