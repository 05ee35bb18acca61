"""Counts, averages and rates.

A measure is a 0/1 (or integer) column summed over the rows of a group.  Only
sums are kept until the end, so a group can be built from the sums of its parts
in any order; averages and percentages are formed once, from the final sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import HIGH_COMPOSITE, LOW_COMPOSITE, SCORES, SUBJECTS
from acctcube.functions import flag, is_true, pct, round_even, round_up

FLAGS = [f"n_cr_{s}" for s in [*SUBJECTS, "all"]]
BANDS = ["21_or_higher", "below_19"]


@dataclass(frozen=True)
class Measure:
    """A named row value to be summed.

    ``strict``: one row with a missing value makes the group's sum missing.
    """

    name: str
    value: Column
    strict: bool = False


@dataclass(frozen=True)
class Average:
    """A named mean of ``value`` over the rows where it is not missing.

    ``ungated`` is the same value without the condition on the row, kept beside it
    for subgroups that need both.
    """

    name: str
    value: Column
    ungated: Column | None = None


@dataclass(frozen=True)
class Summary:
    """What to compute for each group."""

    measures: Sequence[Measure]
    averages: Sequence[Average]
    digits: int = 1
    rounding: Callable[[Column, int], Column] = round_even

    def row_columns(self) -> dict[str, Column]:
        """Per row: every column whose plain sum the group needs."""
        cols: dict[str, Column] = {}
        for m in self.measures:
            cols[m.name] = m.value
            if m.strict:
                cols[f"_missing_{m.name}"] = flag(m.value.isNull())
        for a in self.averages:
            cols[f"_sum_{a.name}"] = a.value
            cols[f"_n_{a.name}"] = flag(a.value.isNotNull())
            if a.ungated is not None:
                cols[f"_sum_free_{a.name}"] = a.ungated
                cols[f"_n_free_{a.name}"] = flag(a.ungated.isNotNull())
        return cols

    def column_names(self) -> list[str]:
        names: list[str] = []
        for m in self.measures:
            names += [m.name, f"_missing_{m.name}"] if m.strict else [m.name]
        for a in self.averages:
            names += [f"_sum_{a.name}", f"_n_{a.name}"]
            names += [f"_sum_free_{a.name}", f"_n_free_{a.name}"] if a.ungated is not None else []
        return names

    def ungated_pairs(self) -> list[tuple[str, str]]:
        """(gated sum, ungated sum) column names."""
        names = [a.name for a in self.averages if a.ungated is not None]
        return [(f"_{k}_{n}", f"_{k}_free_{n}") for n in names for k in ("sum", "n")]

    def sums(self, columns: Mapping[str, Column] | None = None) -> list[Column]:
        """Sum aggregates over row values, or over earlier sums when no columns are given."""
        columns = columns or {n: F.col(n) for n in self.column_names()}
        return [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in columns.items()]

    def finish(self, sums: DataFrame) -> DataFrame:
        """Sums to published counts and rounded averages."""
        inner = set(self.column_names())
        groups = [c for c in sums.columns if c not in inner]
        out = [
            self.rounding(F.try_divide(F.col(f"_sum_{a.name}").cast("double"), F.col(f"_n_{a.name}")), self.digits).alias(a.name)
            for a in self.averages
        ]
        out += [
            F.when(F.col(f"_missing_{m.name}") == 0, F.col(m.name)).alias(m.name) if m.strict else F.col(m.name)
            for m in self.measures
        ]
        return sums.select(*groups, *out)

    def by(self, df: DataFrame, *keys: str) -> DataFrame:
        """One row per group; without keys one row even when there are no rows."""
        return self.finish(df.groupBy(*keys).agg(*self.sums(self.row_columns())))


def _gender_bands(high: Column, low: Column, gender: Column) -> list[Measure]:
    bands = {"21_or_higher": high, "below_19": low}
    return [
        Measure(f"n_{name}_{band}", flag((gender == code) & cond))
        for band, cond in bands.items()
        for name, code in (("female", "F"), ("male", "M"))
    ]


def averages(
    columns: Sequence[str] = SCORES, gate: str | None = "composite", keep_ungated: bool = False
) -> list[Average]:
    """Means of scores over the rows that have a composite (``gate=None``: over all rows)."""
    value = lambda c: F.when(F.col(gate).isNotNull(), F.col(c)) if gate else F.col(c)
    return [Average(f"avg_{c}", value(c), F.col(c) if keep_ungated else None) for c in columns]


def score_measures(gender_tests: bool = True) -> list[Measure]:
    """Counts taken straight from the scores of a student table."""
    composite, gender = F.col("composite"), F.col("gender")
    tested = composite.isNotNull()
    high, low = composite >= HIGH_COMPOSITE, composite < LOW_COMPOSITE
    strict = [
        Measure("valid_tests_male", flag((gender == "M") & tested), strict=True),
        Measure("valid_tests_female", flag((gender == "F") & tested), strict=True),
    ]
    return [
        Measure("enrolled", F.lit(1)),
        Measure("tested", flag(tested)),
        Measure("valid_tests", flag(tested)),
        *(strict if gender_tests else []),
        *[Measure(n, F.col(n)) for n in FLAGS],
        Measure("n_21_or_higher", flag(high)),
        Measure("n_below_19", flag(low)),
        *_gender_bands(high, low, gender),
    ]


def indicator_measures() -> list[Measure]:
    """Sums of the 0/1 columns made by ``appeal_indicators``."""
    names = [
        "enrolled",
        "tested",
        "valid_tests",
        "valid_tests_male",
        "valid_tests_female",
        *FLAGS,
        *[f"n_{b}" for b in BANDS],
        *[f"n_{g}_{b}" for b in BANDS for g in ("female", "male")],
    ]
    return [Measure(n, F.col(n)) for n in names]


def missing_gender_measures() -> list[Measure]:
    """Counts that keep students without a gender as a third gender column."""
    composite, gender = F.col("composite"), F.col("gender")
    tested = composite.isNotNull()
    who = {
        "female": is_true(gender == "F"),
        "male": is_true(gender == "M"),
        "gender_missing": is_true(gender == "") | gender.isNull(),
    }
    bands = {"21_or_higher": is_true(composite >= HIGH_COMPOSITE), "below_19": is_true(composite < LOW_COMPOSITE)}
    return [
        Measure("enrolled", F.lit(1)),
        Measure("tested", flag(tested)),
        Measure("valid_tests", flag(tested)),
        *[Measure(n, F.col(n)) for n in FLAGS],
        *[Measure(f"n_{b}", flag(c)) for b, c in bands.items()],
        *[Measure(f"n_{g}_{b}", flag(w & c)) for b, c in bands.items() for g, w in who.items()],
        *[Measure(f"n_{g}", flag(w & tested)) for g, w in who.items()],
    ]


def _rates(df: DataFrame, pairs: Iterable[tuple[str, str, str, int]], rounding) -> DataFrame:
    return df.withColumns({out: rounding(pct(F.col(n), F.col(d)), k) for out, n, d, k in pairs})


def rates(df: DataFrame) -> DataFrame:
    """Percentages of valid tests; gender percentages of that gender's valid tests."""
    pairs = [(f"pct_{x[2:]}", x, "valid_tests", 1) for x in FLAGS]
    pairs += [(f"pct_{b}", f"n_{b}", "valid_tests", 1) for b in BANDS]
    pairs += [
        (f"pct_{g}_{b}", f"n_{g}_{b}", f"valid_tests_{g}", 1) for b in BANDS for g in ("female", "male")
    ]
    pairs.append(("participation_rate", "tested", "enrolled", 0))
    return _rates(df, pairs, round_even)


def rates_suppressed(df: DataFrame, minimum: int = 30) -> DataFrame:
    """Every ``n_`` count as a percentage of all valid tests, missing below a minimum."""
    counts = [c for c in df.columns if c.startswith("n_")]
    enough = F.col("valid_tests") >= minimum
    return df.withColumns(
        {
            **{
                f"pct_{c[2:]}": F.when(enough, round_even(pct(F.col(c), F.col("valid_tests")), 1))
                for c in counts
            },
            "participation_rate": F.when(
                F.col("enrolled") >= minimum, round_even(pct(F.col("tested"), F.col("enrolled")), 0)
            ),
        }
    )


def rates_missing_gender(df: DataFrame) -> DataFrame:
    """Half-up percentages with a missing-gender column; the gender counts are dropped at the end."""
    who = ("female", "male", "gender_missing")
    pairs = [(f"pct_{x[2:]}", x, "valid_tests", 1) for x in FLAGS]
    for b in BANDS:
        pairs.append((f"pct_{b}", f"n_{b}", "valid_tests", 1))
        pairs += [(f"pct_{g}_{b}", f"n_{g}_{b}", f"n_{g}", 1) for g in who]
    pairs.append(("participation_rate", "tested", "enrolled", 0))
    return _rates(df, pairs, round_up).drop(*[f"n_{g}" for g in who])


def score_summary() -> Summary:
    return Summary(score_measures(), averages())


def indicator_summary(keep_ungated: bool = False) -> Summary:
    return Summary(indicator_measures(), averages(keep_ungated=keep_ungated))


def missing_gender_summary() -> Summary:
    return Summary(missing_gender_measures(), averages(), rounding=round_up)


def suppressed_summary() -> Summary:
    """The 2016 file: four means, over every row that has the score."""
    return Summary(
        score_measures(gender_tests=False), averages(["english", "math", "science", "composite"], gate=None)
    )
