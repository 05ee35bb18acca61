"""The SQL each registered query must agree with, run on the same tables.

Views are plain SQL restatements of ``suite.tables``; aggregates are written as one
filter and one GROUP BY per subgroup and level, not as the cube the library uses.
"""

from __future__ import annotations

from acctcube.fixed_values import (
    ACCOUNTABILITY_SUBGROUPS,
    BENCHMARKS,
    EXTERNAL_COLUMNS,
    EXTERNAL_SUBGROUPS,
    HIGHEST_LAYOUT,
    RACE_LABELS,
    RELEASE_COLUMNS,
    SCHOOL_NAMES_FORCED,
    SCHOOL_NAMES_IF_MISSING,
    SCORES,
    STATE_NAME,
    SUBJECTS,
)

FLAGS = [f"n_cr_{s}" for s in [*SUBJECTS, "all"]]
BANDS = ["21_or_higher", "below_19"]


# ---- small SQL builders ----------------------------------------------------


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def even1(x: str) -> str:
    """One digit, exact ties to even, in whole multiples of 2**-56, which hold every stored fraction near a tie."""
    tenth = f"cast(({x} - floor({x})) * {2.0**56:.1f} as hugeint) * 10"
    down, rest = f"({tenth} // {2**56})", f"({tenth} % {2**56})"
    up = f"({rest} > {2**55} or ({rest} = {2**55} and {down} % 2 = 1))"
    return f"(floor({x}) * 10 + cast({down} as double) + case when {up} then 1.0 else 0.0 end) / 10"


def even0(x: str) -> str:
    return f"round_even({x}, 0)"


def pct_sql(a: str, b: str) -> str:
    return f"(cast(100 * {a} as double) / nullif({b}, 0))"


def case_map(x: str, pairs: dict[str, str], default: str = "null") -> str:
    whens = " ".join(f"when {x} = {q(k)} then {q(v)}" for k, v in pairs.items())
    return f"case {whens} else {default} end"


def date_code(x: str) -> str:
    t = f"cast({x} as varchar)"
    month = f"case when {x} > 999 then substr({t}, 1, 2) else '0' || substr({t}, 1, 1) end"
    year = f"case when {x} > 999 then substr({t}, 3, 2) else substr({t}, 2, 2) end"
    return f"cast(try_strptime('20' || ({year}) || ({month}) || '01', '%Y%m%d') as date)"


def flags_sql(mode: str, thresholds: dict[str, int] = BENCHMARKS) -> str:
    met = {f"n_cr_{s}": f"({s} >= {n})" for s, n in thresholds.items()}
    met["n_cr_all"] = "(" + " and ".join(met.values()) + ")"
    wrap = {
        "gated": "case when composite is not null then cast({c} as int) end",
        "ungated": "cast({c} as int)",
        "zero": "cast(coalesce({c}, false) as int)",
    }[mode]
    return ", ".join(wrap.format(c=c) + f" as {n}" for n, c in met.items())


# ---- views -----------------------------------------------------------------

_SHIP_CODE = "cast(extract(month from l_shipdate) * 100 + extract(year from l_shipdate) % 100 as int)"
_ORDER = ", ".join(
    f"{c} desc nulls last" for c in ["composite", "math", "reading", "english", "science", "test_date"]
)
_ALT_ORDER = ", ".join(f"{c} desc nulls last" for c in ["composite", "english", "math", "reading", "science"])


def _cells() -> str:
    """The highest-score record, field by field, padded to byte widths."""
    ymd = "cast(extract(year from l_shipdate) * 10000 + extract(month from l_shipdate) * 100 + 27 + l_linenumber as varchar)"
    return f"""select 'First' || l_partkey as first, 'Läst' || l_suppkey as last, l_returnflag as mi, {ymd} as dob,
      case when l_tax = 0.08 then null when l_tax = 0.07 then null else l_orderkey end as id,
      strftime(l_shipdate, '%m%Y') as test_date, cast(l_orderkey as varchar) as id2,
      cast(1 + l_partkey % 36 as double) as english, cast(1 + l_suppkey % 36 as double) as math,
      case when l_linenumber <> 3 then cast(1 + l_linenumber as double) end as reading,
      cast(null as double) as science, cast(cast(l_quantity as int) as double) as composite
    from lineitem"""


VIEWS: dict[str, str] = {
    "att": f"""select l_orderkey as student_id,
      cast(1 + l_partkey % 36 as int) as english,
      cast(1 + l_suppkey % 36 as int) as math,
      cast(1 + (l_partkey + l_suppkey) % 36 as int) as reading,
      cast(1 + (l_partkey * 7 + l_suppkey) % 36 as int) as science,
      case when l_returnflag = 'N' and l_linestatus = 'F' then null
           else cast(1 + (cast(l_quantity as int) * 7 + l_partkey) % 36 as int) end as composite,
      {_SHIP_CODE} as test_date,
      concat(l_returnflag, l_linestatus) as file,
      case when l_tax = 0.08 then 'M' when l_tax = 0.0 then null else 'S' end as test_location
    from lineitem""",
    "dec": f"select * replace ({date_code('test_date')} as test_date) from att",
    "coh": """select o_orderkey as student_key,
      cast(c_nationkey + 1 as int) as system,
      cast(1 + o_custkey % 7 as int) as school,
      case when o_orderkey % 101 = 0 then null when o_orderkey % 2 = 0 then 'F' else 'M' end as gender,
      case when o_orderkey % 89 = 0 then null when c_mktsegment = 'AUTOMOBILE' then 'A' when c_mktsegment = 'BUILDING' then 'B'
           when c_mktsegment = 'FURNITURE' then 'H' when c_mktsegment = 'HOUSEHOLD' then 'I' else 'W' end as race_ethnicity,
      case when o_orderstatus = 'F' then 'Y' else 'N' end as econ_dis,
      case when o_orderpriority = '5-LOW' then 'Y' else 'N' end as el,
      case when o_orderpriority = '1-URGENT' then 'Y' when o_orderkey % 97 = 0 then null else 'N' end as swd,
      case when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then 'N' else 'Y' end as included_in_cohort,
      case when o_orderkey % 13 = 0 then 2 else 1 end as completion_type
    from orders join customer on o_custkey = c_custkey""",
    "kept": "select * from coh where included_in_cohort = 'Y' and completion_type = 1",
    "trk": """select case when o_orderpriority <> '4-NOT SPECIFIED' or o_orderkey % 11 = 0 then o_orderkey end as student_id,
      case when o_orderkey % 11 = 0 then 'Approved' else 'Denied' end as status,
      cast(1 + o_custkey % 35 as int) as act_english_highest,
      cast(1 + o_custkey % 34 as int) as act_math_highest,
      case when o_orderkey % 4 = 0 then null else cast(1 + o_custkey % 33 as int) end as act_reading_highest,
      cast(1 + o_custkey % 32 as int) as act_science_highest,
      case when o_orderkey % 5 = 0 then null else cast(1 + o_custkey % 36 as int) end as act_composite_highest,
      case when o_orderkey % 3 = 0 then cast(400 + (o_custkey * 13) % 1201 as int) end as sat_total
    from orders""",
    "app": "select student_id as student_key, * exclude (student_id, status) from trk where student_id is not null and status = 'Approved'",
    "bst": f"""select * exclude (rn) from (select * exclude (test_location), row_number() over (partition by student_id
      order by {_ORDER}, file asc nulls last) as rn from dec) where rn = 1""",
    "alt": f"""select student_id, {', '.join(SCORES)} from (select *, row_number() over (partition by student_id
      order by {_ALT_ORDER}) as rn from att) where rn = 1""",
    "stu": f"""select k.*, b.test_date, {', '.join(f'case when composite is not null then {c} end as {c}' for c in [*SUBJECTS, 'file'])},
      composite, {flags_sql('gated')}
      from kept k left join bst b on k.student_key = b.student_id""",
    # appeals, case by case
    "apm": f"""select s.* exclude ({', '.join(SCORES)}), {', '.join(
        f'''case when act_composite_highest is null then coalesce({s}, act_{s}_highest)
          when composite is null then act_{s}_highest
          when act_composite_highest > composite then act_{s}_highest
          else coalesce({s}, act_{s}_highest) end as {s}''' for s in SUBJECTS)},
      case when composite is null then act_composite_highest
           when act_composite_highest > composite then act_composite_highest else composite end as composite,
      a.* exclude (student_key)
      from stu s left join app a on s.student_key = a.student_key""",
    "ind0": f"""select * exclude ({', '.join(FLAGS)}), {flags_sql('ungated')}, 1 as enrolled,
      case when composite is not null or sat_total is not null then 1 else 0 end as tested,
      case when composite is not null then cast(composite >= 21 as int)
           when sat_total is not null then cast(sat_total >= 1060 as int) else 0 end as n_21_or_higher,
      case when composite is not null then cast(composite < 19 as int)
           when sat_total is not null then cast(sat_total < 980 as int) else 0 end as n_below_19
      from apm""",
    "ind": """select *, tested as valid_tests,
      cast(tested = 1 and gender = 'F' as int) as valid_tests_female,
      cast(tested = 1 and gender = 'M' as int) as valid_tests_male,
      cast(gender = 'F' and n_21_or_higher = 1 as int) as n_female_21_or_higher,
      cast(gender = 'M' and n_21_or_higher = 1 as int) as n_male_21_or_higher,
      cast(gender = 'F' and n_below_19 = 1 as int) as n_female_below_19,
      cast(gender = 'M' and n_below_19 = 1 as int) as n_male_below_19
      from ind0""",
    "fnn": "select student_id, " + ", ".join(
        f"first({c} order by {_ALT_ORDER}) filter (where {c} is not null) as {c}" for c in SCORES
    ) + " from att where test_location is distinct from 'M' group by student_id",
    "xw": """select student_id, case when reading > 12 then english end as english, case when science > 12 then math end as math,
      case when file <> 'RF' then reading end as reading, case when english > 3 then science end as science,
      case when math > 18 then composite end as composite from att""",
    "alt_xw": f"""select student_id, {', '.join(SCORES)} from (select *, row_number() over (partition by student_id
      order by {_ALT_ORDER}) as rn from xw) where rn = 1""",
    "fil0": f"""select k.*, {', '.join(f'coalesce(x.{c}, d.{c}) as {c}' for c in SCORES)}
      from kept k left join alt_xw x on k.student_key = x.student_id left join fnn d on k.student_key = d.student_id""",
    "fil": f"select *, {flags_sql('zero')} from fil0",
    "xsys": "select cast(n_nationkey + 1 as int) as system, n_name as system_name from nation where n_nationkey % 6 <> 0",
    "xsch": """select system, school, system_name, case when school <> 5 then 'School ' || school end as school_name
      from (select distinct c_nationkey, cast(1 + c_custkey % 7 as int) as school from customer)
      join xsys on c_nationkey + 1 = system""",
    "xreg": """select cast(n_nationkey + 1 as int) as system, n_name as system_name,
      case when r_name = 'ASIA' then '' else r_name end as region
      from nation join region on n_regionkey = r_regionkey""",
    "site": """select case when n_nationkey = 3 then null else cast(n_nationkey as varchar) end as org_code,
      case when n_nationkey = 4 then cast(n_nationkey + 1 as varchar)
           else concat(cast(n_nationkey + 1 as varchar), ' ', cast(n_nationkey % 7 + 1 as varchar)) end as local_site_code
      from nation""",
    "jday": """select c_nationkey as acthscode, case when o_orderkey % 10 = 0 then null else o_orderkey end as state_stud_id
      from orders join customer on o_custkey = c_custkey""",
    "mat": f"""select l_orderkey as usid,
      case when l_linenumber = 1 then null when l_linenumber = 2 then l_orderkey + 1 else l_orderkey end as unique_student_id,
      {_SHIP_CODE} as act_testdate,
      cast(1 + l_partkey % 36 as int) as act_english_highest,
      cast(1 + l_suppkey % 36 as int) as act_math_highest,
      cast(1 + (l_partkey * 3 + l_suppkey) % 36 as int) as act_reading_highest,
      cast(1 + (l_partkey * 5 + l_suppkey) % 36 as int) as act_science_highest,
      cast(1 + cast(trunc(l_extendedprice) as bigint) % 36 as int) as act_composite_highest
      from lineitem""",
    "fwh": _cells(),
    # missing keys on both sides
    "kpm": "select * replace (case when student_key % 3 <> 0 then student_key end as student_key) from kept",
    "dcm": "select * replace (case when student_id % 10 <> 3 then student_id end as student_id) from dec",
    "apn": "select * replace (case when student_key <> 33 then student_key end as student_key) from app",
}
_NULL_SAFE = {"kept k": "kpm k", "bst b": "bsm b", "dec)": "dcm)", "stu s": "stm s", "app a": "apn a", "student_key = ": "student_key is not distinct from "}


def _null_safe(view: str) -> str:
    """A view over the tables with missing keys, which match."""
    text = VIEWS[view]
    for plain, other in _NULL_SAFE.items():
        text = text.replace(plain, other)
    return text


VIEWS |= {"bsm": _null_safe("bst"), "stm": _null_safe("stu"), "apg": _null_safe("apm")}
NEEDS: dict[str, list[str]] = {
    "dec": ["att"],
    "kept": ["coh"],
    "app": ["trk"],
    "bst": ["dec"],
    "alt": ["att"],
    "xw": ["att"],
    "alt_xw": ["xw"],
    "fnn": ["att"],
    "stu": ["kept", "bst"],
    "apm": ["stu", "app"],
    "ind0": ["apm"],
    "ind": ["ind0"],
    "fil0": ["kept", "alt_xw", "fnn"],
    "fil": ["fil0"],
    "xsch": ["xsys"],
    "kpm": ["kept"],
    "dcm": ["dec"],
    "apn": ["app"],
    "bsm": ["dcm"],
    "stm": ["kpm", "bsm"],
    "apg": ["stm", "apn"],
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the views it names, in dependency order, then ``extra`` ones."""
    order: dict[str, str] = {}

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        order.setdefault(name, VIEWS[name])

    for name in names:
        add(name)
    order.update(extra or {})
    ctes = ",\n".join(f"{n} as materialized ({s})" for n, s in order.items())
    return f"with {ctes}\n{body}" if ctes else body


# ---- measures --------------------------------------------------------------


def _n(cond: str) -> str:
    return f"cast(count(*) filter (where {cond}) as bigint)"


def _sum(x: str) -> str:
    return f"cast(coalesce(sum({x}), 0) as bigint)"


def strict_sql() -> dict[str, str]:
    out = {}
    for name, code in (("male", "M"), ("female", "F")):
        cond = f"(gender = '{code}' and composite is not null)"
        out[f"valid_tests_{name}"] = (
            f"case when count(*) filter (where {cond} is null) > 0 then null else {_n(cond)} end"
        )
    return out


def score_sql(gender_tests: bool = True) -> dict[str, str]:
    cols = {"enrolled": "count(*)", "tested": "count(composite)", "valid_tests": "count(composite)"}
    if gender_tests:
        cols |= strict_sql()
    cols |= {f: _sum(f) for f in FLAGS}
    cols |= {"n_21_or_higher": _n("composite >= 21"), "n_below_19": _n("composite < 19")}
    for name, code in (("female", "F"), ("male", "M")):
        cols[f"n_{name}_21_or_higher"] = _n(f"gender = '{code}' and composite >= 21")
        cols[f"n_{name}_below_19"] = _n(f"gender = '{code}' and composite < 19")
    return cols


def indicator_sql() -> dict[str, str]:
    names = ["enrolled", "tested", "valid_tests", "valid_tests_male", "valid_tests_female", *FLAGS]
    names += [f"n_{b}" for b in BANDS] + [f"n_{g}_{b}" for b in BANDS for g in ("female", "male")]
    return {n: _sum(n) for n in names}


def gender_missing_sql() -> dict[str, str]:
    cols = {"enrolled": "count(*)", "tested": "count(composite)", "valid_tests": "count(composite)"}
    cols |= {f: _sum(f) for f in FLAGS}
    who = {"female": "gender = 'F'", "male": "gender = 'M'", "gender_missing": "(gender is null or gender = '')"}
    for b, c in (("21_or_higher", "composite >= 21"), ("below_19", "composite < 19")):
        cols[f"n_{b}"] = _n(c)
        cols |= {f"n_{g}_{b}": _n(f"{w} and {c}") for g, w in who.items()}
    cols |= {f"n_{g}": _n(f"{w} and composite is not null") for g, w in who.items()}
    return cols


def avg_sql(columns=SCORES, where: str | None = "composite is not null") -> dict[str, str]:
    cond = f" filter (where {where})" if where else ""
    return {f"avg_{c}": f"avg({c}){cond}" for c in columns}


def select_list(cols: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in cols.items())


def group_sql(cols: dict[str, str], source: str, keys: list[str], where: str = "true") -> str:
    ks = ", ".join(keys)
    return (
        f"select {ks + ', ' if keys else ''}{select_list(cols)} from {source} where {where}"
        + (f" group by {ks}" if keys else "")
    )


def rounded(source: str, digits: str = "even") -> str:
    """Round the averages of a grouped query."""
    fn = even1 if digits == "even" else (lambda x: f"round({x}, 1)")
    return f"select * replace ({', '.join(f'{fn(c)} as {c}' for c in AVGS)}) from ({source})"


AVGS = [f"avg_{c}" for c in SCORES]
SUBGROUP_SQL = {
    "All Students": "true",
    "Black/Hispanic/Native American": "race_ethnicity in ('B', 'H', 'I')",
    "Economically Disadvantaged": "econ_dis = 'Y'",
    "Non-Economically Disadvantaged": "econ_dis = 'N'",
    "English Learners": "el = 'Y'",
    "Non-English Learners": "el = 'N'",
    "Students with Disabilities": "swd = 'Y'",
    "Non-Students with Disabilities": "swd = 'N'",
    "Super Subgroup": "(race_ethnicity in ('B', 'H', 'I') or econ_dis = 'Y' or el = 'Y' or swd = 'Y')",
}
LEVEL_KEYS = {"school": ["system", "school"], "district": ["system"], "state": []}


def cube_sql(
    cols: dict[str, str],
    avgs: dict[str, str],
    source: str,
    levels=("school", "district", "state"),
    subgroups=SUBGROUP_SQL,
    race: bool = True,
    loose_super: bool = False,
) -> str:
    """One filter and one aggregate per subgroup and level, stacked."""
    parts = []

    def key(k: str, keys: list[str]) -> str:
        return k if k in keys else "0"

    for level in levels:
        keys = LEVEL_KEYS[level]
        head = f"{q(level)} as level, {key('system', keys)} as system, {key('school', keys)} as school"
        for label, where in subgroups.items():
            means = avgs
            if loose_super and label == "Super Subgroup":
                loose = "econ_dis = 'Y' or el = 'Y' or swd = 'Y' or (race_ethnicity in ('B', 'H', 'I') and composite is not null)"
                means = avg_sql(where=loose)
            parts.append(
                f"select {head}, {q(label)} as subgroup, {select_list(means | cols)} from {source} where {where}"
                + (f" group by {', '.join(keys)}" if keys else "")
            )
        if race:
            label = case_map("race_ethnicity", RACE_LABELS)
            parts.append(
                f"select {head}, {label} as subgroup, {select_list(avgs | cols)} from {source}"
                f" where race_ethnicity is not null group by {', '.join([*keys, 'race_ethnicity'])}"
            )
    stacked = "\nunion all\n".join(parts)
    return f"select * replace ({', '.join(f'{even1(a)} as {a}' for a in avgs)}) from ({stacked})" if avgs else stacked


def rates_sql(source: str) -> str:
    pairs = {f"pct_{f[2:]}": (f, "valid_tests") for f in FLAGS}
    pairs |= {f"pct_{b}": (f"n_{b}", "valid_tests") for b in BANDS}
    pairs |= {f"pct_{g}_{b}": (f"n_{g}_{b}", f"valid_tests_{g}") for b in BANDS for g in ("female", "male")}
    raw = ", ".join(f"{pct_sql(a, b)} as {n}" for n, (a, b) in pairs.items())
    done = ", ".join(f"{even1(n)} as {n}" for n in pairs)
    return (
        f"select * replace ({done}, {even0('participation_rate')} as participation_rate) from "
        f"(select *, {raw}, {pct_sql('tested', 'enrolled')} as participation_rate from ({source}))"
    )


def suppressed_sql(source: str) -> str:
    counts = [*FLAGS, *[f"n_{b}" for b in BANDS], *[f"n_{g}_{b}" for b in BANDS for g in ("female", "male")]]
    raw = ", ".join(f"{pct_sql(c, 'valid_tests')} as pct_{c[2:]}" for c in counts)
    done = ", ".join(f"case when valid_tests >= 30 then {even1('pct_' + c[2:])} end as pct_{c[2:]}" for c in counts)
    return (
        f"select * replace ({done}, case when enrolled >= 30 then {even0('participation_rate')} end as participation_rate)"
        f" from (select *, {raw}, {pct_sql('tested', 'enrolled')} as participation_rate from ({source}))"
    )


def gender_missing_rates_sql(source: str) -> str:
    who = ("female", "male", "gender_missing")
    pairs = {f"pct_{f[2:]}": (f, "valid_tests") for f in FLAGS}
    for b in BANDS:
        pairs[f"pct_{b}"] = (f"n_{b}", "valid_tests")
        pairs |= {f"pct_{g}_{b}": (f"n_{g}_{b}", f"n_{g}") for g in who}
    out = ", ".join(f"round({pct_sql(a, b)}, 1) as {n}" for n, (a, b) in pairs.items())
    return (
        f"select * exclude ({', '.join(f'n_{g}' for g in who)}), {out}, "
        f"round({pct_sql('tested', 'enrolled')}, 0) as participation_rate, 'All Students' as subgroup from ({source})"
    )


def relabel_sql(x: str = "subgroup") -> str:
    return case_map(x, EXTERNAL_SUBGROUPS, x)


def post_cube() -> str:
    return rates_sql(cube_sql(indicator_sql(), avg_sql(), "ind"))


def external_sql(source: str, columns: list[str]) -> str:
    names = ", ".join(f"{c} as {EXTERNAL_COLUMNS.get(c, c)}" for c in columns)
    return f"select {names} from {source}"


CUBE_COLUMNS = [
    "system",
    "school",
    "subgroup",
    *AVGS,
    *indicator_sql(),
    *[f"pct_{f[2:]}" for f in FLAGS],
    *[f"pct_{b}" for b in BANDS],
    *[f"pct_{g}_{b}" for b in BANDS for g in ("female", "male")],
    "participation_rate",
]


def own_views(level: str) -> dict[str, str]:
    """Our rows of one level in the external vocabulary, the published layout, and the other maker's table."""
    shifted = "case when system % 3 = 0 then act_composite_avg + 0.2 else act_composite_avg end"
    return {
        "cube": post_cube(),
        "own": f"select * exclude (level) replace ({relabel_sql()} as subgroup) from cube where level = {q(level)}",
        "pub": external_sql("own", CUBE_COLUMNS),
        "oth": f"select * replace ({shifted} as act_composite_avg) from pub where system % 5 <> 0",
    }


# ---- release ---------------------------------------------------------------


def text_sql(x: str) -> str:
    return f"regexp_replace(cast({x} as varchar), '\\.0$', '')"


def hide_sql(x: str, low: float, high: float, minimum: int, tests: str) -> str:
    return (
        f"case when {tests} is null then null when {tests} < {minimum} then '*' when {x} is null then null"
        f" when {x} > {high} or {x} < {low} then '**' else {text_sql(x)} end"
    )


def hide_count_sql(x: str, low: float, high: float, minimum: int, tests: str) -> str:
    share = f"(cast({x} as double) / nullif({tests}, 0))"
    return (
        f"case when {tests} is null then null when {tests} < {minimum} then '*' when {share} is null then null"
        f" when {share} < {low} or {share} > {high} then '**' else cast({x} as varchar) end"
    )


def release_sql(
    keys: dict[str, str], source: str, low: float, high: float, minimum: int = 10,
    rate: bool = False, counts: bool = False, numbers: bool = False, hide: bool = True, where: str = "true",
) -> str:
    cols = []
    for old, new in RELEASE_COLUMNS.items():
        if new.startswith("Number") and not numbers:
            continue
        expr = old
        if hide:
            if new.startswith(("Average", "Percent")) or (rate and new == "Participation Rate"):
                expr = hide_sql(old, low, high, minimum, "valid_tests")
            elif new.startswith("Number") and counts:
                expr = hide_count_sql(old, low / 100, high / 100, minimum, "valid_tests")
        cols.append(f'{expr} as "{new}"')
    head = ", ".join(f'{e} as "{n}"' for n, e in keys.items())
    return f"select {head}, {', '.join(cols)} from {source} where {where}"


IN_SUBGROUPS = "subgroup in (" + ", ".join(q(s) for s in ACCOUNTABILITY_SUBGROUPS) + ")"


def named_case(pairs: dict[tuple[int, int], str], default: str) -> str:
    whens = " ".join(f"when system = {s} and school = {k} then {q(n)}" for (s, k), n in pairs.items())
    return f"case {whens} else {default} end"


IF_MISSING = {**SCHOOL_NAMES_IF_MISSING, (4, 5): "North Academy", (13, 5): "River School"}
FORCED = {**SCHOOL_NAMES_FORCED, (3, 2): "Hill School", (9, 5): "Lake School"}


def what_if_sql(system: int = 7) -> str:
    own = """select student_id, english, math, reading, science, composite from (select *, row_number() over (
      partition by student_id order by composite desc nulls last, math desc nulls last, reading desc nulls last,
      english desc nulls last, science desc nulls last) as rn from (
      select student_id, math as english, english as math, science as reading, reading as science, reading as composite from att)) where rn = 1"""
    rep = f"""select s.* exclude ({', '.join([*SCORES, *FLAGS])}), {', '.join(f's.{c} as was_{c}, coalesce(o.{c}, s.{c}) as {c}' for c in SCORES)}
      from stu s left join own o on s.student_key = o.student_id where s.system = {system}"""
    means = {f"avg_{c}": f"avg(was_{c}) filter (where was_composite is not null)" for c in SCORES}
    new = rates_sql(rounded(group_sql(means | score_sql(), "flg", [])))
    cols = [c for c in CUBE_COLUMNS if c not in ("system", "school", "subgroup")]
    old = rates_sql(rounded(group_sql(avg_sql() | score_sql(), "stu", ["system"], f"system = {system}")))
    body = f"""{external_sql('new', cols)[:-len(' from new')]}, {system} as system, 'ACT' as subject, '9th through 12th' as grade, 'All Students' as subgroup from new
      union all by name {external_sql('old', cols)[:-len(' from old')]}, system, null as subject, null as grade, 'All Students' as subgroup from old"""
    return with_views(
        body, "att", "stu",
        extra={"own": own, "rep": rep, "flg": f"select *, {flags_sql('ungated')} from rep", "new": new, "old": old},
    )


NAMES = ["first_name", "last_name"]
NAMED = """select *, case when science > 9 then 'Last' || math end as last_name,
  case when reading > 12 then 'First' || english end as first_name from att where test_location is distinct from 'M'"""


def first_sql(columns: list[str], order: str) -> str:
    """The first value that is not missing of each column, of equal places the largest."""
    firsts = [f"first({c} order by {order}, {c} desc) filter (where {c} is not null) as {c}" for c in columns]
    return f"select student_id, {', '.join(firsts)} from nam group by student_id"


def oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    coh = with_views("select * from coh", "coh")
    o["src_csv"] = o["src_parquet"] = o["sink_split_by_key"] = coh
    o["src_fixed_width"] = """select l_orderkey as id,
      case when l_partkey % 17 = 0 then null else cast(1 + l_partkey % 36 as int) end as english,
      cast(1 + l_suppkey % 36 as int) as math, strftime(l_shipdate, '%Y%m%d') as date from lineitem"""
    o["src_fixed_width_retake"] = f"""select cast(extract(year from l_shipdate) % 100 as double) as year,
      'Läst' || l_suppkey as last, 'First' || l_partkey as first,
      case when l_linenumber <> 2 then l_returnflag else '' end as middle, l_partkey || ' Main Street' as address,
      case when l_linenumber % 2 = 0 then 'F' else 'M' end as gender,
      case when l_linenumber > 3 then cast(12 as double) end as grade, cast(l_partkey as double) as act_id,
      cast(strftime(l_shipdate, '%y%m%d') as double) as dob, 'Somewhere' as city, cast(l_suppkey as double) as zip,
      cast(l_orderkey as double) as state_id, cast(l_suppkey as double) as act_hs_code,
      cast({_SHIP_CODE} as double) as test_date, cast(1 + l_partkey % 36 as varchar) as english,
      cast(1 + l_suppkey % 36 as varchar) as math, cast(1 + l_orderkey % 36 as varchar) as reading, '--' as science,
      case when l_linestatus = 'F' then cast(1 + l_linenumber % 36 as varchar) else '' end as composite from lineitem"""
    o["sink_csv"] = with_views("select * from att", "att")
    o["sink_spreadsheet_csv"] = with_views("select * from trk", "trk")

    o["src_fixed_width_latin"] = """select trim(substr(v, 1, 10)) as last, trim(substr(v, 11, 10)) as first,
      try_cast(trim(substr(v, 21, 2)) as int) as score, trim(substr(v, 23, 4)) as code,
      case when trim(v) = '' then 'blank' when length(v) < 26 then 'short' when length(v) > 26 then 'long' else 'ok' end as record_status
      from (select case l_linenumber when 2 then substr(w, 1, 21) when 3 then substr(w, 1, 15) when 4 then w || 'é2'
          when 5 then repeat(' ', 26) when 6 then '' else w end as v
        from (select l_linenumber, rpad('Läst' || l_suppkey, 10, ' ') || rpad('Né' || l_partkey % 1000, 10, ' ')
          || lpad(cast(1 + l_partkey % 36 as varchar), 2, ' ') || lpad(cast(l_suppkey % 97 as varchar), 4, 'ö') as w from lineitem))"""
    o["src_csv_rejects"] = with_views(
        """select 'math' as column_name, math || '*' as raw from att where math > 33
        union all select 'english', 'n/a' from att where english = 7
        union all select 'kept', concat_ws('/', student_id, case when english not in (7, 8) then english end,
          case when math <= 33 then math end, file) from att""", "att")
    o["save_replace"] = with_views("select * replace (school * 10 as school), 2 as saved from kept", "kept")
    o["sink_named_files"] = with_views("select *, 'cohort_' || system || '.csv' as file from coh", "coh")
    o["sink_ordered_csv"] = with_views(
        "select *, row_number() over (order by avg_composite desc nulls last, system nulls last, school nulls last) - 1 as position"
        f" from ({rounded(group_sql(avg_sql() | score_sql(), 'stu', ['system', 'school']))})", "stu")

    o["cohort_filter"] = with_views("select * from kept", "kept")
    o["exclude_location_r"] = with_views("select * from att where test_location <> 'M'", "att")
    o["exclude_location_stata"] = with_views("select * from att where test_location <> 'M' or test_location is null", "att")
    o["in_set_null_false"] = with_views(
        """select student_key, case when race_ethnicity in ('B', 'H', 'I') then 1 else 0 end as bhn,
        case when race_ethnicity in ('B', 'H', 'I') then 0 else 1 end as not_bhn from coh""", "coh")
    o["id_mismatch_filter"] = with_views(
        "select * from mat where unique_student_id is null or usid <> unique_student_id", "mat")
    o["ifelse_null_condition"] = with_views(
        """select student_id, composite, math, case when composite is null then null when composite >= 21 then math else 0 end
        as math_if_high from att""", "att")
    o["race_label_map"] = with_views(
        f"""select student_key, race_ethnicity, {case_map('race_ethnicity', {k: v for k, v in RACE_LABELS.items() if k != 'W'})}
        as race_label from coh""", "coh")
    o["project_release_columns"] = with_views(
        release_sql({"District": "system", "School": "school", "Subgroup": "subgroup"}, "pub", 0, 0, numbers=True, hide=False),
        "ind", extra=own_views("school"))
    o["select_helpers"] = with_views(
        """select composite, student_id, english / 2 as english, math / 2 as math, reading,
        test_date as sitting_date, test_location as sitting_location from att""", "att")

    o["join_left_cohort"] = with_views(
        f"select k.*, b.* exclude (student_id) from kept k left join bst b on k.student_key = b.student_id", "kept", "bst")
    o["join_left_cohort_missing_keys"] = with_views(
        "select k.*, b.* exclude (student_id) from kpm k left join bsm b on k.student_key is not distinct from b.student_id",
        "kpm", "bsm")
    o["join_left_cohort_hot_key"] = with_views(
        """select k.*, b.* exclude (student_id)
        from (select * replace (case when student_key % 3 = 1 then 7 else student_key end as student_key) from kept) k
        left join bst b on k.student_key = b.student_id""", "kept", "bst")
    o["appeals_merge_missing_keys"] = with_views("select * from apg", "apg")
    o["merge_status_missing_keys"] = with_views(
        """select coalesce(k.student_key, b.student_id) as id, system, composite,
        case when system is null then 2 when b.here is null then 1 else 3 end as merge_status
        from (select student_key, system from kpm) k full join (select student_id, composite, 1 as here from bsm) b
        on k.student_key is not distinct from b.student_id""", "kpm", "bsm")
    o["appeals_merge"] = with_views("select * from apm", "apm")
    lost = ", ".join(
        f"""case when act_composite_highest is null then {s} when composite is null then null
        when act_composite_highest > composite then act_{s}_highest else {s} end as {s}""" for s in SUBJECTS)
    o["appeals_merge_no_refill"] = with_views(
        f"""select s.* exclude ({', '.join(SCORES)}), {lost}, case when composite is null then act_composite_highest
        when act_composite_highest > composite then act_composite_highest else composite end as composite,
        a.* exclude (student_key) from stu s left join app a on s.student_key = a.student_key""", "stu", "app")
    o["join_left_names"] = with_views(
        "select * from (select system, count(composite) as tested from stu group by system) left join xsys using (system)",
        "stu", "xsys")
    o["join_full_counts_avgs"] = with_views(
        f"""select coalesce(a.system, b.system) as system, coalesce(a.gender, b.gender) as gender, a.n as n_x,
        {even1('m')} as avg_high, b.n as n_y
        from (select system, gender, count(*) as n from stu group by all) a
        full join (select system, gender, avg(composite) as m, count(*) as n from stu where composite is not null group by all) b
        on a.system is not distinct from b.system and a.gender is not distinct from b.gender""", "stu")
    o["merge_keep_using"] = with_views(
        """select k.student_key, k.system, k.school, a.* exclude (student_id)
        from kept k left join alt a on k.student_key = a.student_id""", "kept", "alt")
    o["merge_status"] = with_views(
        """select coalesce(student_id, student_key) as student_key, composite, system,
        case when student_id is null then 2 when student_key is null then 1 else 3 end as merge_status
        from (select student_id, composite from bst) full join kept on student_id = student_key""",
        "bst", "kept")

    o["agg_district"] = with_views(rounded(group_sql(avg_sql() | score_sql(), "stu", ["system"])), "stu")
    o["agg_sum_empty_zero"] = with_views(
        "select file, test_location, cast(coalesce(sum(composite), 0) as bigint) as points from att group by all", "att")
    o["agg_conditional_counts"] = with_views(group_sql(score_sql(False), "stu", ["system", "school"]), "stu")
    o["agg_strict_count"] = with_views(group_sql(strict_sql(), "stu", ["system", "school"]), "stu")
    o["averages_tested_only"] = with_views(rounded(group_sql(avg_sql(), "ind", ["system", "school"])), "ind")
    o["best_attempt"] = with_views("select * from bst", "bst")
    o["best_attempt_alt_order"] = with_views("select * from alt", "alt")
    o["first_nonnull_per_column"] = with_views("select * from fnn", "fnn")
    mixed = "file desc nulls last, test_date nulls last, composite desc nulls last, math nulls last"
    o["first_nonnull_mixed_order"] = with_views(
        f"select * from ({first_sql([*NAMES, *SCORES], mixed)})", "att", extra={"nam": NAMED})
    o["first_rows"] = with_views(
        """select * from att order by composite desc nulls last, test_date nulls last, student_id nulls last, english nulls last,
        math nulls last, reading nulls last, science nulls last, file nulls last, test_location nulls last limit 20""", "att")
    o["distinct_values"] = with_views("select distinct race_ethnicity from coh where race_ethnicity is not null", "coh")
    everyone = {"All Students": "true"}
    o["rollup_levels"] = with_views(cube_sql(score_sql(), avg_sql(), "stu", subgroups=everyone, race=False), "stu")
    o["subgroup_cube"] = with_views(rates_sql(cube_sql(score_sql(), avg_sql(), "stu")), "stu")
    o["subgroup_cube_post_appeals"] = with_views(post_cube(), "ind")
    o["subgroup_cube_loose_super"] = with_views(
        rates_sql(cube_sql(indicator_sql(), avg_sql(), "ind", loose_super=True)), "ind")
    o["subgroup_race"] = with_views(cube_sql(score_sql(), avg_sql(), "stu", subgroups={}), "stu")
    o["rates_state"] = with_views(rates_sql(rounded(group_sql(avg_sql() | score_sql(), "stu", []))), "stu")
    five = {k: SUBGROUP_SQL[k] for k in [
        "All Students", "Black/Hispanic/Native American", "Economically Disadvantaged", "English Learners",
        "Students with Disabilities"]}
    means = avg_sql(["english", "math", "science", "composite"], where=None)
    cube_2016 = suppressed_sql(cube_sql(score_sql(False), means, "fil", ("school", "district"), five, race=False))
    o["pct_suppressed_30"] = with_views(cube_2016, "fil")
    o["label_names_2016"] = with_views(
        """select * exclude (system_name) replace (
          case when school_name is null and school = 0 then 'All Schools' else school_name end as school_name),
          last_value(system_name ignore nulls) over (order by system, school, subgroup
            rows between unbounded preceding and current row) as system_name
        from cube left join xsch using (system, school)""", "fil", "xsch", extra={"cube": cube_2016})
    for name, keys in (
        ("rates_gender_missing", ["system"]),
        ("rates_gender_missing_school", ["system", "school"]),
        ("rates_gender_missing_state", []),
    ):
        o[name] = with_views(
            gender_missing_rates_sql(rounded(group_sql(avg_sql() | gender_missing_sql(), "fil", keys), "up")), "fil")
    o["region_rollup"] = with_views(
        gender_missing_rates_sql(rounded(
            group_sql({"region": "region"} | avg_sql() | gender_missing_sql(),
                      "(select f.*, region from fil f join xreg x on f.system = x.system where region <> '')", []) + " group by region"
            + " union all " + group_sql({"region": "'State'"} | avg_sql() | gender_missing_sql(), "fil", []), "up")),
        "fil", "xreg")

    o["locf_names"] = with_views(
        """select system, school, subgroup, system_name,
        last_value(system_name ignore nulls) over (order by system, school, subgroup nulls last
          rows between unbounded preceding and current row) as filled_name
        from (select distinct system, school, race_ethnicity as subgroup from coh) left join xsys using (system)""",
        "coh", "xsys")
    o["sort_release"] = with_views(rounded(group_sql(avg_sql() | score_sql(), "stu", ["system", "school"])), "stu")
    o["union_attempts"] = with_views(
        f"""select unique_student_id, {date_code('test_date')} as test_date, english, math, reading, science, composite, file from (
        select student_id as unique_student_id, test_date, english, math, reading, science, composite, 'highest' as file from att
        union all
        select student_id, test_date, english, math, reading, science, composite, 'state day' from att where test_location <> 'M'
        union all
        select usid, act_testdate, act_english_highest, act_math_highest, null, null, act_composite_highest, 'matched' from mat
        where unique_student_id is null or usid <> unique_student_id)""", "att", "mat")
    o["what_if_correction"] = what_if_sql()

    ratios = "(select student_id, cast(100 * english as double) / (math * 20) as x from att)"
    o["round_half_even"] = with_views(f"select student_id, {even1('x')} as one, {even0('x')} as whole from {ratios}", "att")
    o["round_half_up"] = with_views(f"select student_id, round(x, 1) as one, round(x, 0) as whole from {ratios}", "att")
    o["pct_zero_denominator"] = with_views(
        "select student_id, english, cast(100 * english as double) / nullif(math - 1, 0) as p from att", "att")
    o["decode_month_year"] = with_views(
        f"""select usid, code, {date_code('code')} as test_date from (select usid,
        act_testdate + case when act_math_highest > 30 then 900 else 0 end as code from mat)""", "mat")
    o["decode_ymd"] = with_views(
        "select cast(id2 as bigint) as l_orderkey, dob, cast(try_strptime(dob, '%Y%m%d') as date) as born from fwh", "fwh")
    o["try_cast_ids"] = """select raw, case when raw like '%x' then null else cast(floor(cast(trim(raw) as double)) as bigint) end as id,
      case when raw like '%x' then null else cast(trim(raw) as double) end as number
      from (select ' ' || o_orderkey || case o_orderstatus when 'P' then 'x' when 'F' then '.7' else ' ' end as raw from orders)"""
    o["split_site_code"] = with_views(
        """select org_code, cast(split_part(local_site_code, ' ', 1) as bigint) as system,
        cast(nullif(split_part(local_site_code, ' ', 2), '') as bigint) as school from site""", "site")
    o["nan_to_null"] = with_views(
        "select student_id, english, cast(composite as double) as composite from att", "att")
    o["coalesce_scores"] = with_views(
        f"""select student_key, {', '.join(f'coalesce(x.{c}, d.{c}) as {c}' for c in SCORES)}
        from kept left join alt_xw x on student_key = x.student_id
        left join (select student_id, {', '.join(f'first({c} order by {_ALT_ORDER}) filter (where {c} is not null) as {c}' for c in SCORES)}
          from att group by student_id) d on student_key = d.student_id""", "kept", "alt_xw")

    o["benchmark_flags_gated"] = with_views(f"select *, {flags_sql('gated')} from att", "att")
    o["benchmark_flags_ungated"] = with_views(
        f"""select *, {flags_sql('ungated')} from (select usid, act_english_highest as english,
        case when act_composite_highest > 9 then act_math_highest end as math, act_reading_highest as reading,
        act_science_highest as science from mat)""", "mat")
    blank = ", ".join(f"case when composite is not null then {s} end as {s}" for s in SUBJECTS)
    o["benchmark_flags_zero"] = with_views(
        f"select *, {flags_sql('zero')} from (select * replace ({blank}) from att)", "att")
    o["student_level"] = with_views("select * from stu", "stu")
    every = f"""select student_id, {date_code('test_date')} as test_date, {', '.join(SCORES)}, file from (
      select student_id, test_date, {', '.join(SCORES)}, 'ACT highest' as file from att
      union all
      select l_orderkey, {_SHIP_CODE}, cast(1 + (l_partkey + l_linenumber) % 36 as int), cast(1 + (l_suppkey + l_linenumber) % 36 as int),
        cast(1 + (l_partkey * 2 + l_linenumber) % 36 as int), cast(1 + (l_suppkey * 2 + l_linenumber) % 36 as int),
        case when l_linenumber <> 5 then cast(1 + cast(l_quantity as int) % 36 as int) end, 'State day'
      from lineitem where l_tax <> 0.08 and l_tax <> 0.0
      union all
      select usid, act_testdate, {', '.join(f'act_{c}_highest' for c in SCORES)}, 'Test match' from mat
      where unique_student_id is null or usid <> unique_student_id)"""
    top = f"""select * exclude (rn) from (select *, row_number() over (partition by student_id
      order by {_ORDER}, file asc nulls last) as rn from every_) where rn = 1"""
    gated = ", ".join(f"case when composite is not null then {c} end as {c}" for c in [*SUBJECTS, "file"])
    o["student_level_all_files"] = with_views(
        f"""select k.*, b.test_date, {gated}, composite, {flags_sql('gated')}
        from kept k left join top b on k.student_key = b.student_id""", "att", "mat", "kept",
        extra={"every_": every, "top": top})
    o["student_level_fill"] = with_views("select * from fil", "fil")
    by_file = "file nulls last, composite desc nulls last, test_date nulls last"
    o["student_level_fill_names"] = with_views(
        f"""select *, {flags_sql('zero')} from (select k.*, {', '.join(f'coalesce(x.{c}, d.{c}) as {c}' for c in SCORES)},
          {', '.join(f'd.{c}' for c in NAMES)} from kept k left join alt_xw x on k.student_key = x.student_id
          left join day_ d on k.student_key = d.student_id)""", "att", "kept", "alt_xw",
        extra={"nam": NAMED, "day_": first_sql([*NAMES, *SCORES], by_file)})
    o["appeal_indicators"] = with_views("select * from ind", "ind")

    o["student_file"] = with_views(
        f"""select system, school, student_key as state_stud_id, sat_total, gender, {', '.join([*SCORES, *FLAGS])}
        from ind""", "ind")

    filled = named_case(IF_MISSING, "null")
    o["label_names"] = with_views(
        f"""select * exclude (system_name) replace (
          case when school_name is not null then school_name when school = 0 then 'All Schools' else {filled} end as school_name),
          case when system = 0 then {q(STATE_NAME)} else last_value(system_name ignore nulls) over (
            order by system, school, subgroup nulls last rows between unbounded preceding and current row) end as system_name
        from cube left join xsch using (system, school)""", "ind", "xsch", extra={"cube": post_cube()})
    counts = group_sql(score_sql(), "stu", ["system", "school"])
    o["label_names_forced"] = with_views(
        f"""select * replace ({named_case(FORCED, 'school_name')} as school_name)
        from ({counts}) left join xsch using (system, school)""", "stu", "xsch")
    o["relabel_subgroups"] = with_views(
        f"select level, system, school, {relabel_sql()} as subgroup, enrolled from ({cube_sql({'enrolled': 'count(*)'}, {}, 'stu')})",
        "stu")

    three = {"avg_composite": "act_composite_avg", "participation_rate": "participation_rate", "pct_21_or_higher": "pct_21_orhigher"}
    for name, level, keys in (
        ("reconcile_tolerance", "school", ["system", "school", "subgroup"]),
        ("reconcile_tolerance_district", "district", ["system", "subgroup"]),
    ):
        on = " and ".join(f"a.{k} is not distinct from b.{k}" for k in keys)
        o[name] = with_views(
            f"""select {', '.join(f'a.{k}' for k in keys)}, {', '.join(f'a.{x} as {x}_x, b.{y} as {x}_y' for x, y in three.items())}
            from own a join oth b on {on} where {' or '.join(f'abs(a.{x} - b.{y}) > 0.1' for x, y in three.items())}""",
            "ind", extra=own_views(level))
    o["reconcile_anti"] = with_views(
        """select * from own a where not exists (select 1 from oth b where a.system is not distinct from b.system
        and a.subgroup is not distinct from b.subgroup and a.avg_composite is not distinct from b.act_composite_avg
        and a.n_21_or_higher is not distinct from b.n_21_orhigher and a.n_below_19 is not distinct from b.n_below19)""",
        "ind", extra=own_views("district"))
    pairs = {f"n_cr_{s}": f"met_CRB_{s}" for s in SUBJECTS} | {"n_cr_all": "met_All4_CRB"}
    o["reconcile_side_by_side"] = with_views(
        f"""select coalesce(a.system, b.system) as system, coalesce(a.school, b.school) as school,
        coalesce(a.subgroup, b.subgroup) as subgroup, {', '.join(f'a.{x} as {x}, b.{y} as {y}' for x, y in pairs.items())}
        from own a full join (select * from pub where valid_tests > 0) b
        on a.system = b.system and a.school = b.school and a.subgroup is not distinct from b.subgroup""",
        "ind", extra=own_views("state"))
    five_cols = three | {"enrolled": "enrolled", "valid_tests": "valid_tests"}
    o["mismatch_counts"] = with_views(
        " union all ".join(
            f"""select {q(x)} as column_name, count(*) filter (where a.{x} is distinct from b.{y}) as n_mismatch
            from own a full join oth b on a.system = b.system and a.school = b.school and a.subgroup is not distinct from b.subgroup"""
            for x, y in five_cols.items()), "ind", extra=own_views("school"))

    o["mismatch_hot_key"] = with_views(
        """select 'english' as column_name, cast(sum(greatest(ours, theirs)) as bigint) as n_mismatch from (
          select k, count(*) filter (where side = 1) as ours, count(*) filter (where side = 2) as theirs from (
            select *, 1 as side from (select * from x except all select * from y)
            union all select *, 2 from (select * from y except all select * from x)) group by k)""", "att",
        extra={
            "x": "select case when student_id % 3 <> 0 then student_id % 40 end as k, english from att",
            "y": """select case when student_id % 3 <> 0 then student_id % 40 end as k,
              case when math % 7 = 0 then english + 100 else english end as english from att where student_id % 40 <> 5"""})

    sch = {"District": "system", "School": "school", "Subgroup": "subgroup"}
    o["suppress_release"] = with_views(
        release_sql(sch, "pub", 5, 95, 30, rate=True), "ind", extra=own_views("school"))
    o["suppress_counts"] = with_views(
        f"""select system, school, subgroup, valid_tests,
        {hide_count_sql('n_21_orhigher', 0.05, 0.95, 10, 'valid_tests')} as n_21_orhigher,
        {hide_count_sql('n_below19', 0.05, 0.95, 10, 'valid_tests')} as n_below19 from pub""", "ind", extra=own_views("school"))
    hpi = "case when subgroup = 'HPI' then 'Hawaiian or Pacific Islander' else subgroup end"
    state_keys = {"District": "0", "District Name": q(STATE_NAME), "Subgroup": hpi}
    o["release_state"] = with_views(release_sql(state_keys, "pub", 1, 99), "ind", extra=own_views("state"))
    highest = {
        "own": f"""select * exclude (level) replace ({relabel_sql()} as subgroup)
          from ({rates_sql(cube_sql(score_sql(), avg_sql(), 'stu', ('state',)))})""",
        "pub": external_sql("own", CUBE_COLUMNS),
    }
    o["release_state_highest"] = with_views(release_sql(state_keys, "pub", 1, 99, rate=True), "stu", extra=highest)
    o["release_district"] = with_views(
        release_sql({"District": "system", "District Name": "system_name", "Subgroup": "subgroup"},
                    "(select * from pub left join xsys using (system))", 1, 99, counts=True, numbers=True, where=IN_SUBGROUPS),
        "ind", "xsys", extra=own_views("district"))
    o["release_school"] = with_views(
        release_sql({"District": "system", "District Name": "system_name", "School": "school",
                     "School Name": named_case(FORCED, "school_name"), "Subgroup": "subgroup"},
                    "(select * from pub left join xsch using (system, school))", 5, 95, where=IN_SUBGROUPS),
        "ind", "xsch", extra=own_views("school"))

    o["publish_release_district"] = o["release_district"]
    stamped = {
        "students": o["appeal_indicators"], "cube": o["subgroup_cube_post_appeals"], "student_file": o["student_file"],
        "base_file": o["label_names"], **{f"release_{x}": o[f"release_{x}"] for x in ("state", "district", "school")},
    }
    o["publish_outputs"] = " union all ".join(
        f"select '{name}_2017jul11' as output, count(*) as n from ({sql})" for name, sql in stamped.items())

    o["missing_id_report"] = with_views(
        f"""select system, n, n_missing_id, {even1('p')} as pct from (
        select system, count(*) as n, count(*) filter (where state_stud_id is null) as n_missing_id,
          cast(100 * count(*) filter (where state_stud_id is null) as double) / count(*) as p
        from jday left join (select cast(org_code as bigint) as code, cast(split_part(local_site_code, ' ', 1) as bigint) as system
          from site where org_code is not null) on code = acthscode group by system)""", "site", "jday")
    o["unmatched_ids"] = with_views(
        """select * replace (cast(try_strptime(dob, '%Y%m%d') as date) as dob, cast(null as bigint) as id2)
        from fwh where id is null""", "fwh")
    return o
