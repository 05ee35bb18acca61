"""Values that results must agree on.  Everything here is a default; the
operators take each one as a parameter.
"""

# Subjects and the benchmark score of each.
BENCHMARKS = {"english": 18, "math": 22, "reading": 22, "science": 23}
SUBJECTS = list(BENCHMARKS)
SCORES = [*SUBJECTS, "composite"]

# Composite bands and the other test's total that stands in for them.
HIGH_COMPOSITE = 21
LOW_COMPOSITE = 19
HIGH_TOTAL = 1060
LOW_TOTAL = 980

# race/ethnicity codes and labels.
RACE_LABELS = {
    "A": "Asian",
    "B": "Black or African American",
    "H": "Hispanic or Latino",
    "I": "Native American",
    "P": "Hawaiian or Pacific Islander",
    "W": "White",
}
BHN_CODES = ["B", "H", "I"]

# Subgroup names in the external vocabulary.
EXTERNAL_SUBGROUPS = {
    "English Learners": "English Language Learners with T1/T2",
    "Hispanic or Latino": "Hispanic",
    "Hawaiian or Pacific Islander": "HPI",
    "Non-English Learners": "Non-English Language Learners",
}

# Subgroups kept in district and school releases.
ACCOUNTABILITY_SUBGROUPS = [
    "All Students",
    "Black/Hispanic/Native American",
    "Economically Disadvantaged",
    "English Language Learners with T1/T2",
    "Students with Disabilities",
]

# Names of the total rows.
ALL_SCHOOLS = "All Schools"
STATE_NAME = "State of Tennessee"

# School names used where the crosswalk has none.
SCHOOL_NAMES_IF_MISSING = {
    (61, 40): "F.I. Denning Center of Technology and Careers",
    (190, 740): "Johnson Alternative Learning Center",
    (580, 75): "Central Prep Academy",
    (650, 46): "Morgan County Career and Technical Center",
    (792, 8275): "The Excel Center",
    (830, 155): "Sumner County Middle College High School",
    (830, 1010): "Sumner County Middle Technical College High School at Portland",
    (900, 115): "Tennessee Virtual Learning Academy",
    (970, 140): "DCS Affiliated Schools",
    (985, 45): "Pathways in Education - TN",
    (985, 50): "Pathways in Education - Whitehaven",
    (985, 8055): "Fairley High School",
    (985, 8065): "Martin Luther King Preparatory High School",
    (985, 8140): "Hillcrest High School",
}

# Entries of that list that the 2016 files did not have.
NOT_IN_2016 = [(190, 740), (970, 140), (985, 8140)]

# School names used whatever the crosswalk says.
SCHOOL_NAMES_FORCED = {
    (970, 25): "Woodland Hills Youth Development Center",
    (970, 45): "Wilder Youth Development Center",
    (970, 65): "Mountain View Youth Development Center",
    (970, 140): "DCS Affiliated Schools",
    (985, 8140): "Hillcrest High School",
}

# Column names of the external aggregate, ours -> theirs.
EXTERNAL_COLUMNS = {
    "avg_english": "english_avg",
    "avg_math": "math_avg",
    "avg_reading": "reading_avg",
    "avg_science": "science_avg",
    "avg_composite": "act_composite_avg",
    "n_21_or_higher": "n_21_orhigher",
    "pct_21_or_higher": "pct_21_orhigher",
    "n_below_19": "n_below19",
    "pct_below_19": "pct_below19",
    "n_cr_english": "met_CRB_english",
    "pct_cr_english": "pct_met_CRB_english",
    "n_cr_math": "met_CRB_math",
    "pct_cr_math": "pct_met_CRB_math",
    "n_cr_reading": "met_CRB_reading",
    "pct_cr_reading": "pct_met_CRB_reading",
    "n_cr_science": "met_CRB_science",
    "pct_cr_science": "pct_met_CRB_science",
    "n_cr_all": "met_All4_CRB",
    "pct_cr_all": "pct_met_All4_CRB",
    "valid_tests_male": "male_count",
    "valid_tests_female": "female_count",
    "n_male_21_or_higher": "male_n_21_orhigher",
    "n_female_21_or_higher": "female_n_21_orhigher",
    "n_male_below_19": "male_n_below19",
    "n_female_below_19": "female_n_below19",
    "pct_male_21_or_higher": "male_pct21orhigher",
    "pct_female_21_or_higher": "female_pct21orhigher",
    "pct_male_below_19": "male_pctbelow19",
    "pct_female_below_19": "female_pctbelow19",
}

# Column names of a release, external -> published.
RELEASE_COLUMNS = {
    "valid_tests": "Valid Tests",
    "participation_rate": "Participation Rate",
    "english_avg": "Average English Score",
    "math_avg": "Average Math Score",
    "reading_avg": "Average Reading Score",
    "science_avg": "Average Science Score",
    "act_composite_avg": "Average Composite Score",
    "n_21_orhigher": "Number Scoring 21 or Higher",
    "pct_21_orhigher": "Percent Scoring 21 or Higher",
    "n_below19": "Number Scoring Below 19",
    "pct_below19": "Percent Scoring Below 19",
}

# Byte ranges (first, last) and type of two fixed-width layouts.
RETAKE_LAYOUT = [
    ("year", 1, 2, "number"),
    ("last", 3, 27, "text"),
    ("first", 28, 43, "text"),
    ("middle", 44, 44, "text"),
    ("address", 45, 84, "text"),
    ("gender", 88, 88, "text"),
    ("grade", 89, 90, "number"),
    ("act_id", 91, 99, "number"),
    ("dob", 101, 106, "number"),
    ("city", 117, 141, "text"),
    ("zip", 146, 154, "number"),
    ("state_id", 192, 204, "number"),
    ("act_hs_code", 205, 210, "number"),
    ("test_date", 233, 236, "number"),
    ("english", 773, 774, "text"),
    ("math", 775, 776, "text"),
    ("reading", 777, 778, "text"),
    ("science", 779, 780, "text"),
    ("composite", 781, 782, "text"),
]
HIGHEST_LAYOUT = [
    ("first", 3, 27, "text"),
    ("last", 28, 43, "text"),
    ("mi", 44, 44, "text"),
    ("dob", 155, 162, "text"),
    ("id", 192, 204, "text"),
    ("test_date", 227, 232, "text"),
    ("id2", 691, 700, "text"),
    ("english", 731, 732, "number"),
    ("math", 733, 734, "number"),
    ("reading", 735, 736, "number"),
    ("science", 737, 738, "number"),
    ("composite", 739, 740, "number"),
]
