"""Datasets behind a health dashboard, for all users at once.

Inputs are gold tables. Per-user histories are cut to the newest N rows before
they are shuffled (see ``operators.ranking``), so no step gathers a user's
whole history.
"""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed1, grouped_int, or_na
from ..operators import top_n

# ---------------------------------------------------------------- KPIs


@dataclass(frozen=True)
class Goals:
    """Targets that key figures are compared with."""

    steps: int = 8000
    active_kcal: float = 500.0
    resting_hr_high: float = 75.0
    sleep_hours: float = 7.5


def kpi_vs_goal(figures: DataFrame, goals: Goals = Goals()) -> DataFrame:
    """Distance to goal and status labels for rows of key figures.

    Expects ``steps, active_kcal, sleep_minutes, resting_hr``. Zero steps or
    energy have no distance to goal; without a resting rate there is no label.
    The label and unit texts are fixed values.
    """
    steps, kcal, rate = F.col("steps"), F.col("active_kcal"), F.col("resting_hr")
    return (
        figures
        .withColumn("steps_vs_goal", F.when(steps > 0, steps - goals.steps))
        .withColumn("active_kcal_vs_goal", F.when(kcal > 0, kcal - goals.active_kcal))
        .withColumn("sleep_hours", F.coalesce(F.col("sleep_minutes"), F.lit(0.0)) / 60.0)
        .withColumn(
            "sleep_status",
            F.when(F.col("sleep_minutes").isNull(), F.lit("No Data"))
            .otherwise(F.concat(fixed1("sleep_hours"), F.lit(" hrs"))),
        )
        .withColumn("resting_hr_text", or_na(rate, F.concat(fixed1("resting_hr"), F.lit(" bpm"))))
        .withColumn(
            "resting_hr_label",
            F.when(F.isnan(rate), None)
            .when(rate > goals.resting_hr_high, F.lit("Elevated"))
            .when(rate > 0, F.lit("Good (<70)")),
        )
        .drop("sleep_minutes")
    )


def latest_kpis(
    activity: DataFrame, sleep: DataFrame, cardio: DataFrame, goals: Goals = Goals()
) -> DataFrame:
    """Newest key figures of every user with activity data, against goals."""
    def newest(gold: DataFrame, name: str, *figures: Column) -> DataFrame:
        row = F.struct("date", *figures)
        return gold.groupBy("user_id").agg(F.max_by(row, F.coalesce("date", F.lit("0001-01-01").cast("date"))).alias(name))

    # Each table is reduced to a row per user within the tasks that make it,
    # and the rows of a user meet in one grouping.
    parts = [
        newest(activity, "a", F.col("step_count").try_cast("long").alias("steps"),
               F.col("active_energy_kcal").alias("active_kcal"), F.col("distance_km")),
        newest(sleep, "s", F.col("total_sleep_minutes").alias("sleep_minutes")),
        newest(cardio, "c", F.col("avg_resting_heart_rate").alias("resting_hr")),
    ]
    united = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    figures = united.groupBy("user_id").agg(*[F.any_value(n, ignoreNulls=True).alias(n) for n in "asc"]).where("a IS NOT NULL")
    return kpi_vs_goal(figures.select("user_id", "a.*", "s.sleep_minutes", "c.resting_hr"), goals)


# ---------------------------------------------------------------- trends


def _newest(gold: DataFrame, n: int, columns: tuple[str, ...], date: str = "date") -> DataFrame:
    """Newest ``n`` rows per user of some columns, oldest of them first.

    A user's rows stand together and in order; users are in no order, since
    sorting all of them would shuffle everything for a reader of one.
    """
    rows = top_n(gold.select("user_id", date, *columns), ("user_id",), n, [F.desc(date)])
    return rows.sortWithinPartitions("user_id", date)


def _history(gold: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """All rows; a user's stand together, by date."""
    return gold.select("user_id", "date", *columns).repartition("user_id").sortWithinPartitions("user_id", "date")


def steps_trend(activity: DataFrame, days: int = 14) -> DataFrame:
    return _newest(activity, days, ("step_count",))


def sleep_stage_bars(sleep: DataFrame, days: int = 14) -> DataFrame:
    return _newest(sleep, days, (
        "deep_sleep_minutes", "light_sleep_minutes", "rem_sleep_minutes", "awake_minutes",
    ))


def long_form(wide: DataFrame, ids: tuple[str, ...] = ("user_id", "date")) -> DataFrame:
    """Chart series as (ids, series, value) rows."""
    values = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), values, "series", "value")


def sleep_averages(sleep: DataFrame, goals: Goals = Goals()) -> DataFrame:
    """Mean stage lengths over each user's history and whether sleep meets the goal."""
    stages = ("deep_sleep_minutes", "light_sleep_minutes", "rem_sleep_minutes", "awake_minutes")
    return (
        sleep.groupBy("user_id")
        .agg(
            (F.avg("total_sleep_minutes") / 60.0).alias("avg_sleep_hours"),
            *[F.avg(stage).alias(f"avg_{stage}") for stage in stages],
        )
        .withColumn("target_met", F.col("avg_sleep_hours") >= goals.sleep_hours)
    )


def sleep_stage_trend(sleep: DataFrame) -> DataFrame:
    return _history(sleep, ("deep_sleep_minutes", "light_sleep_minutes", "rem_sleep_minutes"))


def energy_trend(activity: DataFrame) -> DataFrame:
    return _history(activity, ("active_energy_kcal", "basal_energy_kcal"))


def distance_trend(activity: DataFrame) -> DataFrame:
    return _history(activity, ("distance_km",))


def heart_trend(cardio: DataFrame) -> DataFrame:
    return _history(cardio, ("avg_resting_heart_rate", "avg_hrv_sdnn"))


def oxygen_trend(cardio: DataFrame) -> DataFrame:
    return _history(cardio, ("avg_blood_oxygen", "avg_vo2_max"))


def respiratory_trend(respiratory: DataFrame) -> DataFrame:
    return _history(respiratory, ("avg_respiratory_rate", "avg_breathing_disturbances"))


def recent_respiratory(respiratory: DataFrame, rows: int = 15) -> DataFrame:
    """Newest nights per user, newest first."""
    newest = top_n(respiratory, ("user_id",), rows, [F.desc("date")])
    return newest.sortWithinPartitions("user_id", F.desc("date"))


# ---------------------------------------------------------------- workouts


def workout_type_distribution(workouts: DataFrame) -> DataFrame:
    return workouts.groupBy("user_id", "workout_type").agg(F.count("*").alias("sessions"))


def workout_totals(workouts: DataFrame) -> DataFrame:
    return workouts.groupBy("user_id").agg(
        (F.sum("duration_minutes") / 60.0).alias("total_hours"),
        F.avg("duration_minutes").alias("avg_duration_minutes"),
        F.sum("total_energy_kcal").alias("total_energy_kcal"),
        F.count("*").alias("sessions"),
    )


# ---------------------------------------------------------------- coach text

# Section headings of the context text, in order.
ACTIVITY_HEADING = "### ACTIVITY SUMMARY (Last 7 Days):\n"
SLEEP_HEADING = "\n### SLEEP STAGES (Last 7 Days):\n"
CARDIO_HEADING = "\n### CARDIOVASCULAR METRICS (Last 7 Days):\n"
WORKOUT_HEADING = "\n### RECENT WORKOUTS:\n"


# Per section, its heading, newest rows, and cells as (label, column, unit).
SECTIONS = (
    (ACTIVITY_HEADING, 7, (
        ("Active Energy", "active_energy_kcal", " kcal"), ("Distance", "distance_km", " km"))),
    (SLEEP_HEADING, 7, (
        ("Deep", "deep_sleep_minutes", "m"), ("Light", "light_sleep_minutes", "m"),
        ("REM", "rem_sleep_minutes", "m"), ("Awake", "awake_minutes", "m"))),
    (CARDIO_HEADING, 7, (
        ("Resting Heart Rate", "avg_resting_heart_rate", " bpm"), ("HRV (SDNN)", "avg_hrv_sdnn", " ms"),
        ("Blood Oxygen Avg", "avg_blood_oxygen", "%"))),
    (WORKOUT_HEADING, 5, (
        ("Duration", "duration_minutes", "m"), ("Energy", "total_energy_kcal", " kcal"),
        ("Distance", "total_distance_km", " km"))),
)


def _rows_of(section: int, gold: DataFrame, at: str, steps: str | None = None, kind: str | None = None) -> DataFrame:
    """Rows of a section in the form all share: when, workout type, steps and up to four figures."""
    _, _, cells = SECTIONS[section]
    figures = [F.col(column).cast("double") for _, column, _ in cells] + [F.lit(None).cast("double")] * (4 - len(cells))
    return gold.select(
        "user_id", F.lit(section).alias("section"), F.col(at).cast("timestamp_ntz").alias("at"),
        (F.col(kind) if kind else F.lit(None).cast("string")).alias("kind"),
        (F.col(steps).cast("double") if steps else F.lit(None).cast("double")).alias("steps"),
        *[figure.alias(f"f{i}") for i, figure in enumerate(figures)],
    )


def _line_of(section: int) -> Column:
    """``- Label: text | Label: text`` and a line end. Missing and NaN read N/A, zero only for cardio figures."""
    _, _, cells = SECTIONS[section]
    day = F.col("at").cast("date").cast("string")
    if section == 3:
        texts = [("Type", F.col("kind")), ("Date", F.substring(F.col("at").cast("string"), 1, 19))]
    else:
        texts = [("Date", day)] + ([("Steps", F.coalesce(grouped_int(F.col("steps")), F.lit("N/A")))] if section == 0 else [])
    for i, (label, _, unit) in enumerate(cells):
        text = F.concat(fixed1(f"f{i}"), F.lit(unit))
        known = or_na(F.col(f"f{i}"), text) if section == 2 else F.when(F.isnan(f"f{i}"), F.lit("N/A")).otherwise(F.coalesce(text, F.lit("N/A")))
        texts.append((label, known))
    cells = [F.concat(F.lit(f"{label}: "), text) for label, text in texts]
    return F.concat(F.lit("- "), F.concat_ws(" | ", *cells), F.lit("\n"))


def coach_context(
    activity: DataFrame, sleep: DataFrame, cardio: DataFrame, workouts: DataFrame
) -> DataFrame:
    """One text per user: newest days and workouts as lines under headings.

    The sections are united as figures, cut to the newest rows of each user
    and section in one step, and only what is left is made text: at most
    7 + 7 + 7 + 5 lines per user. Sections without rows are left out.
    """
    rows = reduce(DataFrame.unionByName, [
        _rows_of(0, activity, "date", steps="step_count"), _rows_of(1, sleep, "date"),
        _rows_of(2, cardio, "date"), _rows_of(3, workouts, "start_date", kind="workout_type"),
    ])
    limit = F.element_at(F.array(*[F.lit(n) for _, n, _ in SECTIONS]), F.col("section") + 1)
    newest = Window.partitionBy("user_id", "section").orderBy(F.desc("at"), F.col("kind"))
    rows = rows.withColumn("n", F.row_number().over(newest)).where(F.col("n") <= max(n for _, n, _ in SECTIONS)).where(F.col("n") <= limit)
    lines, headings = F, F
    for section, (heading, _, _) in enumerate(SECTIONS):
        lines = lines.when(F.col("section") == section, _line_of(section))
        headings = headings.when(F.col("section") == section, F.lit(heading))
    # The first line of each section brings its heading along.
    line = F.concat(F.when(F.col("n") == 1, headings).otherwise(F.lit("")), lines)
    gathered = rows.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("section", "n", line.alias("line")))).alias("rows"))
    return gathered.select("user_id", F.array_join(F.col("rows.line"), "").alias("context"))


REPORT_TEMPLATE = (
    "Write a short weekly health report from the figures below. Cover sleep quality "
    "(deep and REM), activity against step and energy goals, recovery as seen in resting "
    "heart rate and HRV, and practical advice for next week.\n\nFigures:\n{context}\n"
)
QUESTION_TEMPLATE = "Health figures of the last 7 days:\n{context}\n\nQuestion: {question}\n"


def _fill(template: str, **values: Column) -> Column:
    """The template's text with ``{name}`` places taken by columns."""
    pieces = re.split(r"\{(\w+)\}", template)
    texts = [F.lit(piece) if i % 2 == 0 else values[piece] for i, piece in enumerate(pieces)]
    return F.concat(*texts)


def report_prompt(contexts: DataFrame, template: str = REPORT_TEMPLATE) -> DataFrame:
    """Text that asks for a weekly report, one per user context."""
    return contexts.select("user_id", _fill(template, context=F.col("context")).alias("prompt"))


def question_prompt(
    contexts: DataFrame, question: Column, template: str = QUESTION_TEMPLATE
) -> DataFrame:
    """Text that puts a question in the light of the user's context."""
    filled = _fill(template, context=F.col("context"), question=question)
    return contexts.select("user_id", filled.alias("prompt"))
