"""Served views: labels, gaps and the coach text."""

import datetime as dt

from pyspark.sql import functions as F

from vitals.plans import serve

D = dt.date


def activity(spark, rows):
    return spark.createDataFrame(rows, "user_id string, date date, step_count double, active_energy_kcal double, basal_energy_kcal double, distance_km double")


def sleep(spark, rows):
    return spark.createDataFrame(rows, "user_id string, date date, total_sleep_minutes double, deep_sleep_minutes double, light_sleep_minutes double, rem_sleep_minutes double, awake_minutes double")


def cardio(spark, rows):
    return spark.createDataFrame(rows, "user_id string, date date, avg_resting_heart_rate double, avg_hrv_sdnn double, avg_blood_oxygen double")


def workouts(spark, rows):
    return spark.createDataFrame(rows, "user_id string, workout_type string, start_date timestamp_ntz, duration_minutes double, total_energy_kcal double, total_distance_km double")


def test_kpis(spark):
    day, old = D(2024, 1, 2), D(2024, 1, 1)
    a = activity(spark, [("a", old, 1.0, 1.0, 1.0, 1.0), ("a", day, 8123.9, 450.0, 0.0, 5.0),
                         ("b", day, 0.0, 0.0, 0.0, 0.0), ("c", day, 1.0, 1.0, 1.0, 1.0), ("d", day, 1.0, 1.0, 1.0, 1.0)])
    s = sleep(spark, [("a", old, 450.0, 1.0, 1.0, 1.0, 1.0), ("z", day, 1.0, 1.0, 1.0, 1.0, 1.0)])
    c = cardio(spark, [("a", day, 75.0, 1.0, 1.0), ("b", day, 75.1, 1.0, 1.0), ("c", day, float("nan"), 1.0, 1.0), ("d", day, None, 1.0, 1.0)])
    got = {r.user_id: r for r in serve.latest_kpis(a, s, c).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert (got["a"].steps, got["a"].steps_vs_goal, got["a"].active_kcal_vs_goal) == (8123, 123, -50.0)
    assert (got["a"].sleep_hours, got["a"].sleep_status) == (7.5, "7.5 hrs")
    assert (got["a"].resting_hr_text, got["a"].resting_hr_label) == ("75.0 bpm", "Good (<70)")
    assert (got["b"].steps_vs_goal, got["b"].active_kcal_vs_goal, got["b"].sleep_status) == (None, None, "No Data")
    assert got["b"].resting_hr_label == "Elevated"
    assert (got["c"].resting_hr_text, got["c"].resting_hr_label) == ("N/A", None)
    assert (got["d"].resting_hr_text, got["d"].resting_hr_label) == ("N/A", None)


def test_coach_context(spark):
    days = [D(2024, 1, d) for d in range(1, 10)]
    a = activity(spark, [("a", d, 1000.0 * d.day, 6.25, 0.0, 0.15) for d in days])
    s = sleep(spark, [("a", days[0], 9.0, 60.0, 120.0, 30.0, 5.25), ("only sleep", days[0], 9.0, 1.0, 2.0, 3.0, 4.0)])
    c = cardio(spark, [("a", days[0], None, 0.0, 96.75)])
    w = workouts(spark, [("a", t, dt.datetime(2024, 1, 3, 7, 5), 30.0, None, 2.0) for t in ("Run", "Bike")])
    got = {r.user_id: r.context for r in serve.coach_context(a, s, c, w).collect()}
    want = "### ACTIVITY SUMMARY (Last 7 Days):\n"
    for d in reversed(days[2:]):
        want += f"- Date: {d} | Steps: {1000 * d.day:,} | Active Energy: {6.25:.1f} kcal | Distance: {0.15:.1f} km\n"
    want += "\n### SLEEP STAGES (Last 7 Days):\n- Date: 2024-01-01 | Deep: 60.0m | Light: 120.0m | REM: 30.0m | Awake: 5.2m\n"
    want += "\n### CARDIOVASCULAR METRICS (Last 7 Days):\n- Date: 2024-01-01 | Resting Heart Rate: N/A | HRV (SDNN): N/A | Blood Oxygen Avg: 96.8%\n"
    want += "\n### RECENT WORKOUTS:\n"
    for t in ("Bike", "Run"):
        want += f"- Type: {t} | Date: 2024-01-03 07:05:00 | Duration: 30.0m | Energy: N/A | Distance: 2.0 km\n"
    assert got["a"] == want
    assert got["only sleep"].startswith("\n### SLEEP STAGES") and "ACTIVITY" not in got["only sleep"]


def test_prompts_place_texts_as_they_are(spark):
    contexts = spark.createDataFrame([("a", "has {question} and {context} in it")], "user_id string, context string")
    got = serve.question_prompt(contexts, F.lit("why {context}?")).first().prompt
    assert got == "Health figures of the last 7 days:\nhas {question} and {context} in it\n\nQuestion: why {context}?\n"
    assert "has {question}" in serve.report_prompt(contexts).first().prompt


def test_trends_are_newest_days_oldest_first(spark):
    rows = [("a", D(2024, 1, d), float(d), 0.0, 0.0, 0.0) for d in range(1, 21)] + [("b", D(2024, 1, 1), 1.0, 0.0, 0.0, 0.0)]
    got = [(r.user_id, r.date.day) for r in serve.steps_trend(activity(spark, rows)).collect()]
    assert got == [("a", d) for d in range(7, 21)] + [("b", 1)]


def test_sleep_target(spark):
    rows = [("a", D(2024, 1, 1), 400.0, 1.0, 2.0, 3.0, 4.0), ("a", D(2024, 1, 2), 500.0, 3.0, 2.0, 3.0, 4.0), ("b", D(2024, 1, 1), 449.0, 1.0, 1.0, 1.0, 1.0)]
    got = {r.user_id: (r.avg_sleep_hours, r.avg_deep_sleep_minutes, r.target_met) for r in serve.sleep_averages(sleep(spark, rows)).collect()}
    assert got["a"] == (7.5, 2.0, True) and got["b"][2] is False


def test_odd_numbers_have_texts_and_stop_nobody(spark):
    import datetime as dt
    from decimal import Decimal
    from pyspark.sql import functions as F
    from vitals.functions import fixed1, grouped_int
    values = [float("nan"), float("inf"), float("-inf"), 1e30, -1e30, 1e300, 123456789.25, 9e16, 2e17, None, 0.15, -0.05]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: (r.a, r.b) for r in rows.select("i", fixed1("v").alias("a"), grouped_int(F.col("v")).alias("b")).collect()}
    for i, v in enumerate(values):
        if v is None:
            assert got[i] == (None, None)
        elif v != v:
            assert got[i] == ("N/A", "N/A")
        elif v == 1e300:
            assert got[i] == ("1.0E300", "1.0E300")
        elif abs(v) == float("inf"):
            assert got[i] == (str(v), str(v))
        else:
            whole = Decimal(repr(v))  # large numbers are written from their shortest form
            assert got[i] == (f"{whole:.1f}" if abs(v) >= 1e17 else f"{v:.1f}", f"{int(whole):,}")

    day = dt.date(2024, 1, 1)
    activity = spark.createDataFrame(
        [("good", day, 5000.0, 300.0, 4.0), ("inf", day, float("inf"), float("nan"), 1e30)],
        "user_id string, date date, step_count double, active_energy_kcal double, distance_km double")
    sleep = spark.createDataFrame([("inf", day, float("inf"))], "user_id string, date date, total_sleep_minutes double")
    cardio = spark.createDataFrame([("inf", day, float("inf"))], "user_id string, date date, avg_resting_heart_rate double")
    kpis = {r.user_id: r for r in serve.latest_kpis(activity, sleep, cardio).collect()}
    assert kpis["good"].steps == 5000 and kpis["inf"].steps is None
    assert kpis["inf"].sleep_status == "inf hrs" and kpis["inf"].resting_hr_text == "inf bpm"

    none = spark.createDataFrame([], "user_id string, date date, deep_sleep_minutes double, light_sleep_minutes double, rem_sleep_minutes double, awake_minutes double")
    heart = spark.createDataFrame([], "user_id string, date date, avg_resting_heart_rate double, avg_hrv_sdnn double, avg_blood_oxygen double")
    sport = spark.createDataFrame([], "user_id string, workout_type string, start_date timestamp_ntz, duration_minutes double, total_energy_kcal double, total_distance_km double")
    texts = {r.user_id: r.context for r in serve.coach_context(activity, none, heart, sport).collect()}
    assert "Steps: 5,000 | Active Energy: 300.0 kcal" in texts["good"]
    assert "Steps: inf | Active Energy: N/A | Distance: 1000000000000000000000000000000.0 km" in texts["inf"]


def test_histories_of_a_user_stand_together_and_in_order(spark):
    rows = [(f"u{i % 7}", D(2024, 1, 1) + dt.timedelta(days=i * 37 % 200), *[float(i)] * 4) for i in range(600)]
    history = serve.energy_trend(activity(spark, rows).repartition(16, "user_id", "date"))
    placed = history.withColumn("part", F.spark_partition_id()).collect()
    assert len(placed) == 600 and len({(r.user_id, r.part) for r in placed}) == 7
    for user in {r.user_id for r in placed}:
        dates = [r.date for r in placed if r.user_id == user]
        assert dates == sorted(dates)
