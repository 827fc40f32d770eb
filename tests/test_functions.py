import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse import schemas as S
from toolpulse.functions import features, labels, text, validation


def test_feature_formulas(spark):
    raw = spark.createDataFrame(
        [("M", 300.0, 310.0, 1500, 40.0, 100)], ["Type", *list(S.RAW_TO_CLEAN)[1:6]]
    )
    row = features.engineer_features(raw).first()
    assert row["power_kw"] == pytest.approx(6.28318)
    assert row["temp_diff_kelvin"] == 10.0
    assert row["mechanical_stress"] == 4000.0
    assert features.missing_features(features.engineer_features(raw)) == []


def test_missing_feature_is_reported(training):
    with pytest.raises(ValueError, match="torque_nm"):
        features.feature_frame(training.drop("torque_nm"))


def test_raw_names_round_trip(training):
    assert features.to_clean_names(features.to_raw_names(training)).columns == training.columns


def sensor(spark, **changes):
    base = dict(type="L", air_temperature_kelvin=300.0, process_temperature_kelvin=310.0,
                rotational_speed_rpm=1500, torque_nm=40.0, tool_wear_minutes=100, gate=1)
    return spark.createDataFrame([Row(**{**base, **changes})])


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, set()),
        ({"tool_wear_minutes": 200}, {"twf"}),
        ({"tool_wear_minutes": 199}, set()),
        ({"type": "M", "tool_wear_minutes": 219}, set()),
        ({"type": "M", "tool_wear_minutes": 220}, {"twf"}),
        ({"type": "Z", "tool_wear_minutes": 239}, set()),
        ({"rotational_speed_rpm": 1379, "process_temperature_kelvin": 308.5}, {"hdf"}),
        ({"rotational_speed_rpm": 1380, "process_temperature_kelvin": 308.5}, set()),
        ({"torque_nm": 10.0}, {"pwf"}),
        ({"torque_nm": 60.0}, {"pwf"}),
        ({"torque_nm": 55.1, "tool_wear_minutes": 199, "rotational_speed_rpm": 1400}, set()),
        ({"torque_nm": 56.0, "tool_wear_minutes": 199, "rotational_speed_rpm": 1400}, {"osf"}),
        ({"tool_wear_minutes": 240, "gate": 0}, set()),
        ({"tool_wear_minutes": 240, "gate": None}, set()),
    ],
)
def test_failure_flags(spark, changes, expected):
    if changes.get("gate", 1) is None:
        df = sensor(spark, **{**changes, "gate": 0}).withColumn("gate", F.lit(None).cast("int"))
    else:
        df = sensor(spark, **changes)
    row = df.select(*[c.alias(n) for n, c in labels.failure_flags(F.col("gate"), F.col("type")).items()]).first()
    assert {n for n, v in row.asDict().items() if v} == expected
    assert row["rnf"] == 0


def test_label_precedence_and_index(spark):
    rows = [(1, 1, 1, 1, "twf", 4), (0, 1, 1, 1, "hdf", 0), (0, 0, 1, 1, "pwf", 3), (0, 0, 0, 1, "osf", 2), (0, 0, 0, 0, "none", 1)]
    df = spark.createDataFrame(rows, "twf int, hdf int, pwf int, osf int, name string, number int")
    out = df.withColumn("label", labels.failure_label()).withColumn("index", labels.label_to_index(F.col("label")))
    out = out.withColumn("back", labels.index_to_label(F.col("index")))
    for row in out.collect():
        assert (row["label"], row["index"], row["back"]) == (row["name"], row["number"], row["name"])


def test_gate_and_detail_rule(spark):
    df = spark.createDataFrame([(0, "osf"), (1, "osf"), (1, "none")], "gate int, detail string")
    got = [r[0] for r in df.select(labels.gated_failure_type(F.col("gate"), F.col("detail"))).collect()]
    assert got == [None, "osf", None]
    assert df.select(labels.gated_failure_type(F.col("gate"), None).alias("t")).where("t is not null").isEmpty()


def test_failure_rate_schedule(spark):
    df = spark.createDataFrame(
        [("normal", 9, 10), ("gradual-drift", 0, 10), ("gradual-drift", 9, 10), ("gradual-drift", 0, 1),
         ("sudden-spike", 4, 10), ("sudden-spike", 5, 10), ("other", 5, 10)],
        "mode string, i int, n int",
    )
    got = [r[0] for r in df.select(labels.failure_rate(F.col("mode"), F.col("i"), F.col("n"))).collect()]
    assert got == pytest.approx([0.034, 0.034, 0.25, 0.034, 0.034, 0.40, 0.034])


def test_stress_share_and_repeatability(spark):
    df = spark.range(20000).select(
        "id", F.lit(300.0).alias("air_temperature_kelvin"), F.lit(310.0).alias("process_temperature_kelvin"),
        F.lit(800).alias("rotational_speed_rpm"), F.lit(40.0).alias("torque_nm"),
    )
    out = labels.apply_failure_stress(df, F.lit(True), F.col("id"))
    row = out.agg(
        F.avg((F.col("process_temperature_kelvin") == 308.2).cast("int")).alias("hot"),
        F.avg((F.col("torque_nm") == 58.0).cast("int")).alias("loaded"),
        F.min("rotational_speed_rpm").alias("rpm"),
    ).first()
    assert row["hot"] == pytest.approx(S.STRESS_HDF_SHARE, abs=0.02)
    assert row["hot"] + row["loaded"] == pytest.approx(1.0)
    assert row["rpm"] == S.STRESS_MIN_RPM
    assert out.exceptAll(labels.apply_failure_stress(df.repartition(7), F.lit(True), F.col("id"))).isEmpty()


def test_validation_bounds(spark):
    good = ("M", 300.0, 310.0, 1500.0, 40.0, 100.0)
    cases = [
        (good, ""),
        (("X", *good[1:]), "machine_type:out_of_range"),
        (("LL", *good[1:]), "machine_type:out_of_range"),
        (("M", 270.0, *good[2:]), "air_temperature_kelvin:out_of_range"),
        (("M", 300.0, 320.0, *good[3:]), "process_temperature_kelvin:out_of_range"),
        ((*good[:3], 0.0, *good[4:]), "rotational_speed_rpm:out_of_range"),
        ((*good[:4], 100.0, 100.0), "torque_nm:out_of_range"),
        ((*good[:4], 0.0, 260.0), ""),
        ((*good[:5], None), "tool_wear_minutes:missing"),
        (("M", None, 310.0, 1500.0, -1.0, 261.0),
         "air_temperature_kelvin:missing,torque_nm:out_of_range,tool_wear_minutes:out_of_range"),
    ]
    df = spark.createDataFrame([(*v, e) for v, e in cases], T.StructType([*S.REQUEST_READING, T.StructField("expected", T.StringType())]))
    for row in validation.validate_readings(df).collect():
        assert ",".join(row["reject_reasons"]) == row["expected"]
        assert row["is_valid"] == (row["expected"] == "")


def test_status_line_and_ids(spark):
    c = F.col
    df = spark.createDataFrame(
        [(251, "14:26:45", "machine_04", "H", 58.7, 187.0, 1188.0, 1, "hdf", 0.87, 0.4, 1), (1, "14:23:05", "machine_02", "L", 42.1, 45.0, 1538.0, 0, None, 0.03, 0.034, 0)],
        "n long, t string, m string, k string, q double, w double, r double, p int, ft string, pr double, ra double, inj int",
    )
    line = text.status_line(c("n"), c("t"), c("m"), c("k"), c("q"), c("w"), c("r"), text.status_label(c("p"), c("ft")), c("pr"), c("ra"), c("inj"))
    got = [r[0] for r in df.select(line).collect()]
    assert got[0] == "[0251 | 14:26:45]  machine_04  H  T=058.7Nm  W=187min  rpm=1188  → HDF ⚠       p=0.87  (rate=40%)  [injected]"
    assert got[1] == "[0001 | 14:23:05]  machine_02  L  T=042.1Nm  W=045min  rpm=1538  → normal      p=0.03  (rate=3%)"
    assert df.select(text.product_id(F.lit("M"), F.lit(1))).first()[0] == "M20001"
    assert df.select(text.product_id(F.lit("M"), F.lit(123456))).first()[0] == "M143456"


def test_triage_order(spark):
    df = spark.createDataFrame([("getaddrinfo failed then 401",), ("HTTP 403",), ("fine",)], "m string")
    assert [r[0] for r in df.select(text.triage(F.col("m"), text.JOB_LOG_CAUSES)).collect()] == ["no_network", "login_failed", None]


def test_report_without_auc(spark):
    row = spark.createDataFrame([(0.9, 0.8, 0.7, 0.01)], "f1_test double, precision_test double, recall_test double, brier_score double")
    lines = [r["line"] for r in text.metrics_report(row).orderBy("line_no").collect()]
    assert lines == ["# Training Metrics", "", "f1_test:        0.9000", "precision_test: 0.8000", "recall_test:    0.7000",
                     "brier_score:    0.0100  (lower is better; 0 = perfect)"]
    with_auc = text.metrics_report(row.withColumn("roc_auc_test", F.lit(0.5)))
    assert with_auc.count() == 7
