"""Failure flags from sensor physics, class labels, and the gate-and-detail rule."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import mechanical_stress, power_watts, temp_diff_kelvin


def _per_type(limits: dict[str, int], default: int, type_col: Column) -> Column:
    chain = F
    for machine_type, limit in limits.items():
        chain = chain.when(type_col == machine_type, F.lit(limit))
    return chain.otherwise(F.lit(default))


def wear_limit(type_col: Column) -> Column:
    return _per_type(S.WEAR_LIMITS, S.WEAR_LIMIT_DEFAULT, type_col)


def strain_limit(type_col: Column) -> Column:
    return _per_type(S.STRAIN_LIMITS, S.STRAIN_LIMIT_DEFAULT, type_col)


def failure_conditions(type_col: Column) -> dict[str, Column]:
    """What each failure mode looks like in the sensors, before the failure gate."""
    watts = power_watts()
    return {
        "twf": F.col("tool_wear_minutes") >= wear_limit(type_col),
        "hdf": (F.col("rotational_speed_rpm") < S.HDF_MAX_RPM) & (temp_diff_kelvin() < S.HDF_MAX_TEMP_DIFF),
        "pwf": (watts < S.PWF_MIN_WATTS) | (watts > S.PWF_MAX_WATTS),
        "osf": mechanical_stress() > strain_limit(type_col),
        "rnf": F.lit(False),
    }


def failure_flags(gate: Column, type_col: Column) -> dict[str, Column]:
    """0/1 flag columns; all zero where the gate is 0 or null."""
    open_gate = F.coalesce(gate, F.lit(0)) != 0
    return {
        name: F.when(open_gate & condition, 1).otherwise(0)
        for name, condition in failure_conditions(type_col).items()
    }


def failure_label() -> Column:
    """First active flag by precedence, else ``none``; random failures do not count."""
    chain = F
    for flag in S.LABEL_PRECEDENCE:
        chain = chain.when(F.col(flag) == 1, F.lit(flag))
    return chain.otherwise(F.lit("none"))


def label_to_index(label: Column) -> Column:
    chain = F
    for index, name in enumerate(S.FAILURE_CLASSES):
        chain = chain.when(label == name, F.lit(index))
    return chain


def index_to_label(index: Column) -> Column:
    classes = F.array(*[F.lit(c) for c in S.FAILURE_CLASSES])
    return F.try_element_at(classes, (index + 1).cast("int"))


def gated_failure_type(gate: Column, detail: Column | None) -> Column:
    """The detail model speaks only when the gate is 1, and ``none`` means unknown."""
    if detail is None:
        return F.lit(None).cast("string")
    return F.when((gate == 1) & (detail != "none"), detail)


def target_kind(failure_type: Column) -> Column:
    return F.when(failure_type.isNull(), F.lit("binary")).otherwise(F.lit("multiclass"))


def label_training_rows(df: DataFrame) -> DataFrame:
    """Adds ``failure_type`` (name) and ``failure_class`` (number) to a training frame."""
    return df.withColumn("failure_type", failure_label()).withColumn(
        "failure_class", label_to_index(F.col("failure_type"))
    )


def failure_rate(mode: Column, position: Column, n_readings: Column) -> Column:
    """Planned failure share at a zero-based position in a run of ``n_readings``."""
    progress = position / F.greatest(n_readings - F.lit(1), F.lit(1))
    ramp = F.lit(S.BASE_FAILURE_RATE) + progress * F.lit(S.DRIFT_PEAK_RATE - S.BASE_FAILURE_RATE)
    second_half = position >= F.floor(n_readings / F.lit(2))
    return (
        F.when(mode == "gradual-drift", ramp)
        .when((mode == "sudden-spike") & second_half, F.lit(S.SPIKE_RATE))
        .otherwise(F.lit(S.BASE_FAILURE_RATE))
    )


def hash_fraction(key: Column, seed: int = S.SPLIT_SEED) -> Column:
    """A repeatable pseudo-random number in [0, 1) from a key."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def apply_failure_stress(df: DataFrame, chosen: Column, key: Column, seed: int = S.SPLIT_SEED) -> DataFrame:
    """Shift the sensors of ``chosen`` rows towards failure zones.

    A fixed share gets a narrow temperature gap; the rest slow down under more
    torque. Which rows get which is decided by a hash of ``key``, so a rerun
    or a recomputed partition gives the same table.
    """
    heat = chosen & (hash_fraction(key, seed) < S.STRESS_HDF_SHARE)
    load = chosen & ~heat
    rpm, torque = F.col("rotational_speed_rpm"), F.col("torque_nm")
    return df.withColumns(
        {
            "process_temperature_kelvin": F.when(
                heat, F.round(F.col("air_temperature_kelvin") + S.STRESS_TEMP_OFFSET, 1)
            ).otherwise(F.col("process_temperature_kelvin")),
            "rotational_speed_rpm": F.when(
                load, F.greatest(F.lit(S.STRESS_MIN_RPM).cast(df.schema["rotational_speed_rpm"].dataType),
                                 rpm - F.lit(S.STRESS_RPM_SHIFT))
            ).otherwise(rpm),
            "torque_nm": F.when(
                load, F.round(F.greatest(F.lit(0.0), torque + S.STRESS_TORQUE_ADD), 1)
            ).otherwise(torque),
        }
    )
