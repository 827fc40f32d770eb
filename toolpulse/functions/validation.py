"""Range and presence rules for incoming readings, and the valid / quarantine split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted domain of a reading.
TYPE_PATTERN = "^[LMH]$"
TEMPERATURE_OPEN = (270.0, 320.0)
RPM_OPEN = (0.0, 3000.0)
TORQUE_HALF_OPEN = (0.0, 100.0)
WEAR_CLOSED = (0.0, 260.0)


def reading_rules(type_col: str = "machine_type") -> dict[str, Column]:
    """Rule name to a condition that is true for a good reading and null for a missing field."""
    air, process = F.col("air_temperature_kelvin"), F.col("process_temperature_kelvin")
    rpm, torque, wear = F.col("rotational_speed_rpm"), F.col("torque_nm"), F.col("tool_wear_minutes")
    low, high = TEMPERATURE_OPEN
    return {
        type_col: F.col(type_col).rlike(TYPE_PATTERN),
        "air_temperature_kelvin": (air > low) & (air < high),
        "process_temperature_kelvin": (process > low) & (process < high),
        "rotational_speed_rpm": (rpm > RPM_OPEN[0]) & (rpm < RPM_OPEN[1]),
        "torque_nm": (torque >= TORQUE_HALF_OPEN[0]) & (torque < TORQUE_HALF_OPEN[1]),
        "tool_wear_minutes": (wear >= WEAR_CLOSED[0]) & (wear <= WEAR_CLOSED[1]),
    }


def validate_readings(df: DataFrame, type_col: str = "machine_type") -> DataFrame:
    """Adds ``reject_reasons`` (e.g. ``torque_nm:missing``) and ``is_valid``."""
    reasons = []
    for name, good in reading_rules(type_col).items():
        reasons.append(
            F.when(F.col(name).isNull(), F.lit(f"{name}:missing")).when(
                ~F.coalesce(good, F.lit(False)), F.lit(f"{name}:out_of_range")
            )
        )
    return df.withColumn("reject_reasons", F.array_compact(F.array(*reasons))).withColumn(
        "is_valid", F.size("reject_reasons") == 0
    )


def split_valid(df: DataFrame, type_col: str = "machine_type") -> tuple[DataFrame, DataFrame]:
    checked = validate_readings(df, type_col)
    return (
        checked.where("is_valid").drop("is_valid", "reject_reasons"),
        checked.where("NOT is_valid").drop("is_valid"),
    )
