"""The feature transform shared by training, scoring and streaming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse import schemas as S


def power_watts() -> Column:
    """Shaft power in watts, kept in the operation order all results rest on."""
    return F.col("torque_nm") * F.col("rotational_speed_rpm") * F.lit(2) * F.lit(S.PI_APPROX) / F.lit(60)


def power_kw() -> Column:
    return power_watts() / F.lit(1000)


def temp_diff_kelvin() -> Column:
    return F.col("process_temperature_kelvin") - F.col("air_temperature_kelvin")


def mechanical_stress() -> Column:
    return F.col("torque_nm") * F.col("tool_wear_minutes")


def to_clean_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({**S.ID_COLUMNS, **S.RAW_TO_CLEAN})


def to_raw_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({clean: raw for raw, clean in {**S.ID_COLUMNS, **S.RAW_TO_CLEAN}.items()})


def engineer_features(df: DataFrame) -> DataFrame:
    """Clean names plus the three derived features; works on batch and streaming frames."""
    return to_clean_names(df).withColumns(
        {
            "power_kw": power_kw(),
            "temp_diff_kelvin": temp_diff_kelvin(),
            "mechanical_stress": mechanical_stress(),
        }
    )


def feature_frame(df: DataFrame, *extra: str) -> DataFrame:
    """Only the model features, and whatever target or key columns are named."""
    require_features(df)
    return df.select(*S.FEATURES, *extra)


def missing_features(df: DataFrame) -> list[str]:
    return [name for name in S.FEATURES if name not in df.columns]


def require_features(df: DataFrame) -> None:
    missing = missing_features(df)
    if missing:
        raise ValueError(f"feature columns missing: {missing}")
