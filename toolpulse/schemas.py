"""Table schemas and the fixed values every other module shares."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Column names, limits, rates and thresholds that results depend on. They are
# given by the data model, not tuned here.

RAW_TO_CLEAN = {
    "Type": "type",
    "Air temperature [K]": "air_temperature_kelvin",
    "Process temperature [K]": "process_temperature_kelvin",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_minutes",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}
ID_COLUMNS = {"UDI": "udi", "Product ID": "product_id"}

NUMERIC_FEATURES = [
    "air_temperature_kelvin",
    "process_temperature_kelvin",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_minutes",
    "power_kw",
    "temp_diff_kelvin",
    "mechanical_stress",
]
CATEGORICAL_FEATURES = ["type"]
MEASURED = CATEGORICAL_FEATURES + NUMERIC_FEATURES[:5]
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
MACHINE_TYPES = ["H", "L", "M"]

# Index in this list is the class number of the multiclass target.
FAILURE_CLASSES = ["hdf", "none", "osf", "pwf", "twf"]
# Which flag names the failure when several are set.
LABEL_PRECEDENCE = ["twf", "hdf", "pwf", "osf"]

PI_APPROX = 3.14159
WEAR_LIMITS = {"L": 200, "M": 220, "H": 240}
WEAR_LIMIT_DEFAULT = 240
STRAIN_LIMITS = {"L": 11000, "M": 12000, "H": 13000}
STRAIN_LIMIT_DEFAULT = 11000
HDF_MAX_RPM = 1380.0
HDF_MAX_TEMP_DIFF = 8.6
PWF_MIN_WATTS = 3500.0
PWF_MAX_WATTS = 9000.0
PRODUCT_NUMBER_BASE = 20000

BASE_FAILURE_RATE = 0.034
DRIFT_PEAK_RATE = 0.25
SPIKE_RATE = 0.40
STRESS_HDF_SHARE = 0.339
STRESS_TEMP_OFFSET = 8.2
STRESS_RPM_SHIFT = 350
STRESS_TORQUE_ADD = 18.0
STRESS_MIN_RPM = 500
TOOL_WEAR_STEP = 2
TOOL_WEAR_RESET = 216

DRIFT_SHARE = 0.2
DISTANCE_THRESHOLD = 0.1
P_VALUE_THRESHOLD = 0.05
SMALL_SAMPLE_ROWS = 1000
FEW_VALUES = 5
LOW_SAMPLE_ROWS = 30
CURRENT_ROW_LIMIT = 10000
TRAINING_WINDOW = 50000

TEST_SIZE = 0.2
SPLIT_SEED = 42
CV_FOLDS = 5
CALIBRATION_FOLDS = 3
OVERFIT_LIMIT = 0.10
MIN_F1_BINARY = 0.85
MIN_F1_MULTICLASS = 0.60
# --- end of fixed values ----------------------------------------------------

FLAGS = ["twf", "hdf", "pwf", "osf", "rnf"]

TRAINING_SCHEMA = T.StructType(
    [
        T.StructField("udi", T.LongType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("air_temperature_kelvin", T.DoubleType()),
        T.StructField("process_temperature_kelvin", T.DoubleType()),
        T.StructField("rotational_speed_rpm", T.IntegerType()),
        T.StructField("torque_nm", T.DoubleType()),
        T.StructField("tool_wear_minutes", T.IntegerType()),
        T.StructField("machine_failure", T.IntegerType()),
    ]
    + [T.StructField(f, T.IntegerType()) for f in FLAGS]
)
TRAINING_COLUMNS = TRAINING_SCHEMA.fieldNames()

RAW_TRAINING_SCHEMA = T.StructType(
    [
        T.StructField(raw, TRAINING_SCHEMA[clean].dataType)
        for raw, clean in {**ID_COLUMNS, **RAW_TO_CLEAN}.items()
    ]
)

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("reading_number", T.LongType(), False),
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("machine_type", T.StringType(), False),
        T.StructField("air_temperature_kelvin", T.DoubleType(), False),
        T.StructField("process_temperature_kelvin", T.DoubleType(), False),
        T.StructField("rotational_speed_rpm", T.DoubleType(), False),
        T.StructField("torque_nm", T.DoubleType(), False),
        T.StructField("tool_wear_minutes", T.DoubleType(), False),
        T.StructField("power_kw", T.DoubleType(), False),
        T.StructField("temp_diff_kelvin", T.DoubleType(), False),
        T.StructField("mechanical_stress", T.DoubleType(), False),
        T.StructField("predicted_failure", T.IntegerType(), False),
        T.StructField("predicted_failure_type", T.StringType(), True),
        T.StructField("failure_probability", T.DoubleType(), False),
        T.StructField("injected_failure", T.IntegerType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("target", T.StringType(), False),
        T.StructField("effective_failure_rate", T.DoubleType(), False),
    ]
)
READINGS_COLUMNS = READINGS_SCHEMA.fieldNames()

# One reading inside a scoring request; fields may be missing, so all nullable.
REQUEST_READING = T.StructType(
    [
        T.StructField("machine_type", T.StringType()),
        T.StructField("air_temperature_kelvin", T.DoubleType()),
        T.StructField("process_temperature_kelvin", T.DoubleType()),
        T.StructField("rotational_speed_rpm", T.DoubleType()),
        T.StructField("torque_nm", T.DoubleType()),
        T.StructField("tool_wear_minutes", T.DoubleType()),
    ]
)
REQUEST_COLUMNS = REQUEST_READING.fieldNames()

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("experiment", T.StringType(), False),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)
VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)
ALIASES_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("alias", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("set_at", T.TimestampType(), False),
    ]
)
CHECK_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), False),
        T.StructField("drift_detected", T.BooleanType(), False),
        T.StructField("retrain_triggered", T.BooleanType(), False),
    ]
)
