"""Column names, row types and metric specifications."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SENSOR = ["datasourceId", "sourceId"]
CELL = ["type", "date", "datasourceId"]
SOURCE_CELL = [*CELL, "sourceId"]

# Period types from the coarsest to the finest.
TYPE_ORDER = ["year", "season", "month", "week", "day", "hour"]

# Metrics carried by the map features.
FEATURE_METRICS = [
    "pm10ConcMassNowcast",
    "pm10ConcMassNowcastUsEpaAqi",
    "pm2_5ConcMassNowcast",
    "pm2_5ConcMassNowcastUsEpaAqi",
]

# Columns of the minute readings.
PM25_RAW = "pm2_5ConcMassIndividual.raw"
HUMIDITY_RAW = "relHumidInternalIndividual.raw"
TEMPERATURE_RAW = "temperatureInternalIndividual.raw"
PM25_CALIBRATED = "pm2_5ConcMassIndividual.calibrated"

# Plausible closed ranges of the minute readings.
PLAUSIBLE = {
    PM25_RAW: (0.0, 500.0),
    HUMIDITY_RAW: (0.0, 100.0),
    TEMPERATURE_RAW: (-20.0, 140.0),
}

# A period is valid when it has more than this many valid parts.
MIN_PARTS = {"day": 20, "week": 5, "month": 21, "season": 60, "year": 250}

# The columns of the location table.
LOCATION_COLUMNS = [
    "datasourceId", "sourceId", "currentSourceId", "sourceType",
    "locationLatitude", "locationLongitude", "name", "group", "tags",
    "community", "comarea", "ward", "zip",
]


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

MEASUREMENT_IDS = struct(
    datasourceId=_S, sourceId=_S, sourceType=_S,
    locationLatitude=_D, locationLongitude=_D,
)

LONG_ROW = struct(datasourceId=_S, time=_S, metric=_S, value=_D, raw=_D, status=_S)
LOCATION_ROW = struct(datasourceId=_S, lat=_D, lon=_D)
LONG_RESPONSE = struct(
    request=T.MapType(_S, _S),
    data=T.ArrayType(LONG_ROW),
    locations=T.ArrayType(LOCATION_ROW),
)

DATASOURCES = struct(
    datasourceId=_S, currentSubscriptionId=_S, currentSourceId=_S,
    orgAnnotations=struct(name=_S, group=_S, tags=T.ArrayType(_S)),
)

PERIODS = struct(
    datasourceId=_S, sourceId=_S, date=_S, type=_S,
    metric=_D, n_valid=_L, is_valid=T.BooleanType(),
)

CELLS = struct(type=_S, date=_S, datasourceId=_S, value=_D)
SOURCE_CELLS = struct(type=_S, date=_S, datasourceId=_S, sourceId=_S, value=_D)

LOCATIONS = T.StructType([
    T.StructField(c, _D if c.startswith("location") else T.ArrayType(_S) if c == "tags" else _S, True)
    for c in LOCATION_COLUMNS
])

POLES = struct(
    sensorID=_L, Candidate=T.IntegerType(), ComArea=T.IntegerType(), Ward=T.IntegerType(),
    Zip=T.IntegerType(), FEATURE_ID=_S, Address=_S, Latitude=_D, Longitude=_D, _ord=_L,
)

SITES = T.StructType([
    T.StructField("EPA Grid Point ID", _L), T.StructField("Zipcode", T.IntegerType()),
    T.StructField("Community Area Number", T.IntegerType()),
    T.StructField("Ward Number", T.IntegerType()),
])


@dataclass(frozen=True)
class MetricSpec:
    """What to read, clean and publish for one metric."""

    name: str
    col_name: str
    output_frequency: str = "hour"
    metric_select: str | None = None
    min_obs_per_hour: int = 1
    cleaner: str = "hourly"
    qc: bool | str = False
    rename_columns: dict[str, str] = field(default_factory=dict)

    @property
    def drops_invalid(self) -> bool:
        return self.qc is True or self.qc == "true"

    @property
    def time_column(self) -> str:
        return "time" if self.output_frequency == "minute" else "endOfPeriod"


_HOURLY_RENAMES = {"outputFrequency": "type", "endOfPeriod": "date"}

# The metrics, their columns, selections and rename maps.
METRICS = {
    spec.name: spec
    for spec in [
        MetricSpec("nowcast_aqi", "pm2_5ConcMassNowcastUsEpaAqi.value",
                   metric_select="only *nowcast*", qc=True, rename_columns=_HOURLY_RENAMES),
        MetricSpec("hourly_pm25", "pm2_5ConcMass1HourMean.value",
                   metric_select="only :pm25", qc=True, rename_columns=_HOURLY_RENAMES),
        MetricSpec("hourly_no2", "no2Conc1HourMean.value",
                   metric_select="only :no2", qc=True, rename_columns=_HOURLY_RENAMES),
        MetricSpec("mean_pm25", "pm2_5ConcMassIndividual.value",
                   output_frequency="minute", metric_select="only :pm25 + :internal",
                   min_obs_per_hour=3, cleaner="minute_pm25", qc=True),
    ]
}

DEFAULT_METRICS = ["nowcast_aqi", "hourly_pm25", "hourly_no2"]
