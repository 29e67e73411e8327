"""Names of the trip data format."""

# Column names, their order and the model names are part of the
# data format; feature index -> name lookups depend on the order of FEATURES.
TIME = "RecordedAtTime"
LABEL = "DistanceFromStop"

COORDINATES = (
    "OriginLat", "OriginLong",
    "DestinationLat", "DestinationLong",
    "VehicleLocationLatitude", "VehicleLocationLongitude",
)
CALENDAR = (
    "Hour", "DayOfWeek", "Month", "WeekOfYear",
    "IsMorningPeak", "IsEveningPeak", "IsWeekend",
    "DayOfMonth", "DayOfYear", "IsMonthEnd", "IsMonthStart",
    "Hour_sin", "Hour_cos", "DayOfWeek_sin", "DayOfWeek_cos",
    "Month_sin", "Month_cos",
)
FEATURES = COORDINATES + CALENDAR
NUMERIC = COORDINATES + (LABEL,)
REQUIRED = (
    "OriginName", "DestinationName", "NextStopPointName",
    "VehicleLocationLatitude", "VehicleLocationLongitude", LABEL,
)
CATEGORICAL = (
    "PublishedLineName", "OriginName", "DestinationName",
    "NextStopPointName", "DirectionRef",
)
ENSEMBLE = "Ensemble_Top3"
SPLITS = ("train", "test", "val")
