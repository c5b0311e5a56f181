"""Schemas of the raw mark rows and the crawl catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of a raw mark row and its three integer columns.
RAW_COLUMNS = ["Division", "School", "Gender", "SeasonLabel", "SeasonYear", "ListHnd", "SeasonHnd",
               "SourceURL", "Team", "Event", "Athlete", "ClassYear", "MarkOrTime", "Wind", "Meet",
               "MeetDate"]
INT_COLUMNS = ("SeasonYear", "ListHnd", "SeasonHnd")
STRING_COLUMNS = [c for c in RAW_COLUMNS if c not in INT_COLUMNS]

RAW_SCHEMA = T.StructType([
    T.StructField(c, T.IntegerType() if c in INT_COLUMNS else T.StringType(), True)
    for c in RAW_COLUMNS
])

# Required catalogue columns.
CATALOGUE_COLUMNS = ["division", "school", "gender", "year", "season", "url"]
CATALOGUE_SCHEMA = T.StructType([
    T.StructField("division", T.StringType()), T.StructField("school", T.StringType()),
    T.StructField("gender", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("season", T.StringType()), T.StructField("url", T.StringType()),
])

# The season dimension (year, label, list handle, season handle).
SEASONS = [
    (2025, "Outdoors", 5027, 681),
    (2025, "Indoors", 4874, 661),
    (2024, "Outdoors", 4541, 645),
    (2024, "Indoors", 4466, 627),
    (2023, "Outdoors", 4153, 608),
    (2023, "Indoors", 3909, 584),
    (2022, "Outdoors", 3730, 568),
    (2022, "Indoors", 3501, 548),
    (2021, "Outdoors", 3200, 530),
    (2021, "Indoors", 3167, 519),
]
