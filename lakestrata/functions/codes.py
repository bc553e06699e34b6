"""Code-to-text maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"

# WMO weather interpretation codes.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}


def describe(code: Column, names: dict[int, str], default: str = UNKNOWN) -> Column:
    """The text of a code; the default for a code that is missing or not listed."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit(default))
