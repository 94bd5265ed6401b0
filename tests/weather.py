"""Raw documents for the tests of feeds and hops."""

import json

LONDON = {"lat": 51.5, "lon": -0.1, "timezone": "Europe/London", "timezone_offset": 3600}
LIMA = {"lat": -12.0, "lon": -77.0, "timezone": "America/Lima", "timezone_offset": -18000}

NOON = 1704110400  # 2024-01-01 12:00:00 UTC
HOUR, DAY = 3600, 86400


def weather(*numbers):
    return [
        {"id": n, "main": f"main{n}", "description": f"description {n}", "icon": f"{n}d"}
        for n in numbers
    ]


def document(dt, place=LONDON, numbers=(800,), **arrays):
    current = {
        "dt": dt, "sunrise": dt - 4 * HOUR, "sunset": dt + 4 * HOUR,
        "temp": 281.66, "feels_like": 280.5, "pressure": 1012, "humidity": 81,
        "dew_point": 275.25, "uvi": 0.5, "clouds": 75, "visibility": 10000,
        "wind_speed": 4.5, "wind_deg": 250, "wind_gust": 8.25, "weather": weather(*numbers),
    }
    return {**place, "current": current, **arrays}


def hour(dt, **more):
    return {"dt": dt, "temp": 280.0, "feels_like": 279.9, "pressure": 1000, "humidity": 50,
            "dew_point": 270.5, "uvi": 0.0, "clouds": 10, "visibility": 9000, "wind_speed": 3.5,
            "wind_deg": 10, "wind_gust": 6.5, "pop": 0.25, "weather": weather(500), **more}


def day(dt, **more):
    return {"dt": dt, "sunrise": dt - 4 * HOUR, "sunset": dt + 4 * HOUR, "moonrise": dt + HOUR,
            "moonset": dt - HOUR, "moon_phase": 0.25,
            "temp": {"day": 283.5, "min": 279.5, "morn": 280.5, "eve": 282.25, "night": 281.5},
            "feels_like": {"day": 1.5, "night": 2.5, "morn": 3.5, "eve": 4.5},
            "pressure": 1001, "humidity": 60, "dew_point": 274.5, "wind_deg": 20,
            "wind_gust": 9.5, "clouds": 30, "rain": 1.25, "uvi": 2.5, "pop": 0.75,
            "weather": weather(600), **more}


def minute(dt, precipitation):
    return {"dt": dt, "precipitation": precipitation}


def write_json(path, documents):
    path.mkdir(parents=True, exist_ok=True)
    file = path / f"part-{len(list(path.iterdir()))}.json"
    file.write_text("".join(json.dumps(d) + "\n" for d in documents))
    return str(path)
