"""File sources: landed payload documents and CSV history."""

import json
import os
import tempfile

import pytest

from aerocast.contract import DataQualityError
from aerocast.operators.store import split_supported
from aerocast.sources.files import flatten_payloads, payload_rejects, read_csv_history, read_payloads


def _payload(city, ts, pm25, with_components=True):
    comp = {"co": 437.01, "no": 0.5, "no2": 12.3, "o3": 40.2, "so2": 5.1, "pm2_5": pm25, "pm10": 27.05, "nh3": 1.0}
    item = {"main": {"aqi": 2}, "dt": 1785517206}
    if with_components:
        item["components"] = comp
    return {
        "timestamp": ts, "city": city, "latitude": "31.5204", "longitude": "74.3587",
        "air_pollution": {"coord": {"lon": 74.3587, "lat": 31.5204}, "list": [item]},
        "weather": {"main": {"temp": 31.2, "humidity": 60.0}, "wind": {"speed": 4.39, "deg": 120.0},
                    "dt": 1785517206, "name": city},
    }


def test_payload_documents_flatten_guard_and_reject(spark):
    d = tempfile.mkdtemp(prefix="payloads-")
    docs = [_payload("Lahore", "2026-07-31T17:00:06+00:00", 25.44),
            _payload("Karachi", "2026-07-31T17:00:00+00:00", 30.0),
            _payload("Lahore", "2026-07-31T18:00:06+05:00", 12.0, with_components=False)]
    for i, doc in enumerate(docs):
        with open(os.path.join(d, f"{i}.json"), "w") as fh:
            json.dump(doc, fh, indent=2)          # one pretty-printed document per file
    raw = read_payloads(spark, d, multi_line=True)
    flat = flatten_payloads(raw)
    assert payload_rejects(raw).count() == 1
    assert flat.count() == 3 and flat.where("pm2_5 IS NULL AND aqi IS NULL").count() == 1  # none vanishes
    flat = flat.where("pm2_5 IS NOT NULL")
    rows = {r.city: r for r in flat.collect()}
    assert rows["Lahore"].pm2_5 == 25.44 and rows["Lahore"].carbon_monoxide == 437.01
    assert rows["Lahore"].wind_speed == 4.39 and rows["Lahore"].aqi == 79.1  # 49 * 13.34 / 23.3 + 51 = 79.054
    supported = spark.createDataFrame([("Lahore",)], "city string")
    ok, refused = split_supported(flat, supported)
    assert [r.city for r in ok.collect()] == ["Lahore"]
    assert [r.city for r in refused.collect()] == ["Karachi"]


def test_csv_history_requires_columns_and_coerces(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "h.csv"), "w") as fh:
        fh.write("city,timestamp,pm10,pm2_5,carbon_monoxide,nitrogen_dioxide,sulphur_dioxide,ozone,extra\n")
        fh.write("A,2026-01-01T00:00:00Z,1,2,3,4,5,6,x\n")
        fh.write("A,2026-01-01T01:00:00+05:00,n/a,2,3,4,5,6,y\n")
        fh.write("B,2026-01-01T02:00:00,1,2,3,4,5,6,z\n")
    df = read_csv_history(spark, d, city="A").orderBy("timestamp").collect()
    assert len(df) == 2
    assert df[0].pm10 is None  # '+05:00' row is 20:00 on the day before, and 'n/a' -> NULL
    with open(os.path.join(d, "h.csv"), "w") as fh:
        fh.write("city,timestamp,pm10\nA,2026-01-01,1\n")
    with pytest.raises(DataQualityError, match="ozone"):
        read_csv_history(spark, d)
