"""Small raw documents with the edge values of every feed."""

from __future__ import annotations

import json
import os


def document(area: int, minute: str, **changes) -> dict:
    """An area document; ``minute`` is ``YYYYMMDD HHmm``."""
    code, name = f"POI{area:03d}", f"area {area}"
    dashed = f"{minute[:4]}-{minute[4:6]}-{minute[6:8]} {minute[9:11]}:{minute[11:13]}"
    stems = [f"{s}_{d}_PPLTN_{b}" for s in ("ACML", "30WTHN", "10WTHN", "5WTHN") for d in ("GTON", "GTOFF")
             for b in ("MIN", "MAX")]
    doc = {
        "AREA_CD": code,
        "AREA_NM": name,
        "LIVE_CMRCL_STTS": {
            "CMRCL_TIME": minute, "AREA_CMRCL_LVL": "busy", "AREA_SH_PAYMENT_CNT": "12.5",
            "AREA_SH_PAYMENT_AMT_MIN": "", "AREA_SH_PAYMENT_AMT_MAX": 9000, "CMRCL_MALE_RATE": "55.125",
            "CMRCL_FEMALE_RATE": 44.9, "CMRCL_10_RATE": "abc", "CMRCL_20_RATE": None,
            "CMRCL_RSB": [
                {"RSB_LRG_CTGR": "food", "RSB_MID_CTGR": "cafe", "RSB_SH_PAYMENT_CNT": "3", "RSB_MCT_TIME": "202506"},
                {"RSB_LRG_CTGR": "food", "RSB_MID_CTGR": "bar", "RSB_SH_PAYMENT_CNT": "nan", "RSB_MCT_TIME": "202506"},
            ],
        },
        "LIVE_PPLTN_STTS": [
            {"AREA_NM": name, "AREA_CD": code, "AREA_CONGEST_LVL": "calm", "AREA_PPLTN_MIN": "100",
             "AREA_PPLTN_MAX": "200.7", "MALE_PPLTN_RATE": "48.5", "REPLACE_YN": None, "PPLTN_TIME": dashed}
        ],
        "EVENT_STTS": [
            {"EVENT_NM": "fair", "EVENT_PERIOD": "2025-07-01 ~ 2025-07-31", "EVENT_X": "127.0", "EVENT_Y": "",
             "PAY_YN": "N"}
        ],
        "WEATHER_STTS": [
            {"TEMP": "21.5", "HUMIDITY": "40.5", "PM10": "33", "AIR_IDX_MVL": "점검중", "WEATHER_TIME": dashed}
        ],
        "LIVE_SUB_PPLTN": {**{f"SUB_{s}": "10" for s in stems}, "SUB_STN_CNT": "2", "SUB_STN_TIME": "202506"},
        "LIVE_BUS_PPLTN": {**{f"BUS_{s}": None for s in stems}, "BUS_STN_CNT": "5", "BUS_STN_TIME": "2025-06"},
    }
    for key, value in changes.items():
        if isinstance(value, dict):
            doc[key] = {**doc[key], **value}
        else:
            doc[key] = value
    return doc


def land(base, area: int, minute: str, doc: dict | None = None, file_minute: str | None = None) -> None:
    """Write one document under its object key."""
    stamp = file_minute or minute
    folder = os.path.join(base, stamp[:8])
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{stamp[9:13]}_{area}.json"), "w", encoding="utf-8") as f:
        json.dump(doc or document(area, minute), f, ensure_ascii=False)
