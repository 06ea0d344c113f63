"""Hand-written raw records, and helpers that lay them out as landed files."""

import json
import os

T1 = "2026-05-08T12:00:00+00:00"
T2 = "2026-05-09T12:00:00.5+00:00"
DAY1, DAY2 = "2026-05-08", "2026-05-09"


def record(id, title="Item", price=10.0, category="tools", rating=None, at=T1, **more):
    row = {"id": id, "title": title, "price": price, "category": category, "_ingested_at": at, **more}
    if rating is not None:
        rate, count = rating
        row["rating"] = {"rate": rate, "count": count}
    return row


def write_array(raw, day, name, records):
    write_text(raw, day, name, json.dumps(records, ensure_ascii=False, indent=2))


def write_lines(raw, day, name, records):
    write_text(raw, day, name, "".join(json.dumps(r) + "\n" for r in records))


def write_text(raw, day, name, text):
    folder = os.path.join(raw, f"ingest_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(text)


def by_key(df, key="id"):
    found = {}
    for row in df.collect():
        assert row[key] not in found, f"key {row[key]} occurs twice"
        found[row[key]] = row
    return found
