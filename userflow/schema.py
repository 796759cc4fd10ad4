"""Record, topic and result schemas.

Schemas are DDL text so that a reader can be given exactly the fields it needs:
``from_json`` only decodes what its schema names, and Catalyst prunes a JSON
schema by itself only when a single field is used.
"""

from __future__ import annotations

# The message-source row layout.
TOPIC = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

# The declared user record.
USER_FIELDS = {
    "id": "string",
    "gender": "string",
    "name": "string",
    "email": "string",
    "dob": "string",
    "age": "int",
    "location": "struct<country:string,city:string,"
    "coordinates:struct<latitude:double,longitude:double>>",
    "nationality": "string",
    "timestamp": "string",
}

# The same record read leniently: whatever differs between the declared and the
# raw published shape is kept as text and resolved by expressions afterwards.
TEXT_FIELDS = {
    **USER_FIELDS,
    "age": "string",
    "location": "struct<country:string,city:string,"
    "coordinates:struct<latitude:string,longitude:string>>",
    "nat": "string",
    "login": "string",
}

# A parsed user as it is landed: the record, its country, and its arrival.
LANDED_FIELDS = {
    **USER_FIELDS,
    "country": "string",
    "processed_timestamp": "timestamp",
    "arrival_date": "date",
}

COUNTRY_ONLY = "struct<country:string>"

# Result columns as they leave the aggregation, stamp included.
RESULTS = {
    "gender_distribution": "gender string, count bigint, timestamp timestamp",
    "age_distribution": "age_group string, count bigint, timestamp timestamp",
    "country_distribution": "country string, count bigint, timestamp timestamp",
    "user_inflow": "window_start timestamp, window_end timestamp, count bigint, "
    "timestamp timestamp",
    "avg_age_by_country": "country string, avg_age double, count bigint, "
    "timestamp timestamp",
}

# The columns that identify one row of each result.
RESULT_KEYS = {
    "gender_distribution": ["gender"],
    "age_distribution": ["age_group"],
    "country_distribution": ["country"],
    "user_inflow": ["window_start", "window_end"],
    "avg_age_by_country": ["country"],
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
