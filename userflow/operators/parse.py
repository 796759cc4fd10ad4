"""Topic messages to user rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.functions.times import event_time
from userflow.schema import COUNTRY_ONLY, TEXT_FIELDS, USER_FIELDS, ddl

FIELDS = (*USER_FIELDS, "country")

# Which record fields a normalized output field is resolved from.
_SOURCES = {
    "id": ("id", "login"),
    "age": ("age", "dob"),
    "nationality": ("nationality", "nat"),
    "country": ("location",),
}


# What a record holds beside these keys is unknown. Keys below a key are listed where only they
# are read; a key without any is read whole.
_KNOWN = {
    "declared": dict.fromkeys(USER_FIELDS, {}),
    "normalized": {**dict.fromkeys(TEXT_FIELDS, {}), "login": {"uuid": {}}},
}
_PLACE = {"country": {}, "city": {}, "coordinates": {"latitude": {}, "longitude": {}}}
# The unknown keys, among the parsed columns.
UNKNOWN = "unknown"
# When the topic got a message, among the parsed columns.
ARRIVED = "arrived"
# A record's own time may lie so far beyond its message's arrival.
AHEAD = "5 minutes"


def decode(messages: DataFrame, arrival: bool = False) -> DataFrame:
    """Keep the message body only, as text; with ``arrival`` the topic's own time, too."""
    body = F.col("value").cast("string").alias("value")
    return messages.select(body, F.col("timestamp").alias(ARRIVED)) if arrival else messages.select(body)


def parse_users(
    messages: DataFrame,
    mode: str = "normalized",
    fields: Iterable[str] | None = None,
    skip_bad: bool = False,
    arrival: bool = False,
    unknown: bool = False,
) -> DataFrame:
    """User rows out of messages whose ``value`` holds one JSON record each.

    ``declared`` reads the fixed schema and nothing else: a field whose JSON type
    differs is null, provided ``spark.sql.json.enablePartialResults`` has its default.
    ``normalized`` also accepts the raw published shape: the age nested under
    ``dob``, ``nat`` for the nationality, ``login.uuid`` for the id, and coordinates
    or ages written as strings. It gives the same rows for both shapes whatever that
    setting is.

    A body that is no JSON object still gives one row, of nulls, because messages
    are counted whether or not they parse. ``skip_bad`` drops those rows.

    ``fields`` limits the columns, and with them what is decoded at all. ``arrival``
    adds the message's own ``timestamp`` as ``ARRIVED``, and ``unknown`` what
    ``unknown_keys`` keeps as ``UNKNOWN``, at the price of a second decoding.
    """
    wanted = FIELDS if fields is None else tuple(fields)
    strange = set(wanted) - set(FIELDS)
    if strange:
        raise ValueError(f"no such user fields: {sorted(strange)}")
    if mode == "declared":
        available, resolve = USER_FIELDS, _declared
    elif mode == "normalized":
        available, resolve = TEXT_FIELDS, _normalized
    else:
        raise ValueError(f"mode is 'declared' or 'normalized', not {mode!r}")

    body = decode(messages, arrival)
    extra = [ARRIVED] if arrival else []
    if unknown:
        body = body.withColumn(UNKNOWN, unknown_keys(F.col("value"), mode))
        extra.append(UNKNOWN)
    if not wanted and not skip_bad:
        return body.select(*extra)
    schema = _schema(wanted, available, mode) or "`id` string"
    if skip_bad:
        only = body.select(_strict(schema).alias("only"), *extra)
        users = only.select(F.col("only")[0].alias("user"), *extra)
    else:
        users = body.select(F.from_json("value", schema).alias("user"), *extra)
    return users.select(*(resolve(name).alias(name) for name in wanted), *extra)


def _strict(schema: str) -> Column:
    """A list of the record alone, for a body that is exactly one well-formed JSON
    object; other bodies have no row.

    Put into a list before a null, a body with anything more in it is no JSON, has
    more elements, or closes the list before the null. The rows come from a generator, below which Catalyst moves no filter,
    and the list is named once, so that each body is decoded once.
    """
    text = F.concat(F.lit("["), "value", F.lit(",null]"))
    listed = F.from_json(text, f"array<struct<{schema}>>")
    alone = F.filter(
        F.array(listed), lambda r: (F.size(r) == 2) & r[0].isNotNull() & r[1].isNull()
    )
    return F.explode(alone)


def unknown_keys(text: Column, mode: str = "normalized") -> Column:
    """What a record of JSON text holds beside the keys that ``parse_users`` reads, as a
    variant object, with unknown keys below ``location`` (and ``login``) in place.

    Null if there is nothing, and for text that is no JSON object or names a key twice: such a
    body has a row of its declared fields all the same. ``unknown_value`` reads from it.
    """
    known = {**_KNOWN[mode], "location": _PLACE}
    found = F.transform(F.array(F.try_parse_json(text)), lambda body: _beside(body, known))[0]
    return F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, F.to_variant_object(m)))[0]


def unknown_value(path: str, kind: str = "string", column: str = UNKNOWN) -> Column:
    """A value among the unknown keys, by its path (``$.device.os``); null if it is not there
    or cannot be read as ``kind``."""
    return F.try_variant_get(F.col(column), path, kind)


_KEYS = "map<string,variant>"


def _beside(value: Column, known: dict[str, dict]) -> Column:
    """The keys of a variant object that are not known, and below known ones those that are
    not; null if it is no object. Each object is taken apart once."""
    below = {key: keys for key, keys in known.items() if keys}

    def rest(own: Column) -> Column:
        parts = [F.map_filter(own, lambda key, _: ~key.isin(list(known)))]
        none = F.map_filter(own, lambda key, _: F.lit(False))
        inner = (_under(name, F.try_element_at(own, F.lit(name)), keys) for name, keys in below.items())
        return F.map_concat(*parts, *(F.coalesce(i, none) for i in inner))

    return F.transform(F.array(F.try_variant_get(value, "$", _KEYS)), lambda own: rest(own))[0]


def _under(name: str, value: Column, known: dict[str, dict]) -> Column:
    """What is unknown in the object below a key, by that key; null if there is nothing."""

    def named(own: Column) -> Column:
        return F.when(F.size(own) > 0, F.create_map(F.lit(name), F.to_variant_object(own)))

    return F.transform(F.array(_beside(value, known)), named)[0]


def stamp(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add ``processed_timestamp``: the given time, else the clock.

    On a stream the clock is one fixed value per micro-batch.
    """
    now = F.current_timestamp() if as_of is None else as_of
    return users.withColumn("processed_timestamp", now)


def with_event_time(
    users: DataFrame,
    name: str = "timestamp",
    kind: str = "timestamp",
    arrived: Column | None = None,
    ahead: str = AHEAD,
) -> DataFrame:
    """Turn the time text of the records into a time column called ``name``.

    Records are not to be trusted: with ``arrived``, a time more than ``ahead`` beyond
    it counts as that arrival, so that one wrong clock neither loses a row nor moves a
    watermark past all others. The query's observed metrics ``event_times`` count such
    rows as ``corrected``; rows that came too late for the watermark are in its state
    metrics as ``numRowsDroppedByWatermark``.

    A time window drops rows without a time. Catalyst would move that filter below
    the parse and decode every message once for the filter and once more for the
    row; it does not move a filter on generated rows below the generator.
    """
    kept = [c for c in users.columns if c != "timestamp"]
    told = event_time("timestamp", kind)
    if arrived is None:
        return users.select(*kept, F.explode(F.array(told)).alias(name))
    both = F.explode(F.array(F.struct(told.alias("told"), arrived.cast(kind).alias("arrived"))))
    timed = users.select(*kept, both.alias("_time"))
    early = F.col("_time.told") > F.col("_time.arrived") + F.expr(f"interval {ahead}")
    timed = timed.observe("event_times", F.count_if(early).alias("corrected"))
    time = F.when(early, F.col("_time.arrived")).otherwise(F.col("_time.told"))
    return timed.select(*kept, time.alias(name))


def _schema(wanted: tuple[str, ...], available: dict[str, str], mode: str) -> str:
    if mode == "declared":
        used = {"location" if name == "country" else name for name in wanted}
    else:
        used = {src for name in wanted for src in _SOURCES.get(name, (name,))}
    fields = {name: kind for name, kind in available.items() if name in used}
    if "location" in fields and "location" not in wanted:
        fields["location"] = COUNTRY_ONLY
    return ddl(fields)


def _declared(name: str) -> Column:
    return F.col("user.location.country" if name == "country" else f"user.{name}")


def _normalized(name: str) -> Column:
    user = F.col("user")
    if name == "id":
        return F.coalesce(user.id, F.get_json_object(user.login, "$.uuid"))
    if name == "age":
        nested = F.get_json_object(user.dob, "$.age")
        return F.coalesce(user.age.try_cast("int"), nested.try_cast("int"))
    if name == "nationality":
        return F.coalesce(user.nationality, user.nat)
    if name == "location":
        spot = F.col("user.location.coordinates")
        exact = F.when(
            spot.isNotNull(),
            F.struct(
                spot.latitude.try_cast("double").alias("latitude"),
                spot.longitude.try_cast("double").alias("longitude"),
            ),
        )
        return F.when(
            user.location.isNotNull(),
            F.struct(
                user.location.country.alias("country"),
                user.location.city.alias("city"),
                exact.alias("coordinates"),
            ),
        )
    return _declared(name)
