"""Raw GPS ping cleaning (P1-P8): one projection + filter chain, no UDFs.

Each step runs only when its columns exist, like the reference's dynamic
schema handling; the chain is a single narrow stage, so Catalyst pushes
the filters to the Parquet scan where it can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: id columns, column types and names, accepted trip statuses
ID_COLUMNS = ("route_id", "trip_id", "vehicle_id", "stop_id")
MIN_EPOCH, MAX_EPOCH = -9_223_372_036, 9_223_372_036
PING_TYPES = {"route_id": "string", "trip_id": "string", "vehicle_id": "string", "stop_id": "string", "vehicle_timestamp": "string",
              "latitude": "double", "longitude": "double", "bearing": "double", "schedule_relationship": "string"}
OTHER_NAMES = {"lat": "latitude", "lon": "longitude", "lng": "longitude", "timestamp": "vehicle_timestamp", "heading": "bearing",
               "routeId": "route_id", "tripId": "trip_id", "vehicleId": "vehicle_id", "stopId": "stop_id"}
ACCEPTED_STATUS = ('"ADDED"', '"SCHEDULED"', "ADDED", "SCHEDULED")
# ---------------------------------------------------------------------------


#: Text to DOUBLE; for junk the parser raises and catches an exception, so it gets no
#: text that begins above the digits, as no finite number does.
SECONDS_SQL = "CASE WHEN _text < ':' THEN try_cast(_text AS DOUBLE) END"


def strip_quotes(df: DataFrame, cols=ID_COLUMNS) -> DataFrame:
    """Remove every double quote from the id columns that exist (as strings)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.replace(F.col(c).cast("string"), F.lit('"'), F.lit("")) for c in present})


def epoch_to_ts(df: DataFrame, col: str = "vehicle_timestamp", out: str = "ts") -> DataFrame:
    """Quoted / numeric / junk epoch seconds -> DOUBLE seconds and TIMESTAMP.

    Unparsable values, NaN and times beyond 1677..2262 (milliseconds taken for
    seconds) become NULL (``try_cast``); ANSI ``cast`` would raise.
    """
    if col not in df.columns:
        return df
    # one element per row: a generator's output is an attribute, so that filters
    # on the time, which the planner moves down, don't parse the text again
    df = df.withColumn("_text", F.expr(f"replace(CAST({col} AS STRING), '\"', '')"))
    df = df.select("*", F.inline(F.array(F.struct(F.expr(SECONDS_SQL).alias("_secs"))))).drop("_text")
    # outside of what a nanosecond clock holds (1677-09-21 .. 2262-04-11): unparsable
    df = df.withColumn(col, F.when(F.col("_secs").between(MIN_EPOCH, MAX_EPOCH), F.col("_secs"))).drop("_secs")
    return df.withColumn(out, F.expr(f"timestamp_micros({HALF_UP_SQL.format(x=f'({col} * 1e6)')})"))


#: A double to the nearest whole number, halves away from zero, like ``round``, which goes through decimal text.
HALF_UP_SQL = "CASE WHEN {x} >= 0 THEN floor({x}) + CAST({x} - floor({x}) >= 5e-1 AS INT) ELSE ceil({x}) - CAST(ceil({x}) - {x} >= 5e-1 AS INT) END"


def valid_gps(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Keep rows with lat in [-90, 90] and lon in [-180, 180] (NULL/NaN dropped)."""
    if lat not in df.columns or lon not in df.columns:
        return df
    return df.where(F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0))


def schedule_status(df: DataFrame, col: str = "schedule_relationship") -> DataFrame:
    """Keep ADDED / SCHEDULED, quoted or not (NULL dropped)."""
    if col not in df.columns:
        return df
    return df.where(F.col(col).isin(*ACCEPTED_STATUS))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """P5: drop rows with NULL ts, latitude or longitude."""
    return df.dropna(subset=["ts", "latitude", "longitude"])


def clean_pings(df: DataFrame) -> DataFrame:
    """P1 -> P5 as one narrow stage."""
    df = strip_quotes(df)
    df = epoch_to_ts(df)
    df = valid_gps(df)
    df = schedule_status(df)
    return drop_incomplete(df)


def conform(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """A ping table of any layout in the one that the operators expect.

    Columns called otherwise are renamed (``names``, else :data:`OTHER_NAMES`,
    without case), those of another type are converted (what cannot be is
    NULL), missing ones are added as NULL; further columns pass through."""
    known = {k.lower(): v for k, v in (OTHER_NAMES if names is None else names).items()}
    target = {c.lower(): c for c in PING_TYPES}
    as_is = {target[c.lower()] for c in df.columns if c.lower() in target}
    out = []
    for c in df.columns:
        new = target.get(c.lower()) or known.get(c.lower(), c)
        if new != c and new in as_is and c.lower() not in target:
            new = c     # the column is there under its own name, too
        x = F.col(f"`{c}`")
        out.append((x.try_cast(PING_TYPES[new]) if new in PING_TYPES and dict(df.dtypes)[c] != PING_TYPES[new] else x).alias(new))
        as_is.add(new)
    out += [F.lit(None).cast(t).alias(c) for c, t in PING_TYPES.items() if c not in as_is]
    return df.select(*out)


def union_pings(*frames: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Pings of several layouts in one table. A column that only some have
    is NULL for the others; one beyond the pings' own whose types differ is text."""
    frames = [conform(f, names) for f in frames]
    types: dict[str, set[str]] = {}
    for f in frames:
        for c, t in f.dtypes:
            types.setdefault(c, set()).add(t)
    mixed = [c for c, t in types.items() if len(t) > 1]
    out = None
    for f in frames:
        f = f.withColumns({c: F.col(f"`{c}`").cast("string") for c in mixed if c in f.columns})
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def filter_route(df: DataFrame, route_id: str) -> DataFrame:
    """Pings of one route (an empty frame when absent)."""
    return df.where(F.col("route_id") == F.lit(str(route_id)))


def moving_segments(df: DataFrame) -> DataFrame:
    """Training rows with a positive segment duration."""
    return df.where(F.col("segment_duration") > 0)


def feature_matrix(df: DataFrame, keep=()) -> DataFrame:
    """P10: numeric feature columns, NULL / NaN / +-inf -> 0.

    Numeric means integral or floating types (booleans excluded, as with
    ``select_dtypes(np.number)``); coordinates, raw time and target are left out.
    """
    excluded = {"latitude", "longitude", "next_lat", "next_lon", "geometry",
                "vehicle_timestamp", "ts", "target"}
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    cols = [f.name for f in df.schema.fields
            if f.dataType.simpleString() in numeric and f.name not in excluded and f.name not in keep]
    out = []
    for c in cols:
        x = F.col(c).cast("double")
        bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        out.append(F.when(bad, F.lit(0.0)).otherwise(x).alias(c))
    return df.select(*keep, *out)
