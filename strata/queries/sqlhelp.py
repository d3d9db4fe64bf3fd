"""SQL fragments for the DuckDB oracles, mirroring the Spark expressions."""

from __future__ import annotations

from strata.plans import inputs


def rounded(expr: str, digits: int) -> str:
    """A double rounded half up on its value to eight decimals, as ``gold.round_stable``."""
    return f"cast(round(cast({expr} as decimal(38,8)), {digits}) as double)"


def avg_rounded(c: str, digits: int) -> str:
    return rounded(f"avg(cast({c} as double))", digits)


def sum_rounded(c: str, digits: int = 2) -> str:
    """The exact sum of values of up to six decimals, rounded half up."""
    return f"cast(round(sum(cast({c} as decimal(38,6))), {digits}) as double)"


def sum_exact(c: str) -> str:
    """Oracle of an exact, unrounded sum."""
    return f"cast(sum(cast({c} as decimal(38,12))) as double)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round(cast({part} as double) * 100.0 / cast({whole} as double), {digits})"


def initcap(c: str) -> str:
    """Spark ``initcap``: split on single spaces, upper first letter, lower the rest."""
    return (f"array_to_string(list_transform(string_split({c}, ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def hash_field(c: str) -> str:
    return f"coalesce(replace(replace(cast({c} as varchar), '\\', '\\\\'), '|', '\\|'), '\\N')"


def row_hash(cols: list[str]) -> str:
    return "sha256(concat_ws('|', " + ", ".join(hash_field(c) for c in cols) + "))"


def cols(mapping: dict[str, str]) -> str:
    return inputs.select_list(mapping)


_STOP_NAMES = [("stop_number", "sno"), ("station_name", "stationName"), ("arrives", "arrives"),
               ("departs", "departs"), ("day", "day"), ("distance", "distance")]


def _train_rows(stop: dict[str, str] | None, condition: str) -> str:
    fields = ", ".join(f'{stop[src] if stop else "NULL"} AS "{dst}"' for dst, src in _STOP_NAMES)
    return (f"SELECT {cols(inputs.TRAIN_COLUMNS)}, {cols(inputs.TRAIN_DAYS)}, {fields} "
            f"FROM lineitem WHERE {condition}")


TRAINS_BRONZE = (_train_rows(inputs.STOP_COLUMNS, f"NOT ({inputs.NO_STOPS})") + " UNION ALL "
                 + _train_rows(inputs.SECOND_STOP_COLUMNS, inputs.TWO_STOPS))
TRAINS_WITHOUT_STOPS = _train_rows(None, inputs.NO_STOPS)
DAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]
TRAINS_SILVER = f"""
SELECT trim(trainNumber) AS trainNumber, trim(trainName) AS trainName, trim(route) AS route,
  trim(regexp_extract(trim(route), '^(.+?) to ', 1)) AS origin,
  trim(regexp_extract(trim(route), ' to (.+)$', 1)) AS destination,
  {", ".join(DAYS)},
  TRY_CAST(stop_number AS INTEGER) AS stop_number,
  trim(regexp_extract(trim(station_name), '^(.+?) -', 1)) AS station_name,
  trim(regexp_extract(trim(station_name), '- (.+)$', 1)) AS station_code,
  nullif(arrives, 'Source') AS arrival_time, nullif(departs, 'Destination') AS departure_time,
  TRY_CAST(day AS INTEGER) AS day,
  TRY_CAST(regexp_extract(distance, '(\\d+)', 1) AS DOUBLE) AS distance_km,
  arrives = 'Source' AS is_source, departs = 'Destination' AS is_destination
FROM trains_bronze"""
TRAINS_BAD = ("coalesce(trainNumber IS NULL OR station_name IS NULL OR station_name = '' "
              "OR stop_number IS NULL OR distance_km IS NULL, false)")
TRAINS_CTE = (f"WITH trains_bronze AS ({TRAINS_BRONZE}), trains_silver_all AS ({TRAINS_SILVER}), "
              f"trains_silver AS (SELECT * FROM trains_silver_all WHERE NOT {TRAINS_BAD})")

PLACES_RAW = ("SELECT " + cols(inputs.PLACE_COLUMNS) + " FROM customer JOIN nation ON c_nationkey = n_nationkey "
              "JOIN region ON n_regionkey = r_regionkey")
PLACES_SILVER = """
SELECT trim(id) AS id, trim(name) AS name, TRY_CAST(latitude AS DOUBLE) AS latitude,
  TRY_CAST(longitude AS DOUBLE) AS longitude, trim(address) AS address, trim(city) AS city,
  trim(state) AS state, trim(zip) AS zip, upper(trim(country)) AS country, trim(url) AS url,
  trim(phone) AS phone, regexp_replace(trim(phone), '[^\\d+]', '', 'g') AS phone_clean,
  trim(categories) AS categories, trim(point_of_interest) AS point_of_interest,
  coalesce(trim(address) IS NOT NULL AND length(trim(address)) > 0, false) AS has_address,
  coalesce(trim(phone) IS NOT NULL OR trim(url) IS NOT NULL, false) AS has_contact
FROM places_raw"""
PLACES_BAD = ("coalesce(id IS NULL OR id = '' OR name IS NULL OR name = '' OR latitude IS NULL "
              "OR latitude < -90 OR latitude > 90 OR longitude IS NULL OR longitude < -180 OR longitude > 180 "
              "OR country IS NULL OR country = '', false)")
PLACES_CTE = (f"WITH places_raw AS ({PLACES_RAW}), places_silver_all AS ({PLACES_SILVER}), "
              f"places_silver AS (SELECT * FROM places_silver_all WHERE NOT {PLACES_BAD})")

PATIENTS_RAW = ("SELECT " + cols(inputs.PATIENT_COLUMNS) + " FROM (SELECT *, unnest(generate_series(0, "
                + inputs.PATIENT_COPIES + ")) AS copy_no FROM orders JOIN customer ON o_custkey = c_custkey)")
TRIPS_RAW = "SELECT " + cols(inputs.TRIP_COLUMNS) + " FROM events"
STUDY_RAW = "SELECT " + cols(inputs.STUDY_COLUMNS) + " FROM lineitem"
