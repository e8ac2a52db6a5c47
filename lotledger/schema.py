"""Row types of captures, listings, run control, jobs and logs."""

from __future__ import annotations

from pyspark.sql import types as T

CAPTURE = T.StructType(
    [
        T.StructField("page_id", T.LongType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("html", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# One schema for the three sites; a column a site does not fill stays null.
LISTING_FIELDS = {
    "origin_link": _TEXT,
    "make": _TEXT,
    "model": _TEXT,
    "marketing_headline": _TEXT,
    "sales_price_incl_vat": _LONG,
    "sales_price_excl_vat": _LONG,
    "currency": _TEXT,
    "body_type": _TEXT,
    "colour": _TEXT,
    "colour_manufacturer": _TEXT,
    "mileage": _LONG,
    "cubic_capacity_l": T.DecimalType(18, 6),
    "cubic_capacity_cm3": _LONG,
    "power_in_kw": _LONG,
    "power_in_ps": _LONG,
    "fuel": _TEXT,
    "fuel_consumption_comb": _DOUBLE,
    "fuel_consumption_city": _DOUBLE,
    "fuel_consumption_country": _DOUBLE,
    "co2_emission": _LONG,
    "energy_efficiency_class": _TEXT,
    "number_of_seats": _LONG,
    "number_of_doors": _LONG,
    "number_of_previous_owners": _LONG,
    "gearbox": _TEXT,
    "emission_class": _TEXT,
    "emission_sticker": _TEXT,
    "first_registration": _TEXT,
    "service_maintenance": _TEXT,
    "climate_control": _TEXT,
    "parking_sensors": _TEXT,
    "airbags": _TEXT,
    "interior": _TEXT,
    "postal_code": _TEXT,
    "country": _TEXT,
    "published_date": T.DateType(),
}

LISTING = T.StructType(
    [T.StructField(name, kind, name != "origin_link") for name, kind in LISTING_FIELDS.items()]
    + [
        T.StructField("site", T.StringType()),
        T.StructField("iteration_id", T.LongType()),
        T.StructField("is_synced", T.IntegerType()),
        T.StructField("parse_date", T.DateType()),
    ]
)

RUN_CONTROL = T.StructType(
    [
        T.StructField("site_name", T.StringType()),
        T.StructField("iteration_id", T.LongType()),
        T.StructField("bad_fields", T.ArrayType(T.StringType())),
    ]
)

JOB = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("errors_count", T.LongType()),
    ]
)

LOG = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("time", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)
