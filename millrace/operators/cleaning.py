"""Typed, checked inspection and complaint rows from raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import cleaned, rejections

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# The box of valid coordinates, and areas' names.
LAT, LON = (40.45, 40.95), (-74.30, -73.65)
AREAS = ("MANHATTAN", "BRONX", "BROOKLYN", "QUEENS", "STATEN ISLAND")


def stamp(col: Column) -> Column:
    """A strict timestamp; other text is null."""
    return F.try_to_timestamp(col, F.lit(STAMP))


def status(text: Column, value: Column) -> Column:
    return F.when(text.isNull(), "MISSING").when(value.isNull(), "INVALID").otherwise("VALID")


def coordinates(df: DataFrame, lat: str, lon: str, box: tuple = (LAT, LON)) -> DataFrame:
    """Replaces two text columns by doubles, null unless valid, and adds coordinate_status."""
    y, x = cleaned(F.col(lat)), cleaned(F.col(lon))
    a, b = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    state = (
        F.when(y.isNull() & x.isNull(), "MISSING").when(y.isNull() | x.isNull(), "PARTIAL").when(a.isNull() | b.isNull(), "INVALID_FORMAT")
        .when(~a.between(-90.0, 90.0) | ~b.between(-180.0, 180.0), "OUT_OF_RANGE").when(~a.between(*box[0]) | ~b.between(*box[1]), "OUTSIDE_AREA").otherwise("VALID")
    )
    marked = df.withColumns({"coordinate_status": state, "__lat": a, "__lon": b})
    valid = F.col("coordinate_status") == "VALID"
    return marked.withColumns({lat: F.when(valid, F.col("__lat")), lon: F.when(valid, F.col("__lon"))}).drop("__lat", "__lon")


def dated(col: str) -> Column:
    """Status of a date: 1900-01-01 stands for no inspection yet and is accepted."""
    at = stamp(F.col(col))
    return F.when(cleaned(F.col(col)).isNull(), "MISSING").when(at.isNull(), "INVALID").when(F.to_date(at) == F.lit("1900-01-01").cast("date"), "UNINSPECTED_PLACEHOLDER").otherwise("VALID")


def zip_code(col: Column, plus_four: bool = False) -> Column:
    """Five digits; with plus_four also those of a ZIP+4."""
    text = cleaned(col)
    return F.when(text.rlike(r"^\d{5}(-\d{4})?$" if plus_four else r"^\d{5}$"), F.substring(text, 1, 5))


def address(building: Column, street: Column, area: Column, code: Column) -> Column:
    line = F.nullif(F.concat_ws(" ", F.upper(cleaned(building)), F.upper(cleaned(street))), F.lit(""))
    return F.concat_ws(", ", line, area, F.when(code.isNotNull(), F.concat(F.lit("NY "), code)))


def prepared_inspections(raw: DataFrame) -> DataFrame:
    """Raw text columns camis, dba, boro, building, street, zipcode, inspection_date, grade_date, record_date, score, latitude, longitude
    become typed ones with statuses; rejection_reasons lists what is wrong. Columns *_original keep the text."""
    kept = ("inspection_date", "grade_date", "record_date", "score", "latitude", "longitude", "zipcode")
    df = raw.withColumns({f"{c}_original": F.col(c) for c in kept})
    df = df.withColumns({"camis": cleaned(F.col("camis")), "borough": F.upper(cleaned(F.col("boro"))), "zipcode": zip_code(F.col("zipcode"))})
    df = df.withColumns({
        "zipcode_status": status(cleaned(F.col("zipcode_original")), F.col("zipcode")), "address_display": address(F.col("building"), F.col("street"), F.col("borough"), F.col("zipcode")),
        "inspection_date_status": dated("inspection_date_original"), "inspection_date": stamp(F.col("inspection_date")), "grade_date": stamp(F.col("grade_date")), "record_date": stamp(F.col("record_date")),
        "score": F.col("score").try_cast("int"),
    })
    df = coordinates(df.withColumn("score_status", status(cleaned(F.col("score_original")), F.col("score"))), "latitude", "longitude")
    why = rejections((F.col("camis").isNull(), "MISSING_CAMIS"), (F.col("inspection_date_status") == "MISSING", "MISSING_INSPECTION_DATE"), (F.col("inspection_date_status") == "INVALID", "INVALID_INSPECTION_DATE"))
    return df.withColumns({"inspection_year": F.year("inspection_date"), "inspection_month": F.month("inspection_date"), "rejection_reasons": why})


def area_name(col: Column) -> Column:
    """Upper case; NEW YORK is MANHATTAN; UNSPECIFIED is missing."""
    text = F.upper(cleaned(col))
    return F.when(text == "NEW YORK", "MANHATTAN").when(text == "UNSPECIFIED", F.lit(None)).otherwise(text)


def prepared_complaints(raw: DataFrame) -> DataFrame:
    """Raw text columns unique_key, created_date, closed_date, resolution_action_updated_date, complaint_type, borough, incident_zip, latitude, longitude, status become typed ones."""
    df = raw.withColumns({f"{c}_original": F.col(c) for c in ("created_date", "borough", "incident_zip")})
    named = area_name(F.col("borough"))
    df = df.withColumns({
        "unique_key": cleaned(F.col("unique_key")), "complaint_type": F.upper(cleaned(F.col("complaint_type"))), "status": F.upper(cleaned(F.col("status"))),
        "created_date": stamp(F.col("created_date")), "closed_date": stamp(F.col("closed_date")), "resolution_action_updated_date": stamp(F.col("resolution_action_updated_date")),
        "borough_status": F.when(named.isNull(), "MISSING").when(named.isin(*AREAS), "VALID").otherwise("INVALID"), "borough": F.when(named.isin(*AREAS), named),
        "incident_zip": zip_code(F.col("incident_zip"), plus_four=True),
    })
    df = df.withColumns({"incident_zip_status": status(cleaned(F.col("incident_zip_original")), F.col("incident_zip")), "created_date_status": status(cleaned(F.col("created_date_original")), F.col("created_date"))})
    df = coordinates(df, "latitude", "longitude")
    known = F.col("complaint_type").isin("FOOD ESTABLISHMENT", "FOOD POISONING", "RODENT")
    why = rejections(
        (F.col("unique_key").isNull(), "MISSING_UNIQUE_KEY"), (F.col("created_date_status") == "MISSING", "MISSING_CREATED_DATE"), (F.col("created_date_status") == "INVALID", "INVALID_CREATED_DATE"),
        (F.col("complaint_type").isNull(), "MISSING_COMPLAINT_TYPE"), (F.col("complaint_type").isNotNull() & ~known, "UNEXPECTED_COMPLAINT_TYPE"),
    )
    return df.withColumns({"complaint_year": F.year("created_date"), "complaint_month": F.month("created_date"), "rejection_reasons": why})


def split(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows."""
    return prepared.where(F.size("rejection_reasons") == 0).drop("rejection_reasons"), prepared.where(F.size("rejection_reasons") > 0)


def split_spatial(prepared: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted rows with coordinates, accepted rows without, rejected rows."""
    accepted, rejected = split(prepared)
    there = F.col("coordinate_status") == "VALID"
    return accepted.where(there), accepted.where(~there), rejected
