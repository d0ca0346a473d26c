"""Declared input schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
        "timestamp": T.TimestampNTZType(), "date": T.DateType(),
    }
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {
    "pipes": _schema(
        "id long, compkey long, usnode string, dsnode string, unittype string, length double, diamwidth double, "
        "height double, pipeshape string, material string, instdate timestamp, hservstat string, cutno int, "
        "fm double, to_ double, seg_count int, grade_h5 int, remarks string"
    ),
    "asset": _schema(
        "compkey long, instdate timestamp, own string, unittype string, servstat string, unitid string, unitid2 string"
    ),
    "inspection": _schema("inspkey long, compkey long, startdttm timestamp, compdttm timestamp"),
    "observation": _schema(
        "inspkey long, obskey long, obkey long, obsevkey long, obrating double, distfrom double, distto double, "
        "severity string"
    ),
    "index_history": _schema("inspkey long, indexkey long, rating double"),
    "observation_code": _schema("obkey long, obcode string"),
    "severity_code": _schema("obsevkey long, sevdesc string, severity string"),
    "peak_score": _schema("obsevkey long, peak_score double"),
    "attribute_change": _schema("compkey long, chtype string, chdetail string, distfrom double, distto double"),
    "life_band": _schema(
        "curve string, score_lower_bound double, score_upper_bound double, yearstofailure double"
    ),
    "material_curve": _schema("category string, curve string"),
    "surcharge": _schema("compkey long, ussurch string"),
    "storm_grade": _schema("compkey long, altidtyp string"),
    "link": _schema("mlinkid long, compkey long, usnode string, dsnode string, length double"),
    "link_cost": _schema("mlinkid long, totalconstructioncost double"),
    "link_type": _schema("mlinkid long, type string"),
    "street_type": _schema("street_number int, street_grp string"),
}
