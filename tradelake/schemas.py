"""Declared schemas of the response documents and plans.

FIXED VALUES: field names, order and types below must equal the published
response formats of the trade statistics service so that parsed tables line
up with what downstream users already query.  They are kept together here in
their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct_ddl(columns_ddl: str) -> str:
    """'a int, b string' -> 'struct<a:int,b:string>' (for nesting in DDL)."""
    parts = [p.strip() for p in columns_ddl.split(",") if p.strip()]
    return "struct<" + ",".join(":".join(p.split(None, 1)) for p in parts) + ">"


def envelope_ddl(element_columns_ddl: str) -> str:
    """Envelope ``{elapsedTime, count, data:[element], error}`` as DDL."""
    return (f"elapsedTime string, count int, data array<{struct_ddl(element_columns_ddl)}>, "
            "error string")


# --- fixed values: envelope shared by every response document -------------
ENVELOPE_FIELDS = ["elapsedTime", "count", "data", "error"]

# --- fixed values: world share element -------------------------------------
WORLD_SHARE_ELEMENT_DDL = (
    "typeCode string, freqCode string, period int, year int, month int, "
    "datasetDesc string, reporterCode int, reporterISO string, reporterDesc string, "
    "worldShare double, isAvailable boolean, dataCount int, firstReleased string, "
    "lastReleased string, created string, updated string"
)
# output columns of the world-share table (request keys first)
WORLD_SHARE_COLUMNS = [
    "typeCode", "freqCode", "period", "year", "month", "datasetDesc", "reporterCode",
    "reporterISO", "reporterDesc", "worldShare", "isAvailable", "dataCount",
    "firstReleased", "lastReleased", "created", "updated",
]

# --- fixed values: publication notes ---------------------------------------
NOTE_TEXT_FIELDS = [
    "reporterDescription", "currency", "importConvFactor", "exportConvFactor",
    "tradeSystem", "classificationCode", "importValuation", "exportValuation",
    "importPartnerCountry", "exportPartnerCountry", "importPartner2Country",
    "exportPartner2Country", "publicationNote", "publicationDate",
    "publicationDateShort",
]
NOTE_ELEMENT_DDL = (
    "datasetCode bigint, typeCode string, freqCode string, period int, reporterCode int, "
    + ", ".join(f"{f} string" for f in NOTE_TEXT_FIELDS)
)
NOTES_PARENT_DDL = (
    "reporterCode int, period int, typeCode string, freqCode string, datasetCode bigint, "
    f"notes array<{struct_ddl(NOTE_ELEMENT_DDL)}>"
)
NOTES_COLUMNS = (["typeCode", "freqCode", "clCode", "reporterCode", "period", "datasetCode"]
                 + NOTE_TEXT_FIELDS)

# --- fixed values: data availability ---------------------------------------
_FLAGS = ["isOriginalClassification", "isExtendedFlowCode", "isExtendedPartnerCode",
          "isExtendedPartner2Code", "isExtendedCmdCode", "isExtendedCustomsCode",
          "isExtendedMotCode"]

AVAILABILITY_SCHEMA = T.StructType(
    [T.StructField("datasetCode", T.LongType()),
     T.StructField("typeCode", T.StringType()),
     T.StructField("freqCode", T.StringType()),
     T.StructField("period", T.IntegerType()),
     T.StructField("reporterCode", T.IntegerType()),
     T.StructField("reporterISO", T.StringType()),
     T.StructField("reporterDesc", T.StringType()),
     T.StructField("classificationCode", T.StringType()),
     T.StructField("classificationSearchCode", T.StringType())]
    + [T.StructField(f, T.BooleanType()) for f in _FLAGS]
    + [T.StructField("totalRecords", T.IntegerType()),
       T.StructField("datasetChecksum", T.LongType()),
       T.StructField("firstReleased", T.StringType()),
       T.StructField("lastReleased", T.StringType())]
)

TARIFFLINE_AVAILABILITY_SCHEMA = T.StructType(
    [T.StructField("datasetCode", T.LongType()),
     T.StructField("typeCode", T.StringType()),
     T.StructField("freqCode", T.StringType()),
     T.StructField("period", T.IntegerType()),
     T.StructField("reporterCode", T.IntegerType()),
     T.StructField("reporterISO", T.StringType()),
     T.StructField("classificationCode", T.StringType())]
    + [T.StructField(f, T.BooleanType()) for f in _FLAGS]
    + [T.StructField("totalRecords", T.IntegerType()),
       T.StructField("datasetChecksum", T.LongType()),
       T.StructField("lengthCmdCode", T.IntegerType()),
       T.StructField("firstReleased", T.StringType()),
       T.StructField("lastReleased", T.StringType())]
)

# --- fixed values: bilateral preview record fields (extracted as JSON text) -
PREVIEW_FIELDS = [
    "typeCode", "freqCode", "refPeriodId", "refYear", "refMonth", "period",
    "reporterCode", "reporterISO", "reporterDesc", "flowCode", "partnerCode",
    "partnerISO", "partnerDesc", "cmdDescE", "cmdDescF", "tradeValue", "qtyUnitCode",
    "qtyUnitDescE", "qtyUnitDescF", "tradeQty", "altQtyUnitCode", "altQtyUnitDescE",
    "altQtyUnitDescF", "altQty",
]

# --- fixed values: request plans -------------------------------------------
BILATERAL_PLAN_COLUMNS = ["reporter_id", "reporter_name", "partner_id", "partner_name",
                          "flow_id", "flow_name", "cmdCode", "year"]
REPORTER_YEAR_PLAN_COLUMNS = ["reporter_id", "reporter_name", "year"]
BILATERAL_YEARS = (2010, 2024)       # end exclusive
REPORTER_YEARS = (1962, 2025)        # end exclusive
# request defaults of a preview fetch
PREVIEW_REQUEST_DEFAULTS = {"typeCode": "C", "freqCode": "A", "clCode": "HS"}
# ceiling of records for one detailed request
DETAIL_RECORD_CEILING = 250_000
