"""Column contracts of the raw and the staged layer."""

from pyspark.sql import types as T

# The fields a landed request record may carry; everything arrives as text.
API_FIELDS = [
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type", "descriptor",
    "location_type", "incident_zip", "incident_address", "street_name", "cross_street_1", "cross_street_2",
    "city", "borough", "latitude", "longitude", "location", "status", "resolution_description",
    "resolution_action_updated_date", "community_board", "council_district", "census_tract", "bin", "bbl", "nta",
]

RAW_ALL_STRING = T.StructType([T.StructField(name, T.StringType()) for name in API_FIELDS])

RAW = T.StructType(
    RAW_ALL_STRING.fields
    + [
        T.StructField("raw_payload", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

POLICY = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("complaint_type", T.StringType()),
    T.StructField("descriptor", T.StringType()),
    T.StructField("sla_days", T.IntegerType()),
    T.StructField("business_hours_only", T.BooleanType()),
])

FACT_COLUMNS = [
    "request_key", "created_date_key", "closed_date_key", "agency_key", "complaint_type_key", "borough_key",
    "agency_code", "agency_name", "complaint_type", "descriptor", "complaint_category", "borough",
    "incident_zip", "status", "location_type", "resolution_days", "sla_days", "sla_compliant",
    "open_request_age_days", "is_emergency", "has_coordinates", "latitude", "longitude", "created_at",
    "closed_at", "dbt_updated_at",
]
