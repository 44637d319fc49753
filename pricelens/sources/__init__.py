from pricelens.sources.adapter import delivery_zones, price_records, zone_states
from pricelens.sources.pages import (
    PAGE_SCHEMA,
    RECORD_SCHEMA,
    bronze_records,
    flatten_pages,
    land_pages,
    page_offsets,
    page_report,
    paged_ingest,
    parse_page_text,
    read_pages,
    records_to_pages,
)
from pricelens.sources.tables import (
    ensure_namespaces,
    keyed_upsert,
    require_zone_columns,
    surcharge_config_frame,
    write_table,
)

__all__ = [
    "delivery_zones", "price_records", "zone_states", "PAGE_SCHEMA",
    "RECORD_SCHEMA", "bronze_records", "flatten_pages", "land_pages",
    "page_offsets", "page_report", "paged_ingest", "parse_page_text",
    "read_pages", "records_to_pages", "ensure_namespaces", "keyed_upsert",
    "require_zone_columns", "surcharge_config_frame",
    "write_table",
]
