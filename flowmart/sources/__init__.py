"""Sources: wide CSV, landing folders, staged Parquet, delimited files, SDMX-JSON, zip, XML, JDBC."""

from flowmart.sources.archives import extract_zips, read_zip_csv, zip_csv_to_parquet
from flowmart.sources.delimited import is_tab_separated, read_any, read_csv, read_delimited
from flowmart.sources.jdbc import read_jdbc
from flowmart.sources.landing import landing_manifest, prefix_dim, require_landing, with_indicator
from flowmart.sources.sdmx import decode_sdmx, read_sdmx_json
from flowmart.sources.sdmx_stream import stream_sdmx_json
from flowmart.sources.staged import project_existing, read_staged
from flowmart.sources.wide_csv import fix_missing_headers, read_wide_csv
from flowmart.sources.xml import read_xml_records, record_tag, tag_counts
from flowmart.sources.xml_split import read_split_records, record_intervals

__all__ = [
    "decode_sdmx", "extract_zips", "fix_missing_headers", "is_tab_separated", "landing_manifest", "prefix_dim",
    "project_existing", "read_any", "read_csv", "read_delimited", "read_jdbc", "read_sdmx_json", "read_split_records",
    "read_staged", "read_wide_csv", "read_xml_records", "read_zip_csv", "record_intervals", "record_tag", "require_landing",
    "stream_sdmx_json", "tag_counts", "with_indicator", "zip_csv_to_parquet",
]
