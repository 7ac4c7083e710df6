from surveywave.sources.reader import FrameSource, ParquetRawSource, open_source, write_raw
from surveywave.sources.adapter import DriverAdapter
from surveywave.sources.schemas import RAW_SCHEMAS, RAW_TABLES

__all__ = ["DriverAdapter", "FrameSource", "ParquetRawSource", "RAW_SCHEMAS", "RAW_TABLES",
           "open_source", "write_raw"]
