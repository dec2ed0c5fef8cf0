"""The library's operators on the driver's parquet tables, with SQL to compare against."""
