"""The library's operators over the given tables, with SQL to compare against."""
