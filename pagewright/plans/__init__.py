"""Named queries over a directory of tables, with DuckDB SQL to compare against."""
