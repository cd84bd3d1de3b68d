"""DuckDB SQL equivalents of every registered query (the correctness oracle)."""
