"""DuckDB SQL twins of the registered queries."""
