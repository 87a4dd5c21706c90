"""DuckDB SQL oracle for the registered queries (see ``oracle.sql``)."""
