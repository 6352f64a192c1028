"""Sources: landing-file readers, JDBC/parquet acquisition, star adapter."""
