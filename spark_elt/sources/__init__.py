"""Sources: delimited files, archives, SQLite, generators, JDBC, file listings."""
