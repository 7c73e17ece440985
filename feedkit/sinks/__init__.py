"""Writers: tables, delimited exports, file logs."""
