"""Sources: landed JSON pages and JDBC tables."""
