"""Jobs that chain operators, for tables and for streams."""
