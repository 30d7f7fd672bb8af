"""Column -> Column functions; nothing here reads or writes data."""
