"""Sources: raw CSV files, stored clean tables, and the test fixture derived from ``events``."""
